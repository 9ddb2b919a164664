"""Each operator on a small table with nulls, empty and long texts, ties, repeated rows, and columns with clashing names; and on an empty one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import attention_model, decontamination, exact_dedup, license_scan, lm_scoring, ngram_join, sharding, source_mixing, token_store, toxicity, warc
from lectern.llm.components import connected_components
from lectern.llm.subwords import word_encoder

ITEM = "the quick brown fox jumps over the lazy dog near the old mill. it then sleeps until noon by the door."
LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
TEXTS = [None, "", "  \n", "Alpha beta", "alpha BETA", "one two three four five six seven", ITEM.upper(), f"before {ITEM} after", LONG, LONG + " tail", "you are a stupid idiot. really", "é É Σας idiot.", "Released under the MIT license"]
NOTICES = "Some text.\n  Licensed under the Apache Licence, version 2.0!  \n(Released under the MIT License.)\nMIT"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s" if i % 3 else None, "x", i, "clash", 1) for i, t in enumerate(TEXTS)]
    rows += [(5, TEXTS[5], "s", None, None, "clash", 2), (None, "alpha beta", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, keep_id string, score int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false").checkpoint()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_exact_dedup(docs, empty):
    got = by_id(exact_dedup.exact_duplicates(docs))
    assert got[3].keep_id == got[4].keep_id == got[None].keep_id == 4 and got[4].group_size == 3 and got[4].kept and not got[3].kept and not got[None].kept
    assert got[0].keep_id == 1 and got[2].keep_id == 2 and got[5].group_size == 2 and got[8].n_chunks > 5
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_chunks_of_one_identifier_are_compared_across_batches(monkeypatch):
    class Same:
        def __init__(self, data):
            pass

        def digest(self):
            return b"\0" * 32

    monkeypatch.setattr(exact_dedup.hashlib, "sha256", Same)
    batch = lambda t: pa.RecordBatch.from_arrays([pa.array([0]), pa.array([t])], ["i", "t"])
    sent = [x for b in exact_dedup._chunks(iter(map(batch, ["one", "two", "one", "ONE"]))) for x in b.column(1).to_pylist()]
    assert sent == [b"one", b"two"]


def test_chunks_cover_texts_and_move_with_their_content():
    data = np.random.default_rng(1).integers(97, 123, 60_000, dtype=np.uint8)
    cut = lambda x: exact_dedup.chunk_ends(exact_dedup.rolling_cuts(exact_dedup._GEAR[x], 12), 0, len(x))
    a, b = cut(data), cut(np.concatenate([data[:500], data]))
    assert a[-1] == 60_000 and all(y - x <= exact_dedup.MAX_CHUNK for x, y in zip([0, *a], a))
    assert len(set(a) & {e - 500 for e in b}) > len(a) // 2


def test_lm_scores(docs, empty):
    got = by_id(lm_scoring.lm_scores(docs))
    assert len(got) == len(TEXTS) + 1 and got[0].n_tokens == 1 and got[8].n_tokens == 20_001
    assert all(np.isfinite(r.score) and r.score < 0 and r.n_known <= r.n_tokens for r in got.values())
    assert got[0].score == pytest.approx(got[1].score) == pytest.approx(got[2].score)
    assert lm_scoring.lm_scores(empty).count() == 0


def test_lm_model_is_a_distribution_and_knows_no_future():
    model = attention_model.Model(attention_model.first_weights(np.arange(attention_model.SLOTS)))
    x = np.zeros((128, attention_model.WINDOW), np.int64)
    x[:, 1] = 5
    at, every = np.arange(128) * attention_model.WINDOW + 1, np.arange(attention_model.SLOTS).reshape(-1, 128)
    assert sum(np.exp(model.log_probabilities(x, at, t)).sum() for t in every) == pytest.approx(1, abs=1e-3)
    y = x.copy()
    y[:, 2:] = 7  # the future
    assert np.allclose(model.log_probabilities(x, at, at % 50), model.log_probabilities(y, at, at % 50))


def test_lm_gradient_and_overflow():
    flat, rng = attention_model.first_weights(np.arange(attention_model.SLOTS)), np.random.default_rng(2)
    x, y = rng.integers(0, 1024, (3, attention_model.WINDOW)), rng.integers(-1, 1024, (3, attention_model.WINDOW))
    at = np.flatnonzero(y.ravel() >= 0)
    model, start = attention_model.Model(flat), 0
    loss = lambda f: -attention_model.Model(f).log_probabilities(x, at, y.ravel()[at]).astype(float).mean()
    model.add_gradient(x, y, len(at))
    for name, shape in attention_model.SHAPES.items():
        i = start + int(np.abs(model.g[start : start + np.prod(shape)]).argmax())
        step = np.zeros_like(flat)
        step[i] = 1e-2
        assert model.g[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-2, rel=0.1), name
        start += int(np.prod(shape))
    big = flat.copy()
    attention_model.unpacked(big)["U"][:, -1, 3] = 500
    assert np.isfinite(attention_model.Model(big).log_probabilities(x, at, y.ravel()[at])).all()


def test_lm_scores_each_id_once():
    model = attention_model.Model(attention_model.first_weights(np.ones(attention_model.SLOTS)))
    slots, none = np.arange(500) % 50 + 1, np.zeros(500)
    documents = [np.arange(n) for n in (0, 1, 31, 32, 33, 100, 499)]
    whole = lm_scoring.score_ids(model, none, slots, documents)
    assert np.allclose(whole, [lm_scoring.score_ids(model, none, slots, [d])[0] for d in documents], rtol=1e-4)
    assert np.allclose(lm_scoring.score_ids(model, none - 1.0, slots, documents) - whole, [-len(d) / np.log(10) for d in documents], rtol=1e-3, atol=1e-3)


def test_lm_scores_against_a_plain_model_and_takes_no_row_twice(monkeypatch):
    d, w, rng = attention_model.WIDTH, attention_model.WINDOW, np.random.default_rng(5)
    flat = attention_model.first_weights(np.arange(attention_model.SLOTS)) + rng.standard_normal(attention_model.N_WEIGHTS).astype(np.float32) * 0.1
    p = {k: x.astype(float) for k, x in attention_model.unpacked(flat).items()}

    def plain(x):  # log probabilities of all slots behind each place of a window
        e = p["E"][x] + p["P"][: len(x)]
        q, k, v = np.split(e @ p["QKV"], 3, axis=1)
        a = np.exp(q @ k.T / np.sqrt(d)) * np.tril(np.ones((len(x), len(x))))
        h = e + a / a.sum(1, keepdims=True) @ v @ p["O"]
        one = lambda y: np.column_stack([y, np.ones(len(y))])
        z = one(h + np.maximum(one(h) @ p["W1"], 0) @ p["W2"])
        log = lambda y: y - np.log(np.exp(y).sum(-1, keepdims=True))
        return (log(z @ p["C"])[:, :, None] + log(np.einsum("td,cdp->tcp", z, p["U"]))).reshape(len(x), -1)

    def score(ids):
        s, total = np.array([0, *ids, 0]), 0.0
        for first in range(0, max(1, len(ids) + 1 - lm_scoring.OVERLAP), w - lm_scoring.OVERLAP):
            x = s[first : min(first + w, len(s) - 1)]
            known = lm_scoring.OVERLAP if first else 0
            total += plain(x)[np.arange(known, len(x)), s[first + known + 1 : first + len(x) + 1]].sum()
        return total / np.log(10)

    rows, matmul = [], np.matmul
    monkeypatch.setattr(attention_model.np, "matmul", lambda a, b, **k: (b.shape == (d + 1, attention_model.HIDDEN) and rows.append(len(a)), matmul(a, b, **k))[1])
    documents = [rng.integers(1, attention_model.SLOTS, n) for n in (0, 5, 31, 32, 57, 58, 700)]
    got = lm_scoring.score_ids(attention_model.Model(flat), np.zeros(attention_model.SLOTS), np.arange(attention_model.SLOTS), documents)
    assert np.allclose(got, [score(x) for x in documents], rtol=1e-4)
    assert sum(rows) <= sum(len(x) + 1 + w for x in documents)  # ids that a window has as context only are not put through the hidden layer again


@given(st.lists(st.integers(0, 140), min_size=1, max_size=12), st.integers(0, 9))
@settings(max_examples=50, deadline=None)
def test_lm_windows_of_all_turns_hold_each_target_once(lengths, first):
    documents = [np.arange(n) % 900 + 1 for n in lengths]
    found = [lm_scoring.training_windows(documents, first, turn, 5)[0] for turn in range(5)]
    targets = sorted(t for w in found for t in w[:, 1:].ravel().tolist() if t >= 0)
    assert targets == sorted([0] * len(lengths) + [t for d in documents for t in d.tolist()])
    pairs = sorted(x for w in found for a, b in zip(w[:, :-1].ravel().tolist(), w[:, 1:].ravel().tolist()) if b >= 0 for x in [(a, b)])
    assert pairs == sorted(x for d in documents for x in zip([0, *d.tolist()], [*d.tolist(), 0]))


def test_lm_base_and_counts_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "COUNTED_WORDS", 50)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"{'wW'[k % 2]}{k % 300}" for k in rng.zipf(1.4, rng.integers(0, 60)))) for i in range(200)] + [(7, None), (8, "\x0b\x0c a \t B"), (None, "w1 É é")]
    got = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    tokens = [[*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((i or -1, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for (i, _), h, t in zip(rows, held, tokens))
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def test_lm_counts_ids_where_it_encodes(monkeypatch):
    monkeypatch.setattr(lm_scoring, "ENCODE_BYTES", 40)  # many slices
    path, texts = token_store.default_tokenizer(), ["The house", None, "a b  the HOUSES", "held out", " é ü " * 9, ""]
    held = [t == "held out" for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(held), pa.array(texts, pa.string())], ["doc_id", "held", "t"])
    rows = pa.Table.from_batches(lm_scoring._encoded(path, pa.int64())(iter([batch]))).to_pylist()
    encode = lambda t: word_encoder(path).tokenizer.encode((t or "").lower(), add_special_tokens=False).ids
    want = Counter(i for t, h in zip(texts, held) if not h for i in encode(t))
    assert {r["n_tokens"]: r["c"] for r in rows if r["t"] is None and r["word"] is None} == want
    assert [r["n_tokens"] for r in rows if r["t"] is not None] == [len((t or "").split()) + 1 for t in texts]


def test_lm_products_over_many_rows_are_cut_into_runs(monkeypatch):
    rng, longest, matmul = np.random.default_rng(3), [], np.matmul
    for n in (0, 5, 8, 4096, 4099):
        a, b = rng.standard_normal((n, 25)).astype(np.float32), rng.standard_normal((n, 48)).astype(np.float32)
        assert np.allclose(attention_model.crossed(a[:, :24], b), a[:, :24].T @ b, atol=1e-3)
    monkeypatch.setattr(attention_model.np, "matmul", lambda x, y, **k: (y.ndim == 3 and longest.append(y.shape[-2]), matmul(x, y, **k))[1])
    model = attention_model.Model(attention_model.first_weights(np.ones(attention_model.SLOTS)))
    model.train(rng.integers(0, attention_model.SLOTS, (attention_model.LOT, attention_model.WINDOW + 1)), 1e-3)
    assert attention_model.LOT * attention_model.WINDOW // attention_model.PARTS in longest


def test_lm_frequent_words_are_bounded(spark):
    counts = spark.createDataFrame([(f"w{i}", i + 1) for i in range(1000)] + [("x" * 65, 9999)], "word string, c long")
    few = lm_scoring.frequent_words(counts, 200)
    assert 0 < len(few) <= 200 and min(few.values()) == 1001 - len(few) and len(lm_scoring.frequent_words(counts)) == 1000


@pytest.mark.parametrize("n,words", [(3, 50), (250, 20_000)])
def test_lm_trains_on_every_id_at_every_size(spark, monkeypatch, n, words):
    class Seen(Exception):
        pass

    def targets(ids, slots, slot_counts, dtype):
        raise Seen(sum(len(r.ids) // np.dtype(dtype).itemsize + 1 for r in ids.toLocalIterator()))

    monkeypatch.setattr(lm_scoring, "train", targets)
    texts = spark.range(n).selectExpr("id AS doc_id", f"repeat('the house ', {words // 2}) AS text")
    training = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in range(n))
    ids = len(word_encoder(token_store.default_tokenizer()).tokenizer.encode("the house", add_special_tokens=False).ids)
    with pytest.raises(Seen) as seen:
        lm_scoring.lm_scores(texts)
    assert seen.value.args[0] == training * (ids * words // 2 + 1)


def test_ngram_join(docs, empty):
    got = by_id(ngram_join.ngram_jaccard_join(docs))
    assert got[8].class_id == got[9].class_id == 8 and got[8].n_links == 1 and got[3].class_size == 3 and got[0].class_size == 3
    assert got[10].class_size == 1 and got[10].n_links == 0
    assert ngram_join.ngram_jaccard_join(empty).count() == 0
    kept = ngram_join.one_of_each_class(docs)  # 7 holds 6 and two words more; the null id is a copy of 3
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3, 5, 6, 8, 10, 11, 12]
    assert ngram_join.one_of_each_class(empty).count() == 0


def test_one_of_each_class_loses_no_text_to_repeated_or_null_ids(spark):
    rows = [(3, "b b", 1), (5, "a a", 1), (5, "b b", 2), (7, "a a", 1), (None, "c c", 1), (None, "c c", 1), (None, "d d", 3), (None, None, 1), (9, "", 1), (2, "e e", 1), (2, "e e", 1), (2, "e e", 2)]
    got = ngram_join.one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string, key int").repartition(3)).collect()
    assert sorted((r.text or "", r.doc_id or 0) for r in got) == [("", 9), ("a a", 5), ("b b", 3), ("c c", 0), ("d d", 0), ("e e", 2)]


def test_ngram_join_against_all_pairs(spark):
    rng, base = np.random.default_rng(3), [f"v{i}" for i in range(120)]
    texts = []
    for _ in range(700):  # one group beyond a block, at all distances
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 7)):
            w[k] = f"n{rng.integers(0, 10**6)}"
        texts.append(" ".join(w))
    sets = [set(zip(*[t.split()[k:] for k in range(5)], strict=False)) for t in texts]
    links = [sum(i != j and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    got = by_id(ngram_join.ngram_jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)))
    assert [got[i].n_links for i in range(700)] == links


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.v: r.label for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_mixing(docs, empty):
    got = source_mixing.mix_sources(docs).collect()
    total = sum(r["size"] for r in got)
    assert len(got) == len(TEXTS) + 2 and sum({(r.source, r.target) for r in got} and [t for _, t in {(r.source, r.target) for r in got}]) == pytest.approx(total)
    assert all(r.taken <= 3 * r["size"] and r.target <= 3 * r.source_size for r in got)
    assert source_mixing.mix_sources(empty).count() == 0
    assert source_mixing.mixed_documents(docs).columns == docs.columns


def test_license_scan(docs, empty, spark):
    got = by_id(license_scan.license_scan(docs))
    assert got[12].license_id == "MIT" and got[12].notices == "MIT" and got[0].license_id is None and got[0].notices is None
    assert license_scan.license_scan(spark.createDataFrame([(1, NOTICES)], "doc_id int, text string")).first().notices == "Apache-2.0|MIT"
    text = "Copyright 2020 A\n" + license_scan.KNOWN_LICENSES[8][1].replace("LICENSE", "LICENCE").upper()
    one = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert license_scan.license_scan(one).first().license_id == "MIT"
    clash = docs.select("doc_id", "text", *(F.lit("x").alias(c) for c in ("row", "digest", "license_id", "notices", "place", "lines")))
    want = sorted(map(str, license_scan.license_scan(docs).collect()))
    assert sorted(map(str, license_scan.license_scan(clash).collect())) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert license_scan.license_scan(one).first().license_id == "MIT" and sorted(map(str, license_scan.license_scan(docs).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert license_scan.license_scan(empty).count() == 0


def test_licenses_are_found_as_whole_texts(spark, tmp_path):
    texts = [(i, f"Copyright (c) {i} Someone\n\n" + t.replace('"', "'").replace("license", "licence") + "\n", t) for i, (_, t) in enumerate(license_scan.KNOWN_LICENSES)]
    got = by_id(license_scan.license_scan(spark.createDataFrame(texts, "doc_id int, text string, digest string")))
    assert [got[i].license_id for i in range(len(texts))] == [name for name, _ in license_scan.KNOWN_LICENSES]
    near = spark.createDataFrame([(0, texts[12][2][:-20]), (1, texts[12][2] + " more")], "doc_id int, text string")
    assert all(r.license_id is None for r in license_scan.license_scan(near).collect())
    (tmp_path / "Own-1.0.txt").write_text("You may. " * 2000)
    own = license_scan.read_licenses(spark, f"file://{tmp_path}")
    assert license_scan.license_scan(spark.createDataFrame([(1, "you  may, " * 2000)], "doc_id int, text string"), own).first().license_id == "Own-1.0"


def test_warc(spark):
    big, rows = "é" * 700, [(1, "http://b.org/x", "small"), (2, "http://b.org/x", "small")]
    rows += [(3, "http://www.A.org/p?q=1#f", big), (4, None, big), (9, "http://[bad", big), (9, "http://[bad", big), (None, "u\r\nv", big), (10, "http://a.org/", None), (11, "http://a.org/", ""), (20, "http://a.org/long", "x" * 600_000), (21, None, "x" * 600_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, first string")
    got = warc.archived_pages(pages).orderBy("range", "position").collect()
    assert len(got) == len(rows) and [r.url_key for r in got] == sorted(r.url_key for r in got)
    kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in got}
    assert kinds[20] == ("revisit", 21, 600_000) and kinds[21][0] == "response"
    assert kinds[3] == ("revisit", 9, 1400) and kinds[9] == ("response", None, 1400) and kinds[1] == kinds[2] == ("response", None, 5) and kinds[None][1] == 9 and kinds[10][2] == 0
    assert warc.archived_pages(pages.where("false")).count() == 0


@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
@settings(max_examples=60, deadline=None)
def test_loser_tree(runs):
    assert list(warc.LoserTree([iter(sorted(r)) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


def test_toxicity_grammar(docs, empty):
    g = toxicity.clause_grammar()
    last = lambda x: (g.run(x)[0][-1], g.run(x)[1][-1])
    assert last("xi") == ("i", 0) and last("txi") == ("u", 1) and last("nxi") == ("j", -1) and last("rxxxxxxti") == ("q", -0.5) and last("mxh") == ("v", 1) and last("h") == ("x", 0)
    assert last("tsi") == ("u", 1.5) and last("sxi") == ("i", 0.5) and last("nrti") == ("j", -1) and last("mnh") == ("j", 0)
    lexicon, weights = toxicity.train_toxicity(docs, docs.sparkSession.createDataFrame([], "doc_id long, toxic int"))
    got = by_id(toxicity.score_toxicity(docs, lexicon, weights))
    assert got[10].score > 0.3 > got[5].score == got[0].score and got[10].predicted == 1
    assert toxicity.score_toxicity(empty, lexicon, weights).count() == 0
    kept = toxicity.without_toxic(docs, lexicon, weights)
    assert kept.columns == docs.columns and 10 not in {r.doc_id for r in kept.collect()}


def test_each_transducer_changes_scores():
    scores = lambda text, parts: toxicity._scores(toxicity.Scorer(dict.fromkeys(toxicity.INSULTS, 3.0), parts), toxicity.DEFAULT_WEIGHTS, [text])[0]
    for part, text, more in (("insult", "such an idiot", 1), ("threat", "i will hurt them", 1), ("negation", "he is not stupid", -1), ("reported", "she said idiot", -1), ("target", "you idiot", 1)):
        whole, without = (scores(text, p) for p in (toxicity.PARTS, tuple(p for p in toxicity.PARTS if p != part)))
        assert (whole - without) * more > 0.02, part


def test_logistic_keeps_the_prior_where_rows_are_silent():
    rng = np.random.default_rng(6)
    x = np.hstack([rng.standard_normal((500, 1)), np.zeros((500, 1))])
    w = toxicity.fit_logistic(x, (x[:, 0] > 0).astype(float), np.array([0.0, 0.0, 1.5]))
    assert w[1] > 2 and w[2] == pytest.approx(1.5)


def test_token_store(docs, empty):
    got = sorted(token_store.stored_documents(docs).collect(), key=lambda r: r.start)
    t, at = word_encoder(token_store.default_tokenizer()).tokenizer, 0
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    for r, (_, text) in zip(got, rows, strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_store.stored_documents(empty).count() == 0


def test_token_store_reads_ids_and_sees_what_is_lost(spark, tmp_path):
    rows = [(i % 40, f"the house {i} " * (i % 7)) for i in range(200)] + [(3, "same")] * 90 + [(None, None)]
    uri, path = f"file://{tmp_path}/store", token_store.default_tokenizer()
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), uri, path, part_rows=60)
    encoder = word_encoder(path).tokenizer
    want = sorted((-1 if i is None else i, [*encoder.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows)
    got = token_store.read_ids(spark, uri, path).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in got) == want
    manifest = spark.read.parquet(f"{uri}/manifest").collect()
    assert len(manifest) == 5 and max(r.documents for r in manifest) < 120 and token_store.read_digests(spark, uri, path).count() == len(rows)
    lost = max((tmp_path / "store/documents").glob("part-*"), key=lambda p: p.stat().st_size)
    kept = lost.read_bytes()
    lost.unlink()
    with pytest.raises(ValueError, match="manifest"):
        token_store.read_digests(spark, uri, path)
    lost.write_bytes(kept)
    chunks = max((tmp_path / "store/stage/kind=chunk").glob("part-*"), key=lambda p: p.stat().st_size)
    chunks.unlink()
    with pytest.raises(Exception, match="Merkle"):
        token_store.read_digests(spark, uri, path).collect()


@given(st.lists(st.text(max_size=60), min_size=1, max_size=20))
@settings(max_examples=80, deadline=None)
def test_cached_words_give_the_whole_texts_ids(texts):
    e = word_encoder(token_store.default_tokenizer())
    texts = [t.encode("utf-8", "replace").decode() for t in texts if "\x00" not in t]
    found = e.slice(e.lowered(pa.array(texts, pa.string())))
    assert [x.tolist() for x in found.texts()] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert found.word_counts().tolist() == [len(t.encode().split()) for t in texts]


@given(st.lists(st.binary(max_size=40), max_size=6))
def test_crc_of_parts(parts):
    assert token_store.crc32_joined([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_sharding(spark, docs, empty):
    rows = sharding.shard_documents(docs, 4).collect()
    assert len(rows) == len(TEXTS) + 2 and all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(4))
    assert len({r.shard for r in rows if r["size"] == 16}) == 1
    many = spark.range(4000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 1 + cast(id % 40 AS int)) AS text", "cast(id % 3 AS string) AS source")
    sizes = [r.n for r in sharding.shard_documents(many, 7).groupBy("shard").agg({"size": "sum"}).toDF("shard", "n").collect()]
    assert len(sizes) == 7 and max(sizes) < 1.03 * min(sizes)
    assert sharding.shard_documents(empty).count() == 0


def test_large_groups_leave_no_shard_empty(spark):
    texts = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('x', 100) ELSE concat(repeat('y', 90), lpad(id, 10, '0')) END AS text")
    sizes = sorted(r.n for r in sharding.shard_documents(texts, 40).groupBy("shard").agg({"size": "sum"}).toDF("shard", "n").collect())
    assert len(sizes) == 40 and sizes[-1] == 2000 * 116 and sizes[-2] < 1.06 * sizes[0]


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "seven"), (None, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(6, 1), (7, 1), (5, 4)}
    assert decontamination.contaminated(empty, items).count() == 0 == decontamination.contaminated(docs, items.where("false")).count()
    kept = decontamination.without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in (5, 6, 7))
    same = spark.createDataFrame([(1, ITEM, 0), (1, "clean", 0), (None, ITEM, 0), (None, "clean", 0)], "doc_id long, text string, item_id int")
    assert [r.text for r in decontamination.without_contaminated(same, items).collect()] == ["clean", "clean"]


def test_search_in_several_passes_and_bounded_slices(spark, monkeypatch):
    rng = np.random.default_rng(9)
    items = [(i, " ".join(f"i{k}" for k in rng.integers(0, 400, 30))) for i in range(60)]
    docs = [(i, " ".join([*(f"i{k}" for k in rng.integers(0, 400, 300)), *([items[i % 60][1]] if i % 3 else []), *(f"w{k}" for k in rng.integers(0, 90, 200))])) for i in range(40)]
    want = {(i, i % 60) for i in range(40) if i % 3}
    for chars, positions in ((8_000_000, 1 << 15), (5_000, 40)):
        monkeypatch.setattr(decontamination, "PASS_CHARS", chars)
        monkeypatch.setattr(decontamination, "SEARCH_POSITIONS", positions)
        found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_block_max_search_finds_all_above_the_threshold():
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"t{k}" for k in rng.zipf(1.3, 20) % 60)) for i in range(200)]
    frequency = {}
    for _, t in items:
        for w in set(t.split()):
            frequency[w] = frequency.get(w, 0) + 1
    (index,), _ = decontamination.build_index(items, frequency, 200, 20.0)
    for _ in range(50):
        terms = list({index.terms[w] for w in (f"t{k}" for k in rng.zipf(1.3, 15) % 60) if w in index.terms})
        score = np.zeros(200)
        for t in terms:
            for p, w in index.lists[t]:
                score[p] += w
        assert {p for p, _ in index.search(terms, 0.4)} == set(np.flatnonzero(score >= 0.4 - 1e-9).tolist())
