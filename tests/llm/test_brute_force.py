"""Operators that SQL cannot express, against plain versions of what they do; and all against columns that are named like their own."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import decontamination, exact_dedup, license_scan, lm_scoring, ngram_join, sharding, source_mixing, token_store, toxicity, warc


def placed_by_sorting(points, dims, shards):
    """Shard of each point by splitting sorted lists at the weighted quantile."""
    tie, out = 1 << sharding.TIE_BITS, {}

    def split(own, m, first):
        if m == 1 or not own:
            return out.update((p["id"], first) for p in own)
        spread = lambda d: (max(p[d] for p in own) // tie - min(p[d] for p in own) // tie, max(p[d] for p in own) - min(p[d] for p in own))
        dim = max(dims, key=spread)
        want, before, order = sum(p["weight"] for p in own) * ((m + 1) // 2) / m, 0, sorted({p[dim] for p in own})
        for cut in order:
            w = sum(p["weight"] for p in own if p[dim] == cut)
            if before + w >= want or cut == order[-1]:
                break
            before += w
        cut = cut if abs(before + w - want) <= want - before else cut - 1
        split([p for p in own if p[dim] <= cut], (m + 1) // 2, first)
        split([p for p in own if p[dim] > cut], m // 2, first + (m + 1) // 2)

    split(points, shards, 0)
    return out


@pytest.mark.parametrize("n,shards", [(60, 5), (300, 8)])
def test_kd_tree(spark, n, shards):
    rng = np.random.default_rng(n)
    points = [{"id": i, "weight": int(rng.integers(1, 50)), **{d: (int(rng.integers(0, k)) << sharding.TIE_BITS) + int(rng.integers(0, 1 << 31)) for d, k in (("a", 9), ("b", 1 << 20), ("c", 3))}} for i in range(n)]
    frame = spark.createDataFrame([tuple(p[k] for k in ("id", "weight", "a", "b", "c")) for p in points], "id int, weight long, a long, b long, c long")
    got = {r.id: r.shard for r in sharding.kd_place(frame, ["a", "b", "c"], shards, tolerance=0.0)[0].collect()}
    assert got == placed_by_sorting(points, ["a", "b", "c"], shards)


def kinds_by_looking_back(symbols):
    """What the grammar makes of a clause, from the definition of each transducer alone."""
    near = lambda s, i, reach: s in symbols[(max(0, i - reach) if reach else 0) : i]
    out = []
    for i, s in enumerate(symbols):
        kind, weight = s, 0.0
        if s == "i" and near("s", i, 2):
            weight += toxicity.ARC_WEIGHTS["intensified"]
        if s == "h":
            kind = "v" if near("m", i, 4) else toxicity.OTHER
            weight += toxicity.ARC_WEIGHTS["threat"] if kind == "v" else 0.0
        if kind in "iv" and near("n", i, 3):
            kind, weight = "j", weight + toxicity.ARC_WEIGHTS["negated"]
        if kind in "iv" and near("r", i, 0):
            kind, weight = "q", weight + toxicity.ARC_WEIGHTS["reported"]
        if kind == "i" and near("t", i, 4):
            kind, weight = "u", weight + toxicity.ARC_WEIGHTS["aimed"]
        out.append((kind, weight))
    return out


def test_toxicity_scores(spark):
    rng = np.random.default_rng(12)
    words = {"x": "stone", "i": "idiot", "h": "hurt", "t": "you", "n": "not", "r": "said", "m": "will", "s": "very", "|": "."}
    lexicon = dict.fromkeys(toxicity.INSULTS, 3.0) | {"idiot": 2.5}
    clauses = [[toxicity.SYMBOLS[k] for k in rng.choice(len(toxicity.SYMBOLS), rng.integers(0, 12))] for _ in range(400)]
    texts = [(i, " . ".join(" ".join(words[s] for s in c) for c in clauses[i : i + rng.integers(1, 5)])) for i in range(300)] + [(300, None), (None, "")]
    want = []
    for _, t in texts:
        sums, n, strongest = dict.fromkeys(toxicity.KINDS, 0.0), 0, 0.0
        for clause in (t or "").split("."):
            own = [next(s for s, w in words.items() if w == x) for x in clause.split()]
            found = [(k, max(0.0, (2.5 if s == "i" else toxicity.SEED_WEIGHT) + w)) for (k, w), s in zip(kinds_by_looking_back(own), own) if k in toxicity.KINDS]
            for k, w in found:
                sums[k] += w
            plain = [w for k, w in found if k not in "jq"]
            n, strongest = n + bool(plain), max([strongest, *plain])
        x = [*(math.log1p(sums[k]) for k in toxicity.KINDS), math.log1p(n), strongest]
        want.append(1 / (1 + math.exp(-(toxicity.DEFAULT_WEIGHTS[0] + np.dot(toxicity.DEFAULT_WEIGHTS[1:], x)))))
    got = toxicity.score_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), lexicon, toxicity.DEFAULT_WEIGHTS).collect()
    assert sorted((r.doc_id or -1, round(r.score, 9), r.predicted) for r in got) == sorted((i or -1, round(s, 9), int(s >= 0.3)) for (i, _), s in zip(texts, want))
    assert {r.held_out for r in got if r.doc_id is None} == {False} and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)


def test_decontamination_against_all_pairs(spark):
    rng = np.random.default_rng(21)
    word = lambda k: f"w{k}"
    items = [(i, " ".join(map(word, rng.integers(0, 500, 18))) + ". " + " ".join(map(word, rng.integers(0, 500, 8)))) for i in range(25)]
    docs = []
    for i in range(120):
        own = items[i % 25][1].split()
        for k in range(len(own)):
            if rng.random() < (i % 6) * 0.05:
                own[k] = f"n{rng.integers(0, 10**6)}"
        docs.append((i, " ".join([*(f"z{k}" for k in rng.integers(0, 300, 40)), *own, *map(word, rng.integers(0, 500, 30))])))
    lists = {i: decontamination.words_of(t) for i, t in items}
    frequency = Counter(w for x in lists.values() for w in set(x))
    idf = {t: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for t, n in frequency.items()}
    mean = np.mean([len(x) for x in lists.values()])
    want = {}
    for i, text in docs:
        words = decontamination.words_of(text)
        held = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for j, item in items:
            n = Counter(lists[j])
            weight = {t: idf[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(lists[j]) / mean)) for t, c in n.items()}
            share = max(sum(weight.get(t, 0.0) for t in set(words[a : a + 32])) for a in range(0, len(words), 16)) / sum(weight.values())
            q, a = decontamination.question_and_answer(item)
            sets = [decontamination.shingles(q), decontamination.shingles(q[-4:] + a)]
            overlap = [len(s & held) / len(s) for s in sets]
            if share >= 0.5 and overlap[0] >= 0.6 and overlap[1] >= 0.5:
                want[i, j] = tuple(round(x, 6) for x in (share, *overlap))
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): tuple(round(x, 6) for x in (r.bm25_share, r.question_overlap, r.answer_overlap)) for r in found.collect()}
    assert got == want and 30 < len(got) < 120


TEXTS = [None, "", "a b c d e f g", "A B c d e f g", "x " * 3000, "you are such an idiot", "the house is here . it stands", "Released under the MIT License.", "a b c d e f h"]
#: Names that the operators give to columns of their own.
NAMES = ["row", "name", "key", "label", "size", "h", "sk", "t", "n", "held", "ids", "word", "c", "doc", "chunk", "recipe", "merkle", "shard", "slot", "digest", "node", "weight", "copies", "class_id", "links", "values", "bucket", "toxic", "score", "lines", "start", "kind", "part", "first", "taken", "item_id", "family", "extra", "edge", "base"]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(i, t, ("s", None, "q")[i % 3]) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "s"), (None, TEXTS[5], None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").checkpoint()


OPERATORS = {
    "exact": exact_dedup.exact_duplicates, "lm": lambda d: lm_scoring.lm_scores(d).withColumn("score", F.round("score", 2)), "join": ngram_join.ngram_jaccard_join, "mix": source_mixing.mix_sources,
    "license": license_scan.license_scan, "toxicity": lambda d: toxicity.score_toxicity(d, dict.fromkeys(toxicity.INSULTS, 3.0), toxicity.DEFAULT_WEIGHTS), "store": token_store.stored_documents,
    "shard": lambda d: sharding.shard_documents(d, 3, metadata=("source",)).drop("slot"), "leaks": lambda d: decontamination.contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 6")),
    "warc": lambda d: warc.archived_pages(d.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "html").withColumn("url", F.lit("http://a.org/x"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"),
    "kept join": lambda d: ngram_join.one_of_each_class(d).select("doc_id", "text"), "kept mix": lambda d: source_mixing.mixed_documents(d).select("doc_id", "text", "source"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_named_like_the_operators_own(plain, name):
    clashing = plain.select("*", *[F.lit("clash").alias(c) for c in NAMES])
    rows = lambda d: sorted(map(repr, OPERATORS[name](d).collect()))
    assert rows(clashing) == rows(plain) != []
