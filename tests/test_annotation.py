"""Operators on small made-up fixtures."""

import glob
import os
import re
from collections import Counter

import pytest

from lectern.functions import text as T
from lectern.operators import lexicon as L
from lectern.operators.segmentation import Grammar, align, grammar_segment, merge_groups, stacked
from lectern.operators import trees
from lectern.operators.trees import FIELDS, parse_rules, rewrite_sentence, rewrite_trees
from lectern.plans.catalog import ORACLE_SQL, QUERIES
from lectern.sources import formats as S


def test_grammar_takes_the_first_rule_and_the_first_forms(spark):
    g = Grammar({"art": ["a", "an"], "noun": ["nut", "apple", "ut"], "prep": ["in"]}, [["art", "noun"], ["prep", "art?", "noun"]])
    assert g.segment("anut") == (0, ["a", "nut"])
    assert g.segment("inapple") == (1, ["in", "apple"])
    assert g.segment("xyz") is None
    words = spark.createDataFrame([("anut",), ("anut",), ("zz",), (None,)], "w string")
    assert sorted((r.w or "", r.seg) for r in grammar_segment(words, g, "w").collect()) == [("", None), ("anut", "a|nut"), ("anut", "a|nut"), ("zz", None)]
    table = spark.createDataFrame([("zz", "z|z")], "norm string, seg string")
    assert {r.w: r.seg for r in stacked(words.dropna(), "w", table, g).collect()} == {"anut": "a|nut", "zz": "z|z"}


@pytest.mark.parametrize("surface,seg,want", [("abcd", "ab|cd", "ab|cd"), ("abd", "ab|cd", "ab|d"), ("abxcd", "ab|cd", "ab|xcd"), ("ϯx", "ti|x", "ϯ|x"), ("zzzz", "ab|cd", "")])
def test_align(surface, seg, want):
    got = align(surface, seg, (("ϯ", "ti"),))
    assert got.replace("|", "") in ("", surface)
    assert got == want


def test_merge_groups_is_transitive():
    assert merge_groups(["a", "b", "c", "."], {"a": 0.9, "ab": 0.6}) == ["abc", "."]
    assert merge_groups(["a", "."], {"a": 0.9}) == ["a", "."]


SENTENCE = [(1, "the", "the", "D", "DET", "_", 2, "det", "_"), (2, "cat", "cat", "N", "NOUN", "Num=Sing", 3, "nsubj", "_"), (3, "sleeps", "sleep", "V", "VERB", "_", 0, "root", "_")]


def test_tree_rules(spark):
    rules = parse_rules("; comment\n{n}=/N.*/\npos={n};pos=/D/\t#1>#2\t#1:morph+=Def=Yes;#2:func=x$1\nform=/(ca)t/;form=/sl.*/\t#1.#2\t#1:lemma=$1U;#1>#2\n".replace("pos={n}", "pos=/N.*/").replace("x$1", "art"))
    tokens = [dict(zip(FIELDS, t, strict=True)) for t in SENTENCE]
    out = rewrite_sentence(tokens, rules)
    assert out[1]["morph"] == "Def=Yes|Num=Sing" and out[0]["func"] == "art" and out[1]["lemma"] == "CA" and out[2]["head"] == 2
    assert tokens[1]["morph"] == "Num=Sing" and len(out) == 3
    frame = spark.createDataFrame([(s, *t) for s in range(3) for t in SENTENCE], "sent int, id int, form string, lemma string, pos string, cpos string, morph string, head int, func string, misc string")
    assert rewrite_trees(frame, rules, ["sent"]).where("lemma = 'CA'").count() == 3


def test_round_trips(spark):
    conll = "# sent_id = s1\n1\ta\ta\tX\tX\t_\t0\troot\t_\t_\n2\tb\tb\tX\tX\t_\t1\tdep\t_\t_\n\n1\tc\tc\tX\tX\t_\t0\troot\t_\t_\n\n"
    docs = spark.createDataFrame([("d", conll)], "doc_id string, text string")
    assert S.conllu_text(S.parse_conllu(docs)).first().text == conll.split("\n", 1)[1]
    assert S.conllu_comments(docs).where("sent = 0").first().meta == {"sent_id": "s1"}
    piped = spark.createDataFrame([("d", "a|b_c|d|e")], "doc_id string, text string")
    assert S.piped_text(S.parse_piped(piped)).first().text == "a|b_c|d|e"
    sgml = spark.createDataFrame([("d", '<norm norm="ab" pos="N">\na\n<hi>\nb\n</hi>\n</norm>\n<norm norm="c">\nc\n</norm>')], "doc_id string, text string")
    units = S.units_of_sgml(S.parse_sgml(sgml)).orderBy("unit").collect()
    assert [(u.norm, u.pos, u.orig) for u in units] == [("ab", "N", "ab"), ("c", "N", "c")]


def test_origin_prefers_exact_then_short_prefix_then_long_suffix(spark):
    words = spark.createDataFrame([("abc",), ("abx",), ("xing",), ("zz",)], "word string")
    entries = spark.createDataFrame([("abc", "e"), ("a*", "p1"), ("ab*", "p2"), ("*g", "s1"), ("*ing", "s2")], "form string, lang string")
    assert {r.word: r.origin for r in L.origin(words, entries).collect()} == {"abc": "e", "abx": "p1", "xing": "s2", "zz": None}


def test_trim_and_fused(spark):
    df = spark.createDataFrame([("|a||b|",)], "s string")
    assert df.select(T.trim_separators("s")).first()[0] == "a|b"


DRIVER_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DRIVER_TABLES}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def assert_rows_match(df, cur, name):
    rnd = lambda v: round(v, 6) if isinstance(v, float) else v
    have = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(have), name
    at = [have.index(c) for c in df.columns]
    assert sorted(repr(tuple(map(rnd, r))) for r in df.collect()) == sorted(repr(tuple(rnd(r[i]) for i in at)) for r in cur.fetchall()), name


@pytest.mark.skipif(not os.path.isdir(DRIVER_TABLES), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, duck, name):
    assert_rows_match(QUERIES[name](spark, DRIVER_TABLES), duck.execute(ORACLE_SQL[name]), name)


def test_conversation_queries_keep_whole_texts(spark, tmp_path):
    same = "one beginning of more than twenty letters, "
    turns = [(1, 0, "user", same + "a"), (1, 1, "assistant", "short"), (1, 2, "user", same + "b"), (1, 3, "assistant", same * 50), (2, 0, "user", None), (2, 1, "assistant", "")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    text, n = {(c, t): x for c, t, _, x in turns}, {1: 4, 2: 2}
    got = QUERIES["q20_skipgram"](spark, f"file://{tmp_path}")
    assert {(r.conv_id, r.turn): (r["t-2"], r["t-1"], r.t, r["t+1"]) for r in got.collect()} == {(c, t): tuple(text[c, (t + k) % n[c]] for k in (-2, -1, 0, 1)) for c, t in text}
    got = QUERIES["q50_grid_pivot"](spark, f"file://{tmp_path}")
    assert {tuple(r) for r in got.collect()} == {(1, same + "b", "short"), (2, None, "")}


def spaced(text):
    out, inside = "", False
    for c in text:
        inside |= c == "<"
        out += f" {c} " if c in ".,:;" and not inside else c
        inside &= c != ">"
    return re.sub(" +", " ", out)


def case_of(w):
    if any(c in "0123456789" for c in w):
        return "d"
    if w == w.upper() != w.lower():
        return "u"
    if w == w.lower():
        return "l"
    return "t" if w[:1] != w[:1].lower() and w[1:] == w[1:].lower() else "o"


def test_space_punct_takes_all_rows(spark, tmp_path):
    texts = ["a.b <i x='1.5'>c,d</i> e:f", "a > b. c", "x. <open, y. z", "<<a.b>c.d>e.f", "no tag; \n end.", "", None, "<p>." * 4000]
    spark.createDataFrame(list(enumerate(texts)), "conv_id long, text string").selectExpr("conv_id", "0 AS turn", "text").write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = QUERIES["q04_space_punct"](spark, f"file://{tmp_path}")
    assert {r.conv_id: r.spaced for r in got.collect()} == {i: t if t is None else spaced(t) for i, t in enumerate(texts)}


def test_case_class_takes_all_words(spark, tmp_path):
    docs = ["Straße straße STRAßE STRASSE ß ẞ ß1 Aß aßB Maß. the The", None, "no stop"]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = QUERIES["q05_case_class"](spark, f"file://{tmp_path}")
    assert {r.c: r.n for r in got.collect()} == Counter(case_of(w) for t in docs for w in (t or "").split())


def test_sentence_ids_take_all_sentences(spark, tmp_path):
    docs = ["w. " * 12_000, None, "no stop", "One. Two three"]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    want = []
    for i, x in enumerate((t or "").split() for t in docs):
        ends = [k for k, w in enumerate(x) if w.endswith(".") or k == len(x) - 1]
        want += [(i, f"s{k + 1:04d}", a + 1, b) for k, (a, b) in enumerate(zip([-1, *ends], ends))]
    assert sorted(tuple(r) for r in QUERIES["q23_sentence_ids"](spark, f"file://{tmp_path}").collect()) == sorted(want)


def test_stream(spark, tmp_path):
    from lectern.streaming.annotate import document_stream, stream_units

    (tmp_path / "a.txt").write_text("One two\nthree")
    q = stream_units(document_stream(spark, f"file://{tmp_path}")).writeStream.format("memory").queryName("units_seen").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.clean for r in spark.table("units_seen").orderBy("i").collect()] == ["one", "two", "three"]


def test_malformed_rules_are_errors():
    for bad in ("pos=N.*\tnone\t#1:func=x", "pos=/N/\t#1>#2\t#1:func=x", "pos=/N/;pos=/V/\tnone\t#1:func=x", "pos=/N/\tnone\t#2:func=x", "pos=/N/\tnone\t#1:split=a", "colour=/N/\tnone\t#1:func=x", "pos=/(/\tnone\t#1:func=x", "pos=/N/\t#1:func=x", "pos=/N/;pos=/V/\t#1?#2\t#1:func=x"):
        with pytest.raises(ValueError, match="line 1"):
            trees.parse_rules(bad)
    assert trees.validate("; c\npos=/N/\tnone\t#1:func=x\npos=N\tnone\tlast") == ["line 3: invalid node definition: 'pos=N'"]
    assert len(trees.parse_rules("form=/a;b&c/&pos!=/x|y/;lemma=/.*/\t#1.*#2\t#1:func=$1;last".replace("$1", "q"))) == 1


def test_tree_control_flow_and_trace():
    tokens = [dict(zip(FIELDS, t, strict=True)) for t in SENTENCE]
    seen = []
    rules = trees.parse_rules("form=/.*/\tnone\t#1:func=a;once\nfunc=/a/\tnone\t#1:lemma=first;last\nform=/.*/\tnone\t#1:func=z")
    out = rewrite_sentence(tokens, rules, lambda rule, s: seen.append((rule.text.split("\t")[2], [t["func"] for t in s.tokens])))
    assert [t["func"] for t in out] == ["a", "nsubj", "root"] and out[0]["lemma"] == "first" and [r for r, _ in seen] == ["#1:func=a;once", "#1:lemma=first;last"]


def test_split_renumbers_heads_edges_and_ranges():
    tokens = [dict(zip(FIELDS, t, strict=True)) for t in SENTENCE]
    tokens[0]["deps"] = "3:x"
    rules = trees.parse_rules("form=/the/;form=/cat/\t#1.#2\t#1><#2\nform=/c(at)/\tnone\t#1:split=k|$1\nform=/at/;form=/sleeps/\t#1.#2\t#1~#2;#2:edep=late;#1>#1")
    out = rewrite_sentence(tokens, rules)
    assert [(t["id"], t["upto"], t["form"], t["head"]) for t in out] == [(1, 3, "thecat", None), (1, None, "the", 2), (2, None, "k", 4), (3, None, "at", 2), (4, None, "sleeps", 0)]
    assert out[1]["deps"] == "4:x" and out[4]["deps"] == "3:late" and out[2]["misc"] == "SpaceAfter=No"
