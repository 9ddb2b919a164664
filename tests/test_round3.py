"""What the third round's findings were about."""

import random

import pyarrow as pa
import pytest

from lectern.operators import trees as Y

def _first(lemma):
    token = {"id": 1, "form": lemma, "lemma": lemma, "pos": "N", "cpos": "_", "morph": "_", "head": 0, "func": "ROOT", "misc": "_"}
    return Y.rewrite_sentence([token], Y.parse_rules("lemma=/(.)(.*)/\tnone\t#1:misc,=First=$1U"))[0]["misc"]

def test_capitals_are_those_of_sql():
    assert [_first(x) for x in ("ßein", "éa", "ab", "ŉa", ",a", "|a")] == ["First=ẞ", "First=É", "First=A", "First=ŉ", "First=,", "First="]


_FIELDS = [*Y.FIELDS, *Y.EXTRA]
_RULES = [
    "form=/.*/;func=/(.*)/;func=/obj/\t#1>#2>#3\t#1~#3;#3:edep=up:$1", "form=/(..)(....)/\tnone\t#1:split=$1|$2", "position=/first/;form=/.*/\t#1.#2\t#1><#2",
    "pos=/N/;pos=/V/\t#1.*#2\t#1>#2;#2:func=x;#2:misc+=K=1", "lemma=/(.)(.*)/&position!=/first/;pos=/(N|V)/\t#2~#1\t#1:misc,=X=$1U;#2:edep=;#1:storage=$2",
    "func=/.*/;func=/.*/\t#1:func==#2;#1:head==#2\t#1:head=0;#2>#1", "edep=/(.*)/&deps!=/_/\tnone\t#1:edom=3||$1;#1:ehead=2", "#S:opened=/yes/;id=/2/\t#1.#2\t#S:opened=no;#S:q=r;#2:cpos=Q",
    "pos=/N/;pos=/V/;pos=/ART/\t#1.0,4#2;#3:pos==#3\t#3:morph,=A=z,b;#3>#2", "position=/last/;ehead=/2/\t#1.*#2\t#1:form=ab;last",
]


def _random_sentence(rnd):
    n, out = rnd.choice([0, 1, 2, 3, 5, 8, 12]), []
    first = 2 if rnd.random() < 0.05 else 1  # ids that don't run from 1 are left to the engine of sentences
    for i in range(first, n + first):
        token = dict(zip(_FIELDS, [i, rnd.choice(["the", "abcdef", "ghijkl", "ßa"]), rnd.choice(["a", ",c", "ßd", None]), rnd.choice(["N", "V", "ART"]), "_", rnd.choice(["_", "A=b|C=d"]), rnd.choice([rnd.randint(0, n + 1), max(0, i - 1), None]), rnd.choice(["obj", "mark"]), rnd.choice(["_", "SpaceAfter=No"]), rnd.choice(["_", "1:x|2:y"]), None, rnd.choice([None, '{"opened": "yes"}'])], strict=True))
        if rnd.random() < 0.1:
            out.append({**token, "form": "S", "head": None, "deps": "_", "upto": i, "meta": None})
        out.append(token)
    return out


@pytest.mark.parametrize("chosen", [[k] for k in range(10)] + [list(range(9)), list(range(10))])
def test_rules_over_batches_do_what_they_do_to_sentences(chosen):
    from lectern.operators.tree_batches import rewritten

    rnd, rules = random.Random(3), Y.parse_rules("\n".join(_RULES[k] for k in chosen))
    sentences = [_random_sentence(rnd) for _ in range(300)]
    kind = pa.list_(pa.struct([(f, Y._KINDS.get(f, pa.string())) for f in _FIELDS]))
    got = [[] for _ in sentences]
    for of, columns in rewritten(pa.array(sentences, kind), rules):
        for k, t in zip(of.tolist(), zip(*[c.to_pylist() for c in columns], strict=True), strict=True):
            got[k].append(dict(zip(_FIELDS, t, strict=True)))
    assert got == [Y.rewrite_sentence(s, rules) for s in sentences]


def _plan(spark, name):
    from lectern.plans.catalog import QUERIES

    return QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


#: Queries that bring texts together by key once, and then neither join nor exchange what is made of them.
ONE_EXCHANGE = ["q102_aligned_letters", "q51_sgml_round_trip", "q57_sentence_tagging_rows", "q52_group_segmentations", "q138_sheet", "q55_metadata", "q65_global_heads", "q22_bies", "q109_capped_chunks", "q67_entity_brackets", "q64_sentence_comments", "q60_conll_round_trip", "q69_ordered_edges", "q70_columns_by_place", ]


@pytest.mark.parametrize("name", ONE_EXCHANGE)
def test_only_texts_are_exchanged(spark, name):
    plan = _plan(spark, name)
    assert plan.count("Exchange") <= 1 and "Join" not in plan


def test_letters_of_two_versions_meet_without_a_join(spark):
    from lectern.operators import binding as B

    docs = spark.createDataFrame([("a", " ab  c", "a_b_c"), ("b", "xy", "xyz"), ("c", None, "x")], "key string, orig string, gold string")
    out = B.aligned_letters(docs, "orig", "gold", "key")
    assert sorted(map(tuple, out.collect())) == [("a", 0, "a", False, True), ("a", 1, "b", True, True), ("a", 2, "c", False, False), ("b", 0, "x", False, False), ("b", 1, "y", False, False)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q53_edit_attributes", "q54_wrap_spans"])
def test_edited_annotations_meet_without_joins(spark, name):
    assert "Join" not in _plan(spark, name)
