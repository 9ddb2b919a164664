"""The call for a whole annotation, the command line, settings, models and small operators."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern import __main__ as cli
from lectern.annotate import Options, Tables, annotate, options_from
from lectern.operators import binding as B
from lectern.operators import conll as C
from lectern.operators import features as X
from lectern.operators import lexicon as L
from lectern.operators import markup, sgml
from lectern.operators import models as M
from lectern.operators import normalization as Z
from lectern.operators.segmentation import Grammar, Stack, analyze
from lectern.sources import formats as S
from lectern.sources.profile import output_path, read_profile, resolve_corpora


@pytest.fixture(scope="module")
def setting(spark):
    seg = spark.createDataFrame([("thecat", "the|cat"), ("sleeps.", "sleeps|.")], "norm string, seg string")
    lexicon = spark.createDataFrame([("the", "ART", 3), ("cat", "NPROP", 2), ("sleeps", "V", 1), (".", "PUNCT", 9)], "word string, tag string, freq long")
    gaz = spark.createDataFrame([("the cat", "animal")], "phrase string, etype string")
    ids = spark.createDataFrame([("the cat", "cat", "animal", "Felix", 3, 1), ("the cat", "cat", "person", "Baptist", 9, 2)], "text string, head string, etype string, link string, freq int, line int")
    tables = Tables(Stack(seg, Grammar({"v": ["re"], "n": ["run"]}, [["v", "n"]])), gazetteer=gaz, identities=ids, phrases=spark.createDataFrame([("the cat",)], "phrase string"))
    docs = spark.createDataFrame([("d1", "The*cat sleeps. rerun_<hi x='a b'>thecat</hi>"), ("d2", None), ("d3", "")], "doc_id string, text string")
    return docs, tables, M.Registry().add(M.lexicon_tagger(lexicon)).add(M.chain_parser())


def test_annotation_in_all_forms(setting):
    docs, tables, registry = setting
    got = {r.doc_id: r.text for r in annotate(docs, Options(outmode="pipes"), tables, registry).collect()}
    assert got == {"d1": "the|cat_sleeps|._re|run_the|cat"}
    o = Options(outmode="conllu", identities=True)
    text = annotate(docs, o, tables, registry).first().text
    assert text.startswith("# sent_id = d1-s0001\n# text = the cat sleeps .\n1\tthe\t_\tDET\tART\t_\t0\troot\t_\tEntity=(animal\n2\tcat\t_\tPROPN\tNPROP\t_\t1\tdep\t_\tEntity=animal)\n") and text.count("# sent_id") == 2
    text = annotate(docs, Options(identities=True, multiword=True, processing_meta=True), tables, registry).first().text
    assert text.splitlines()[0] == '<meta segmentation="automatic" tagging="automatic" parsing="automatic" entities="automatic">' and text.endswith("</meta>")
    assert '<entity entity="animal" head_tok="#u2" identity="Felix">' in text and '<multiword multiword="the cat">' in text and '<norm xml:id="u2" norm="cat" orig="cat" pos="NPROP" func="dep" head="#u1">' in text


def test_surface_keeps_what_was_written(setting):
    docs, tables, _ = setting
    got = {r.i: (r.dirty, r.surface_seg) for r in analyze(docs, tables.stack).collect()}
    assert got[0] == ("The*cat", "The*|cat") and got[1] == ("sleeps.", "sleeps|.") and got[3][0] == "<hi x='a b'>thecat</hi>"


def test_gold_input_and_lines(setting, spark):
    _, tables, registry = setting
    docs = spark.createDataFrame([("d", "a-b|c_d")], "doc_id string, text string")
    assert annotate(docs, Options(outmode="pipes", from_pipes=True), tables, registry).first().text == "a-b|c_d"
    lines = spark.createDataFrame([("d", "one\n\ntwo words\n")], "doc_id string, text string")
    assert annotate(lines, Options(outmode="pipes", no_tok=True), Tables(), registry).first().text == "one_two words"


def test_options():
    assert options_from({"identities": "on", "outmode": "conllu"}).parse and options_from({"merge_parse": "1"}).from_pipes
    for bad in ({"colour": "1"}, {"outmode": "pdf"}):
        with pytest.raises(ValueError, match="unknown"):
            options_from(bad)
    with pytest.raises(ValueError, match="no tagger named crf"):
        M.Registry().get("tagger", "crf")


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "tables").mkdir()
    (tmp_path / "tables/segmentation.tab").write_text("thecat\tthe|cat\nno tab here\n")
    (tmp_path / "tables/tagger.tab").write_text("cat\tN\t1\nthe\tART\t2\n")
    (tmp_path / "tables/rules.ini").write_text("pos=/ART/\tnone\t#1:func=det\n")
    (tmp_path / "a.txt").write_text("thecat")
    args = [f"file://{tmp_path}/a.txt", "--tables", f"{tmp_path}/tables"]
    # The session of the tests is the one that the command finds.
    reads = S.read_lexicon
    cli.read_lexicon = lambda s, path, kind: reads(s, f"file://{path}", kind)
    try:
        assert cli.main([*args, "--outmode", "pipes"]) == 0 and capsys.readouterr().out == "the|cat\n"
        assert cli.main([*args, "--outmode", "conllu", "--parse", "--dirout", f"{tmp_path}/out"]) == 0
    finally:
        cli.read_lexicon = reads
    (file,) = os.listdir(tmp_path / "out")
    assert file == "a.conllu" and "1\tthe\tthe\tDET\tART\t_\t0\tdet" in (tmp_path / "out" / file).read_text().replace("the\t_\tDET", "the\tthe\tDET")


def test_profile_and_corpora():
    p = read_profile("base_letters=abc\nvowels=ae\npos_classes=N<-NPROP|NUM;V<-VBD\nallowed=1, 2\nregex_tok=\n  un(.*)\tun|\\1\n")
    assert p.pos_classes == {"NPROP": "N", "NUM": "N", "VBD": "V"} and p.allowed == (1, 2) and p.segment_by_pattern("unable") == "un|able" and p.segment_by_pattern("x") is None
    with pytest.raises(ValueError, match="unknown"):
        read_profile("colour=red")
    names = ["mark", "mark.greek", "luke.1", "luke.2", "john"]
    assert resolve_corpora("mark", names) == ["mark"] and resolve_corpora("luke", names) == ["luke.1", "luke.2"] and resolve_corpora("luke+j-luke.2", names) == ["luke.1", "john"]
    with pytest.raises(ValueError, match="no corpus"):
        resolve_corpora("acts", names)
    assert output_path("x/a.tt", "tt", many=True) == "x/a.out.tt" and output_path("x/a.txt", "tt", "out") == "out/a.tt" and output_path("a.txt", "tt") is None


def test_lexicons_are_checked(spark, tmp_path):
    (tmp_path / "l.tab").write_text("# c\tN\tc\na\tN\ta\nno tab\nb\tV\n")
    path = f"file://{tmp_path}/l.tab"
    assert [r.word for r in S.read_lexicon(spark, path, "lemma").collect()] == ["# c", "a"]
    with pytest.raises(Exception, match="malformed line"):
        S.read_lexicon(spark, path, "lemma", strict=True).collect()


def test_eight_columns_and_ellipsis(spark):
    docs = spark.createDataFrame([("d", "1-2\tab\t_\t_\t_\t_\t_\t_\n1\ta\ta\tX\tX\t_\t0\troot\n1.1\te\te\tX\tX\t_\t_\t_\n2\tb\tb\tX\tX\t_\t1\tdep\n")], "doc_id string, text string")
    got = S.parse_conllu(docs).orderBy("line_no").collect()
    assert [(r.super_token, r.ellipsis, r.misc) for r in got] == [(True, False, None), (False, False, None), (False, True, None), (False, False, None)]


def test_coarse_tags_and_languages(spark):
    df = spark.createDataFrame([("N", "amod"), ("N", "obj"), ("V_PPERO", "x"), ("_", "x"), ("CONJ", "mark"), ("V", "aux"), ("PINT", "advmod"), ("??", "x")], "t string, f string")
    assert [r[0] for r in df.select(C.coarse_tag(F.col("t"), F.col("f"))).collect()] == ["ADJ", "NOUN", "PRON", "_", "SCONJ", "AUX", "ADV", ""]
    with pytest.raises(Exception, match="unknown language"):
        spark.range(1).select(C.language_code(F.lit("Klingon"))).collect()


def test_normalization_rules(spark):
    groups = spark.createDataFrame([("ⲓⲏⲗ",), ("ⲁ·ⲃ",), ("ⲉⲓⲁⲕⲱⲃ",), ("#ⲡⲛⲁ",), (None,)], "g string")
    table = spark.createDataFrame([("ⲁⲃ", "ⲁⲡⲁ", 1), ("ⲁⲃ", "ⲁⲃⲃⲁ", 2), ("ⲉⲓⲁⲕⲱⲃ", "x", 3)], "orig string, norm string, line int")
    got = {r.g: r.norm for r in Z.normalize_groups(groups, "g", table).collect()}
    assert got == {"ⲓⲏⲗ": "ⲓⲥⲣⲁⲏⲗ", "ⲁ·ⲃ": "ⲁⲡⲁ", "ⲉⲓⲁⲕⲱⲃ": "ⲉⲓⲁⲕⲱⲃ", "#ⲡⲛⲁ": "ⲡⲛⲉⲩⲙⲁ", None: None}


def test_transducer():
    lexicon = [("a", "x", "X"), ("a", "xy", "XYZ"), ("b", "y", "y"), ("b", "yy", "Q")]
    t = Z.CategoryTransducer(lexicon, ["a+b", "a"])
    assert t.analyses("xyy") == ["XYZy", "XQ"] and t.normalize("xyy") == "XYZy" and t.normalize("zz") == "zz" and t.normalize("zz", "?") == "?" and t.analyses("") == []
    assert Z.CategoryTransducer(lexicon, ["a+b", "b+a"]).analyses("yxy") == ["yXYZ"] and Z.CategoryTransducer(lexicon, ["a+b", "b+a"]).analyses("xyx") == []
    assert Z.CategoryTransducer(lexicon, ["a+b", "b+a"], pairwise=True).analyses("xyx") == ["XyX"]
    assert Z.parse_category_lexicon("a\tx\tX\nb\t(y)\tz\n") == ([("a", "x", "X")], ["b\t(y)\tz"]) and Z.parse_category_grammar("# c\na+b\n\n") == ["a+b"]


def test_segmenter_learns_saves_and_reads(spark, tmp_path):
    rng = np.random.default_rng(1)
    words = [("un" if k % 2 else "") + "".join(rng.choice(list("bdgaeo"), 5)) for k in range(200)]
    gold = spark.createDataFrame([(w, "un|" + w[2:] if w.startswith("un") else w) for w in words], "form string, seg string")
    c = X.character_features(gold, spark.createDataFrame([("un", "P")], "form string, tags string"), spark.createDataFrame([("un", 5)], "form string, freq long"))
    model = M.fit(M.boundary_labels(c, gold), ["prefix", "c"], ["k"], depth=3, rounds=3)
    M.save(model, f"file://{tmp_path}/m")
    got = M.segment(M.probability(M.load(f"file://{tmp_path}/m"), c), fixed=spark.createDataFrame([(words[0], "z|z")], "form string, seg string"))
    right = {r.form: r.seg for r in gold.collect()} | {words[0]: "z|z"}
    assert {r.form: r.seg for r in got.collect()} == right
    assert next(iter(M.importances(model))) in ("prefix", "k")
    assert M.search(M.boundary_labels(c, gold), ["prefix"], ["k"], [2], [2]).stages


def test_binding_strategies(spark):
    u = spark.createDataFrame([("d", i, w) for i, w in enumerate("the cat of it the x".split())], "doc_id string, i int, tok string")
    b = spark.createDataFrame([("the", 9, 1, 0.9), ("of", 1, 1, 0.5)], "form string, n_bound long, n_not_bound long, p double")
    g = spark.createDataFrame([("thecat", 3)], "form string, freq long")
    f = X.binding_features(u, g, b, b, spark.createDataFrame([], "form string, tags string"), ["of"])
    p = {s: [r.p for r in M.bind(f, s).orderBy("i").collect()] for s in ("naive", "table", "stacked")}
    assert p["naive"] == [0.0] * 6 and p["table"] == [0.9, 0.0, 0.5, 0.0, 0.9, 0.0] and p["stacked"][1] == 0.5
    assert f.orderBy("i").first().combined_count == 3
    assert B.text_with_separators(M.bind(f, "table"), "p").first().text == "thecat_of_it_thex"
    with pytest.raises(ValueError, match="unknown strategy"):
        M.bind(f, "lstm")
    rows = f.withColumn("label", (F.col("morph_bound") > 0).cast("double"))
    model = M.fit(rows, ["first"], ["morph_bound", "morph_p", "length"], "logistic")
    assert M.bind(f, "logistic", model).where("p BETWEEN 0 AND 1").count() == 6


def test_detokenization_is_transitive():
    assert B.merge_flags(["a", "b", "c", "."], {"a", "ab"}, {"."}) == [0, 0, 0, 1] and B.merge_flags([], set(), set()) == []


def test_broken_breaks_wait_for_words(spark):
    rows = [("d", i, p, g, b) for i, (p, g, b) in enumerate([("N", 0, True), ("PUNCT", 1, True), ("N", 2, False), ("ADV", 3, True), ("N", 4, False)])]
    u = spark.createDataFrame(rows, "doc_id string, i int, pos string, grp int, break boolean")
    assert [r.new_break for r in B.repaired_breaks(u, bad=["ADV"]).orderBy("i").collect()] == [True, False, True, False, False]


def test_spans_can_be_strict(spark):
    e = spark.createDataFrame([("d", 0, "</a>", "a", "close"), ("d", 1, "<a>", "a", "open"), ("d", 2, "</a>", "a", "close")], "doc_id string, pos int, raw string, tag string, kind string")
    assert [(r.st, r.en) for r in markup.paired_spans(e, "doc_id").collect()] == [(1, 2)]
    with pytest.raises(Exception, match="unmatched"):
        markup.paired_spans(e, "doc_id", strict=True).collect()


def test_nested_attributes(spark):
    text = '<norm norm="ab" lang="x">\n<morph morph="a" lang="y">\na\n</morph>\n</norm>\n<norm norm="c" lang="z">\nc\n</norm>'
    e = S.parse_sgml(spark.createDataFrame([("d", text)], "doc_id string, text string"))
    got = sgml.drop_if_nested_has(e, "norm", "morph", "lang").where("kind = 'open' AND tag = 'norm'").orderBy("line_no").collect()
    assert [r.attrs.get("lang") for r in got] == [None, "z"]
    assert sgml.event_text(sgml.drop_elements(e, "morph")).first().text.count("morph") == 0


def test_rare_words_are_thinned(spark):
    words = spark.createDataFrame([(f"w{i}",) for i in range(2000)], "word string")
    counts = words.where("word < 'w2'").withColumn("n", F.lit(5))
    kept = L.without_rare(words, counts)
    assert 0.05 < 1 - kept.join(counts, "word", "left_anti").count() / words.join(counts, "word", "left_anti").count() < 0.15 and kept.join(counts, "word").count() == counts.count()


def test_step_log():
    from lectern.plans.steplog import StepLog

    log = StepLog(quiet=True)
    with log.step("one"):
        pass
    with pytest.raises(KeyError), log.step("two"):
        raise KeyError
    assert [n for n, _ in log.seconds] == ["one", "two"] and log.total() >= 0


def test_document_names_and_checked_documents(spark):
    docs = spark.createDataFrame([("d", "# newdoc id = a b\n1\tx\n\n# newdoc id = c\n"), ("e", "x")], "doc_id string, text string")
    assert [list(r[0]) for r in docs.select(C.document_names(F.col("text"))).collect()] == [["a b", "c"], []]
    tt = spark.createDataFrame([("d", '<meta tagging="gold">\nx\n</meta>'), ("e", '<meta tagging="automatic">\nx\n</meta>'), ("f", "x")], "doc_id string, text string")
    assert [r.doc_id for r in sgml.documents_with(S.parse_sgml(tt), "tagging", ["gold", "checked"]).collect()] == ["d"]


def test_unseen_categories_are_gated(spark):
    seen, new = spark.createDataFrame([("a",)], "c string"), spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert sorted(str(r.c) for r in X.gated(new, seen, ["c"]).collect()) == ["_", "_", "a"]


def test_grammar_or_model(spark):
    rows = spark.createDataFrame([(0.9, "a|b", "ab"), (0.05, "a|b", "ab"), (0.9, "ab", "a|b")], "p double, seg string, model_seg string")
    assert [r.chosen for r in M.accept_grammar(rows).collect()] == ["a|b", "ab", "a|b"]


def test_long_sequences_go_round_in_blocks(spark):
    from lectern.operators.sequences import circular

    lengths = {1: 1, 2: 2, 3: 3, 4: 25}
    u = spark.createDataFrame([(k, i, f"{k}.{i}") for k, n in lengths.items() for i in range(n)], "k int, i int, t string")
    for block in (4, 5, 4096):
        got = circular(u, "t", [-3, -1, 2], "k", "i", block).collect()
        assert len(got) == sum(lengths.values())
        for r in got:
            n = lengths[r.k]
            assert (r["t-3"], r["t-1"], r["t+2"]) == tuple(f"{r.k}.{(r.i + d) % n}" for d in (-3, -1, 2)), (block, r)


def test_capitals_come_back(spark):
    from lectern.functions.text import decode_capitals, encode_capitals

    texts = ["aBc", "~", "A~b~~", "É~Ω", "", "~A~"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("m", encode_capitals(F.col("t")))
    assert [r[0] for r in df.select(decode_capitals(F.col("m"))).collect()] == texts and df.where("t = 'aBc'").first().m == "ab~c"
