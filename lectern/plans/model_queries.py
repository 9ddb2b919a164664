"""Queries of features and learned steps; what is learned has no SQL, its features do."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import features as X
from lectern.operators import lexicon as L
from lectern.operators import models as M
from lectern.operators import segmentation as G
from lectern.operators import sequences as S
from lectern.plans.conll_queries import TREE, tree_tokens
from lectern.plans.norm_queries import BENCH
from lectern.plans.queries import TOK, _tok, docs_units, query, table
from lectern.plans.seg_queries import _RULED, GRAMMAR

_LEX = f"""{BENCH}, w AS (SELECT lower(tok) AS form, count(*) AS freq FROM bt GROUP BY 1), lx AS (SELECT lower(tok) AS form, string_agg(DISTINCT CASE WHEN i % 2 = 0 THEN 'N' ELSE 'V' END, '|' ORDER BY CASE WHEN i % 2 = 0 THEN 'N' ELSE 'V' END) AS tags FROM bt GROUP BY 1)"""


def _lexicon(spark, d):
    u = S.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("form"), F.expr("CASE WHEN i % 2 = 0 THEN 'N' ELSE 'V' END").alias("pos"))
    return X.tag_table(u), u.groupBy("form").agg(F.count("*").alias("freq"))


def _characters(spark, d, types):
    return X.character_features(types, *_lexicon(spark, d))


@query(f"""WITH {_tok()}, {_LEX}, t AS (SELECT DISTINCT lower(tok) AS form FROM tok), c AS (SELECT form, length(form) AS n, unnest(range(length(form)))::INT AS k FROM t)
SELECT c.form, k, n, CASE WHEN k >= 2 THEN c.form[k - 1] ELSE '_' END AS "c-2", CASE WHEN k + 2 < n THEN contains('aeiou', c.form[k + 3])::INT ELSE -1 END AS "v+2", coalesce(p.tags, '_') AS prefix, coalesce(s.tags, '_') AS suffix, coalesce(b.tags, '_') AS back_2, coalesce(a.tags, '_') AS ahead_3,
coalesce(fp.freq, 0)::DOUBLE * coalesce(fs.freq, 0)::DOUBLE / (coalesce(fw.freq, 0)::DOUBLE + 1e-10) AS freq_ratio
FROM c LEFT JOIN lx p ON p.form = c.form[1:k + 1] LEFT JOIN lx s ON s.form = CASE WHEN k < n - 1 THEN c.form[k + 2:] END LEFT JOIN lx b ON b.form = CASE WHEN k >= 2 THEN c.form[k - 1:k + 1] END LEFT JOIN lx a ON a.form = CASE WHEN k + 3 < n THEN c.form[k + 1:k + 4] END
LEFT JOIN w fp ON fp.form = c.form[1:k + 1] LEFT JOIN w fs ON fs.form = CASE WHEN k < n - 1 THEN c.form[k + 2:] END LEFT JOIN w fw ON fw.form = c.form""")
def q117_character_features(spark, d):
    """Characters of all distinct words with what the lexicon says of the parts that meet there."""
    c = _characters(spark, d, docs_units(spark, d).select(F.lower("tok").alias("form")))
    return c.select("form", "k", "n", "c-2", "v+2", "prefix", "suffix", "back_2", "ahead_3", "freq_ratio")


@query(f"""{TOK} SELECT doc_id, i, coalesce(lag(tok)[1] OVER o, '_') AS prev_first, coalesce(lag(length(tok)) OVER o, 0) AS prev_len, coalesce(lead(tok) OVER o, '_')[-1] AS next_last FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)""".replace("coalesce(lag(tok)[1] OVER o, '_')", "coalesce(lag(tok) OVER o, '_')[1]"))
def q118_context_features(spark, d):
    u = docs_units(spark, d).withColumnRenamed("tok", "form")
    return X.context_features(u).select("doc_id", "i", "prev_first", "prev_len", "next_last")


@query(f"""{TOK}, {_RULED}, t AS (SELECT DISTINCT lower(tok) AS word FROM tok), s AS (SELECT t.word, coalesce(r.seg, t.word) AS seg FROM t LEFT JOIN r USING (word)),
x AS (SELECT *, CASE WHEN length(word) > 2 THEN list_filter(string_split(word[2:-2], ''), lambda c: contains('aeiou', c) AND c <> '') ELSE [] END AS v FROM s)
SELECT word, length(replace(seg, '|', '')) AS length, len(string_split(seg, '|')) - 1 AS pieces, unicode(word) AS first, unicode(word[-1]) AS last, CASE WHEN len(v) > 0 THEN unicode(v[1]) ELSE 0 END AS first_vowel FROM x""")
def q119_arbitration_features(spark, d):
    """Numbers that say how far a grammar's segmentation can be trusted."""
    t = docs_units(spark, d).select(F.lower("tok").alias("word")).distinct()
    g = G.grammar_segment(t, GRAMMAR, "word").withColumn("seg", F.coalesce("seg", "word"))
    return X.arbitration_features(g, vowels="aeiou").select("word", F.col("length").cast("long"), F.col("pieces").cast("long"), "first", "last", "first_vowel")


@query(f"""WITH {_tok()}, {_LEX}, y AS (SELECT lower(tok) AS form, count(*) FILTER (WHERE i % 3 = 0) AS n_bound, count(*) FILTER (WHERE i % 3 <> 0) AS n_not FROM bt GROUP BY 1), z AS (SELECT lower(tok)[-3:] AS form, count(*) FILTER (WHERE i % 3 = 0) AS n_bound, count(*) FILTER (WHERE i % 3 <> 0) AS n_not FROM bt GROUP BY 1),
t AS (SELECT doc_id, i, lower(tok) AS tok, lower(lead(tok) OVER (PARTITION BY doc_id ORDER BY i)) AS nx FROM tok)
SELECT doc_id, i, coalesce(g.freq, 0)::BIGINT AS group_count, CASE WHEN nx IS NULL THEN 0 ELSE coalesce(c.freq, 0) END::BIGINT AS combined_count, coalesce(y.n_bound, 0) AS morph_bound, coalesce(z.n_not, 0) AS ngram_not_bound, coalesce(y.n_bound / (y.n_bound + y.n_not), 0.5::DOUBLE) AS morph_p, coalesce(lx.tags, '_') AS tags, (tok IN ('of', 'in', 'de'))::INT AS is_prep
FROM t LEFT JOIN w g ON g.form = tok LEFT JOIN w c ON c.form = tok || nx LEFT JOIN y ON y.form = tok LEFT JOIN z ON z.form = tok[-3:] LEFT JOIN lx ON lx.form = tok""")
def q120_binding_features(spark, d):
    """What tables of groups, tokens and endings say of whether a token is bound to the next."""
    lexicon, freq = _lexicon(spark, d)
    b = S.units(table(spark, d, "benchmark"), "item_id").withColumn("form", F.lower("tok")).withColumn("bound", F.col("i") % 3 == 0)
    stats = lambda form: b.groupBy(form.alias("form")).agg(F.sum(F.col("bound").cast("long")).alias("n_bound"), F.sum((~F.col("bound")).cast("long")).alias("n_not_bound")).withColumn("p", F.expr("n_bound / (n_bound + n_not_bound)"))
    u = docs_units(spark, d).withColumn("tok", F.lower("tok"))
    f = X.binding_features(u, freq, stats(F.col("form")), stats(F.right(F.col("form"), F.lit(3))), lexicon, ["of", "in", "de"])
    return f.select("doc_id", "i", "group_count", "combined_count", "morph_bound", "ngram_not_bound", "morph_p", "tags", "is_prep")


@query(f"""WITH {_tok()}, {_LEX}, t AS (SELECT DISTINCT lower(tok) AS form FROM tok), c AS (SELECT form, unnest(range(1, length(form)))::INT AS m FROM t),
r AS (SELECT c.form, arg_max(x.form, m) AS right_sub, max(m) / length(c.form) AS right_share FROM c JOIN lx x ON x.form = right(c.form, m) GROUP BY c.form), l AS (SELECT c.form, arg_max(x.form, m) AS left_sub FROM c JOIN lx x ON x.form = left(c.form, m) GROUP BY c.form)
SELECT t.form, right_sub, right_share, left_sub FROM t LEFT JOIN r USING (form) LEFT JOIN l USING (form)""")
def q121_longest_known_ends(spark, d):
    t = docs_units(spark, d).select(F.lower("tok").alias("form")).distinct()
    return X.longest_known_ends(t, _lexicon(spark, d)[0]).select("form", "right_sub", "right_share", "left_sub")


@query(f"""{TREE}, f AS (SELECT lemma FROM t GROUP BY lemma ORDER BY count(*) DESC, lemma LIMIT 100), x AS (SELECT *, lag(pos, 2) OVER o AS a, lead(pos) OVER o AS b, last_value(CASE WHEN pos = 'PUNCT' THEN tok_id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY tok_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY tok_id))
SELECT doc_id, tok_id::INT AS i, CASE WHEN lemma IN (SELECT lemma FROM f) THEN lemma ELSE pos END AS word, coalesce(tok_id - l, -1) AS since, coalesce(a, '_') AS "tag-2", coalesce(b, '_') AS "tag+1" FROM x""")
def q122_sentence_features(spark, d):
    """Words of the hundred most frequent, tags of the others, distances and neighbours."""
    from lectern.operators.metrics import most_common

    t = tree_tokens(spark, d)
    frequent = most_common(t.select(F.col("lemma").alias("word")), "word")
    f = X.sentence_features(t.select("doc_id", F.col("tok_id").alias("i"), F.col("lemma").alias("tok"), "pos"), frequent)
    return f.select("doc_id", "i", "word", "since", "tag-2", "tag+1")


@query(f"""WITH {_tok()}, {BENCH}, x AS (SELECT lower(tok) AS w, CASE WHEN i % 3 = 0 THEN 'A' ELSE 'B' END AS tag, 1 + i % 2 AS f FROM bt), n AS (SELECT w, tag, sum(f) AS n FROM x GROUP BY ALL), b AS (SELECT w, arg_min(tag, (-n, tag)) AS tag FROM n GROUP BY w)
SELECT doc_id, i, coalesce(tag, 'UNKNOWN') AS tag FROM tok LEFT JOIN b ON w = lower(tok)""")
def q123_lexicon_tagger(spark, d):
    """Each word's most frequent tag in a lexicon, through the registry of annotators."""
    lexicon = S.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("word"), F.expr("CASE WHEN i % 3 = 0 THEN 'A' ELSE 'B' END").alias("tag"), (1 + F.col("i") % 2).alias("freq"))
    registry = M.Registry().add(M.lexicon_tagger(lexicon)).add(M.chain_parser())
    tagged = registry.get("tagger", "lexicon").run(docs_units(spark, d).withColumn("word", F.lower("tok")))
    return tagged.select("doc_id", "i", "tag")


@query(f"""{TREE} SELECT doc_id, sent, id, id - 1 AS head, CASE WHEN id = 1 THEN 'root' ELSE 'dep' END AS func FROM t""")
def q124_chain_parser(spark, d):
    return M.chain_parser().run(tree_tokens(spark, d)).select("doc_id", "sent", "id", "head", "func")


LEXICON_ROWS = "CASE WHEN i % 4 = 0 THEN 'PTC' WHEN i % 4 = 1 THEN 'CONJ' WHEN i % 4 = 2 THEN 'PREP' ELSE 'N' END"


@query(f"""{TOK}, x AS (SELECT lower(tok) AS w, {LEXICON_ROWS} AS tag FROM tok), o AS (SELECT w, tag, CASE WHEN w = 'the' AND tag = 'PTC' THEN 'Greek' WHEN w = 'of' AND tag = 'CONJ' THEN 'Greek' WHEN w = 'of' AND tag = 'PREP' THEN NULL WHEN w IN ('the', 'of', 'and') THEN 'native' END AS origin FROM x)
SELECT origin, tag, count(*) AS n FROM o GROUP BY ALL""")
def q125_origin_exceptions(spark, d):
    """Origins that depend on the tag."""
    lexicon = spark.createDataFrame([("the", "native"), ("of", "native"), ("and", "native")], "form string, lang string")
    words = docs_units(spark, d).select(F.lower("tok").alias("word"), F.expr(LEXICON_ROWS).alias("tag"))
    out = L.origin_by_tag(L.origin(words, lexicon), [("the", "PTC", "Greek"), ("of", "CONJ", "Greek"), ("of", "PREP", None)])
    return out.groupBy("origin", "tag").agg(F.count("*").alias("n"))


@query(f"""{TOK}, x AS (SELECT doc_id, i, lower(tok) AS w, lag(lower(tok)) OVER o AS p, lead(lower(tok)) OVER o AS n FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)) SELECT doc_id, i, CASE WHEN w = 'the' AND n IN ('of', 'and') THEN 'THE-N' WHEN w = 'der' AND p IN ('and', 'und') THEN 'DER-P' ELSE w END AS lemma FROM x""")
def q126_lemmas_in_context(spark, d):
    """Lemmas that depend on what stands before or after."""
    u = docs_units(spark, d).withColumn("word", F.lower("tok")).withColumn("lemma", F.col("word"))
    return L.lemmas_in_context(u, [("the", "next", ["of", "and"], "THE-N"), ("der", "prev", ["and", "und"], "DER-P")]).select("doc_id", "i", "lemma")


def _boundary_model(spark, d):
    """Trees learned from the benchmark's words, which are cut behind their third letter if they have six or more."""
    types = S.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("form")).distinct()
    gold = types.withColumn("seg", F.expr("CASE WHEN length(form) >= 6 THEN concat(substring(form, 1, 3), '|', substring(form, 4)) ELSE form END"))
    rows = M.boundary_labels(_characters(spark, d, types), gold)
    return M.fit(rows, ["c", "c+1", "c-1"], ["k", "n", "freq_ratio"], depth=4, rounds=5)


@query()
def q127_segmenter(spark, d):
    """Every distinct word segmented by boosted trees over characters, with the confidence; learned, so without SQL."""
    c = _characters(spark, d, docs_units(spark, d).select(F.lower("tok").alias("form")))
    return M.segment(M.probability(_boundary_model(spark, d), c))


@query(f"WITH {BENCH}, x AS (SELECT DISTINCT lower(tok) AS w, length(tok) % 3 AS label FROM bt), n AS (SELECT label, count(*) AS n FROM x GROUP BY label) SELECT arg_min(label, (-n, label)) AS label, max(n) / sum(n) AS share FROM n")
def q128_majority_label(spark, d):
    x = S.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("w"), (F.length("tok") % 3).cast("long").alias("label")).distinct()
    return M.majority_label(x)
