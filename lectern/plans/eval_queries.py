"""Queries of the evaluation: gold and predicted values are formulas of the words on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import metrics as E
from lectern.plans.conll_queries import TREE, tree_tokens
from lectern.plans.queries import TOK, docs_units, query
from lectern.plans.sgml_queries import GROUPS, conversation_groups


@query(f"{TOK} SELECT lower(tok) AS word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, lower(tok))::INT AS rank FROM tok GROUP BY 1 ORDER BY n DESC, word LIMIT 100")
def q83_most_common(spark, d):
    """The hundred most frequent words."""
    return E.most_common(docs_units(spark, d).select(F.lower("tok").alias("word")), "word")


@query(f"""WITH {GROUPS}, s AS (SELECT array_to_string(units, '|') AS gold, CASE WHEN length(word) >= 8 THEN word[1:3] || '|' || word[4:] WHEN length(word) = 5 THEN word[1:2] || '|' || word[3:] ELSE word END AS pred FROM gu),
b AS (SELECT gold = pred AS same, unnest(string_split(array_to_string(list_transform(string_split(gold, '|'), lambda x, i: repeat('0', length(x) - 1) || CASE WHEN i = len(string_split(gold, '|')) THEN '.' ELSE '1' END), ''), '')) AS g,
  unnest(string_split(array_to_string(list_transform(string_split(pred, '|'), lambda x, i: repeat('0', length(x) - 1) || CASE WHEN i = len(string_split(pred, '|')) THEN '.' ELSE '1' END), ''), '')) AS p FROM s)
SELECT count(*) FILTER (WHERE g = '1' AND p = '1') AS tp, count(*) FILTER (WHERE g = '0' AND p = '1') AS fp, count(*) FILTER (WHERE g = '1' AND p = '0') AS fn, count(*) FILTER (WHERE g = '0' AND p = '0') AS tn, (SELECT count(*) FROM s) AS n, (SELECT count(*) FROM s WHERE gold = pred) AS perfect FROM b""")
def q84_boundary_counts(spark, d):
    """Boundaries found, missed and put in wrongly, and groups that are right in full."""
    pred = F.expr("CASE WHEN length(word) >= 8 THEN concat(substring(word, 1, 3), '|', substring(word, 4)) WHEN length(word) = 5 THEN concat(substring(word, 1, 2), '|', substring(word, 3)) ELSE word END")
    return E.boundary_counts(conversation_groups(spark, d).select(F.array_join("units", "|").alias("gold"), pred.alias("pred")), "gold", "pred")


@query(f"""{TREE}, n AS (SELECT pos, count(*) AS n, count(*) FILTER (WHERE pos = CASE WHEN length(form) > 5 THEN 'N' WHEN form LIKE '%.' THEN 'PUNCT' ELSE 'V' END) AS ok FROM t GROUP BY pos)
SELECT sum(ok) / sum(n) AS accuracy, arg_min(pos, (-n, pos)) AS baseline_tag, max(n) / sum(n) AS baseline FROM n""")
def q85_tag_accuracy(spark, d):
    pred = F.expr("CASE WHEN length(form) > 5 THEN 'N' WHEN form LIKE '%.' THEN 'PUNCT' ELSE 'V' END")
    return E.tag_accuracy(tree_tokens(spark, d).withColumn("pred", pred), "pos", "pred")


@query(f"""{TOK}, x AS (SELECT tok AS orig, lower(translate(tok, '.,', '')) AS gold, CASE WHEN length(tok) % 5 = 0 THEN tok ELSE lower(translate(tok, '.,', '')) END AS pred FROM tok)
SELECT avg((gold = pred)::INT) AS accuracy, avg((gold = pred)::INT) FILTER (WHERE NOT regexp_matches(orig, '[\\[\\]…]')) AS no_lacunae, avg((orig = gold)::INT) AS trivial, avg((gold = pred)::INT) FILTER (WHERE orig <> gold) AS non_trivial FROM x""")
def q86_normalization_accuracy(spark, d):
    clean = F.lower(F.translate("tok", ".,", ""))
    x = docs_units(spark, d).select(F.col("tok").alias("orig"), clean.alias("gold"), F.when(F.length("tok") % 5 == 0, F.col("tok")).otherwise(clean).alias("pred"))
    return E.normalization_accuracy(x, "orig", "gold", "pred")


@query(f"{TOK} SELECT doc_id, i, min(p) AS confidence FROM (SELECT doc_id, i, 1 - (unnest(range(length(tok))) * 7 + i) % 10 / 20.0::DOUBLE AS p FROM tok) GROUP BY ALL")
def q87_confidence(spark, d):
    """A group is as sure as its least sure letter."""
    c = docs_units(spark, d).select("doc_id", "i", F.explode(F.sequence(F.lit(0), F.length("tok") - 1)).alias("k"))
    return E.confidence(c.withColumn("p", 1 - ((F.col("k") * 7 + F.col("i")) % 10) / F.lit(20.0)), ["doc_id", "i"], "p")


@query(f"""{TREE}, x AS (SELECT pos, CASE WHEN length(form) > 5 THEN 'N' ELSE pos END AS pred FROM t) SELECT pos, pred, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, pos, pred)::INT AS rank FROM x WHERE pos <> pred GROUP BY pos, pred""")
def q88_error_table(spark, d):
    return E.error_table(tree_tokens(spark, d).withColumn("pred", F.expr("CASE WHEN length(form) > 5 THEN 'N' ELSE pos END")), "pos", "pred")


@query(f"""{TREE}, x AS (SELECT doc_id, tok_id, form, (pos <> CASE WHEN length(form) > 9 THEN 'N' ELSE pos END)::INT AS wrong FROM t), y AS (SELECT *, max(wrong) OVER (PARTITION BY doc_id ORDER BY tok_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM x)
SELECT doc_id, tok_id, form, wrong FROM y WHERE near = 1""")
def q89_error_context(spark, d):
    """Wrong rows with one on each side."""
    x = tree_tokens(spark, d).withColumn("pred", F.expr("CASE WHEN length(form) > 9 THEN 'N' ELSE pos END"))
    return E.error_context(x, "pos", "pred", "doc_id", "tok_id").select("doc_id", "tok_id", "form", "wrong")


@query(f"""{TREE}, f AS (SELECT lemma, pos, arg_min(form, doc_id::HUGEINT * 4294967296 + tok_id) AS form FROM t GROUP BY ALL)
SELECT lemma, pos, f.form, count(*) FILTER (WHERE t.form <> f.form) AS n_discarded FROM f JOIN t USING (lemma, pos) GROUP BY ALL""")
def q90_first_forms(spark, d):
    """The first form of each lemma and tag, and how many others are discarded."""
    t = tree_tokens(spark, d).withColumn("line", F.struct("doc_id", "tok_id"))
    kept, gone = E.first_values(t, ["lemma", "pos"], "form", "line")
    n = gone.groupBy("lemma", "pos").agg(F.count("*").alias("n_discarded"))
    return kept.join(n, ["lemma", "pos"], "left").na.fill(0, ["n_discarded"])
