"""Queries of normalization and lexicon derivation over the words of documents; tables come from the benchmark's words."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import normalization as Z
from lectern.operators import sequences as S
from lectern.plans.queries import _tok, _values, docs_units, query, rows, table

BENCH = _tok("benchmark", "item_id").replace("a AS", "ba AS", 1).replace("tok AS (", "bt AS (").replace("FROM a)", "FROM ba)")
_CLEAN = "CASE WHEN NOT regexp_matches({0}, '[()]') AND length({0}) > 1 THEN translate({0}, '[]', '') ELSE {0} END".format("lower(translate({}, ' #*%&$‴', ''))")


def _clean(x: str) -> str:
    return _CLEAN.replace("{}", x)


KEEP = ["der", "the"]
RULES = [("(^|_)un($|_)", "$1une$2"), ("eau($|_)", "o$1"), ("^th", "þ")]


@query(f"""WITH {_tok()}, {BENCH}, v AS (SELECT {_clean("tok")} AS orig, {_clean("tok[1:4]")} AS norm, item_id * 100000 + i AS line FROM bt),
c AS (SELECT orig, norm, count(*) AS n, min(line) AS l FROM v GROUP BY ALL), m AS (SELECT orig, arg_min(norm, (-n, l)) AS norm FROM c GROUP BY orig),
t AS (SELECT DISTINCT tok, {_clean("tok")} AS clean FROM tok), b AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(translate(clean, '|[]', ''), '([a-z])[·.□]([a-z])', '\\1\\2', 'g'), '([a-z])[·.□]([a-z])', '\\1\\2', 'g'), '([a-z])□+', '\\1', 'g') AS bare FROM t),
x AS (SELECT tok, clean, h.norm AS hit, coalesce(s.norm, bare) AS r FROM b LEFT JOIN m h ON h.orig = clean LEFT JOIN m s ON s.orig = bare),
n AS (SELECT tok, CASE WHEN clean IN ('der', 'the') THEN clean ELSE coalesce(hit, regexp_replace(regexp_replace(regexp_replace(r, '(^|_)un($|_)', '\\1une\\2', 'g'), 'eau($|_)', 'o\\1', 'g'), '^th', 'þ', 'g')) END AS norm FROM x)
SELECT norm, count(*) AS n FROM tok JOIN n USING (tok) GROUP BY norm""")
def q91_normalize(spark, d):
    """Words normalized by a table of votes, else by rewrites, but for those that stay as they are."""
    votes = S.units(table(spark, d, "benchmark"), "item_id").select(F.col("tok").alias("orig"), F.substring("tok", 1, 4).alias("norm"), (F.col("item_id") * 100000 + F.col("i")).alias("line"))
    out = Z.normalize_groups(docs_units(spark, d), "tok", votes, KEEP, RULES, letters="a-z")
    return out.groupBy("norm").agg(F.count("*").alias("n"))


LEXICON = [("art", "the", "the"), ("art", "der", "d"), ("art", "la", "le"), ("prep", "an", "on"), ("prep", "in", "inne"), ("prep", "of", "of"), ("noun", "and", "ande"), ("noun", "tion", "cion"), ("noun", "ing", "ynge"), ("noun", "the", "thee"), ("noun", "er", "er")]
SEQUENCES = ["art+noun", "prep+art+noun", "prep+noun", "noun"]


@query(f"""WITH {_tok()}, l(c, o, n) AS (VALUES {_values(LEXICON)}),
a AS (SELECT x.o || y.o AS orig, x.n || y.n AS norm FROM l x, l y WHERE (x.c = 'art' OR x.c = 'prep') AND y.c = 'noun' UNION SELECT x.o || y.o || z.o, x.n || y.n || z.n FROM l x, l y, l z WHERE x.c = 'prep' AND y.c = 'art' AND z.c = 'noun' UNION SELECT o, n FROM l WHERE c = 'noun'),
b AS (SELECT orig, CASE WHEN bool_or(orig = norm) THEN orig ELSE arg_max(norm, length(norm)) END AS norm, count(*) FILTER (WHERE length(norm) = (SELECT max(length(norm)) FROM a a2 WHERE a2.orig = a.orig)) AS ties FROM a GROUP BY orig)
SELECT word, coalesce(norm, word) AS norm, n FROM (SELECT lower(tok) AS word, count(*) AS n FROM tok GROUP BY 1) LEFT JOIN b ON orig = word""".replace("tok AS (SELECT doc_id, unnest(a) AS tok, unnest(range(len(a)))::INT AS i FROM a),", "tok AS (SELECT doc_id, unnest(a) AS tok FROM a0),").replace("a AS (SELECT doc_id, list", "a0 AS (SELECT doc_id, list", 1))
def q92_transducer(spark, d):
    """Words as chains of lexicon categories, each form giving its normal one; the word itself if that is an analysis, else the longest."""
    u = docs_units(spark, d).groupBy(F.lower("tok").alias("word")).agg(F.count("*").alias("n"))
    return u.join(Z.transduce(u, "word", Z.CategoryTransducer(LEXICON, SEQUENCES), "norm"), "word").select("word", "norm", "n")


_CLASSES = f"""WITH {_tok()}, {BENCH}, nouns AS (SELECT DISTINCT lower(tok) AS form FROM bt WHERE length(tok) % 2 = 0), verbs0 AS (SELECT DISTINCT lower(tok) AS form FROM bt WHERE length(tok) % 2 = 1),
verbs AS (SELECT * FROM verbs0 WHERE form NOT IN (SELECT form FROM nouns))"""


def _classes(spark, d):
    u = S.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("w"))
    nouns = Z.as_class(u.where("length(w) % 2 = 0"), "w")
    return nouns, Z.without(Z.as_class(u.where("length(w) % 2 = 1"), "w"), nouns)


@query(f"""{_CLASSES}, v AS (SELECT regexp_replace(form, '([^e]|^)i', '\\1ei', 'g') AS form, form AS norm FROM nouns WHERE regexp_matches(form, '([^e]|^)i')), w AS (SELECT form, min(norm) AS norm FROM v WHERE form NOT IN (SELECT form FROM nouns) AND form NOT IN (SELECT form FROM verbs) GROUP BY form),
n AS (SELECT form, form AS norm FROM nouns UNION ALL SELECT form, norm FROM w), p AS (SELECT lower(tok) AS orig, lower(tok)[1:4] AS norm FROM tok),
q AS (SELECT orig AS form, max(norm) AS norm FROM p WHERE NOT (starts_with(norm, 'h') AND NOT starts_with(orig, 'h')) AND norm IN (SELECT form FROM n) AND norm <> 'then' GROUP BY orig)
SELECT form, norm FROM n UNION ALL SELECT form, norm FROM q WHERE form NOT IN (SELECT form FROM n)""")
def q93_lexicon_variants(spark, d):
    """Nouns with their spelling variants that no verb has, and the attested forms of their norms."""
    nouns, verbs = _classes(spark, d)
    n = Z.with_variants(nouns, nouns, "([^e]|^)i", "$1ei", verbs)
    attested = docs_units(spark, d).select(F.lower("tok").alias("orig")).select("orig", F.substring("orig", 1, 4).alias("norm"))
    return Z.promoted(n, attested, forbidden=["then"], initial="h")


@query(f"""{_CLASSES}, loans AS (SELECT form FROM verbs WHERE length(form) >= 7), r AS (SELECT 'noun' AS category, form AS orig, form AS norm FROM nouns UNION ALL SELECT 'verb', form, form FROM verbs UNION ALL SELECT 'agent', 're' || form, 're' || form FROM verbs WHERE form NOT IN (SELECT form FROM loans) AND NOT starts_with(form, 're')
UNION ALL SELECT 'h_verb', form[2:], form FROM verbs WHERE starts_with(form, 'h') UNION ALL SELECT 'cluster', form, form FROM nouns WHERE regexp_matches(form, '^(?:[b-df-hj-np-tv-z]{{2}})') UNION ALL SELECT 'labial', form, form FROM nouns WHERE regexp_matches(form, '^(?:[bpm])'))
SELECT category, orig, norm FROM r WHERE NOT regexp_matches(orig || norm, '[ -]') AND orig <> 'the'""")
def q94_lexicon_classes(spark, d):
    """Classes derived from nouns and verbs: agents, forms without their first letter, clusters, labials."""
    nouns, verbs = _classes(spark, d)
    classes = {"noun": nouns, "verb": verbs, "agent": Z.derived_nouns(verbs, "re", verbs.where("length(form) >= 7")), "h_verb": Z.without_initial(verbs, "h"), "cluster": Z.initial_class(nouns, "[b-df-hj-np-tv-z]{2}"), "labial": Z.initial_class(nouns, "[bpm]")}
    return Z.lexicon_rows(classes, ["the"])


@query(f"""WITH {BENCH}, t AS (SELECT DISTINCT lower(tok) AS form FROM bt) SELECT form, CASE WHEN length(form) = 4 THEN 'f' WHEN length(form) % 2 = 0 THEN CASE WHEN form LIKE '%a' OR form LIKE '%sis' OR form LIKE '%e' THEN 'f' ELSE 'm' END WHEN length(form) % 3 <> 0 THEN 'm' END AS gender FROM t""")
def q95_loan_genders(spark, d):
    t = S.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("form")).distinct()
    t = t.select("form", (F.length("form") == 4).alias("known_f"), (F.length("form") % 2 == 0).alias("loan"), (F.length("form") % 3 == 0).alias("verb"))
    return Z.loan_genders(t, ("a", "e", "sis")).select("form", "gender")


@query("SELECT x AS form, y AS bare FROM (VALUES ('a(b)c', 'ac'), ('(x)', ''), ('plain', 'plain')) v(x, y)")
def q96_forms_without_context(spark, d):
    return rows(spark, [("a(b)c",), ("(x)",), ("plain",)], "form string").select("form", Z.without_context(F.col("form")).alias("bare"))
