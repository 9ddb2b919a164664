"""Queries of segmentation and binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import binding as B
from lectern.operators import conll as C
from lectern.operators import lexicon as L
from lectern.operators import segmentation as X
from lectern.operators import sequences as S
from lectern.plans.queries import MORPHS, PREFIXES, SEGMENTS, TOK, _tok, _values, docs_units, query, rows, table
from lectern.plans.sgml_queries import GROUPS, conversation_groups, conversation_words, units_of_word

GRAMMAR = X.Grammar({"art": ["the", "der", "la"], "prep": ["an", "in", "of", "on"], "noun": ["and", "tion", "ing", "er", "the"]}, [["art", "noun"], ["prep", "art?", "noun"]])
_RULED = """g(c, k, f) AS (VALUES ('art', 1, 'the'), ('art', 2, 'der'), ('art', 3, 'la'), ('prep', 1, 'an'), ('prep', 2, 'in'), ('prep', 3, 'of'), ('prep', 4, 'on'), ('noun', 1, 'and'), ('noun', 2, 'tion'), ('noun', 3, 'ing'), ('noun', 4, 'er'), ('noun', 5, 'the')),
r0 AS (SELECT x.f || y.f AS word, x.f || '|' || y.f AS seg, (1, x.k, y.k, 0) AS o FROM g x, g y WHERE x.c = 'art' AND y.c = 'noun' UNION ALL SELECT x.f || y.f || z.f, x.f || '|' || y.f || '|' || z.f, (2, x.k, y.k, z.k) FROM g x, g y, g z WHERE x.c = 'prep' AND y.c = 'art' AND z.c = 'noun' UNION ALL SELECT x.f || y.f, x.f || '|' || y.f, (3, x.k, y.k, 0) FROM g x, g y WHERE x.c = 'prep' AND y.c = 'noun'),
r AS (SELECT word, arg_min(seg, o) AS seg FROM r0 GROUP BY word)"""


@query(f"{TOK}, {_RULED} SELECT w AS word, coalesce(seg, w) AS seg, n FROM (SELECT lower(tok) AS w, count(*) AS n FROM tok GROUP BY 1) LEFT JOIN r ON r.word = w")
def q97_grammar_segments(spark, d):
    """Words cut by the first rule of a grammar that covers them."""
    u = docs_units(spark, d).groupBy(F.lower("tok").alias("word")).agg(F.count("*").alias("n"))
    return X.grammar_segment(u, GRAMMAR, "word").select("word", F.coalesce("seg", "word").alias("seg"), "n")


_MORPH = " ".join(f"WHEN u = '{k}' THEN '{v}'" for k, v in MORPHS.items()) + " " + " ".join(f"WHEN starts_with(u, '{p}') AND length(u) >= {len(p) + 2} THEN '{p}-' || substr(u, {len(p) + 1})" for p in PREFIXES)
AMBIGUOUS = [("theand", "theand", "the|and"), ("ander", "ander", "and|er")]
LITERAL = {"de|la": "dela"}


@query(f"""WITH p0 AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '<[^<>]*>|[^<]+|<'), lambda x: CASE WHEN starts_with(x, '<') AND ends_with(x, '>') THEN translate(x, ' _', chr(57344) || chr(57345)) ELSE x END) AS p FROM documents),
g0 AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(array_to_string(p, ''), '[ _\\n\\t\\r]+'), lambda x: x <> ''), lambda x: translate(x, chr(57344) || chr(57345), ' _')) AS g FROM p0),
tok AS (SELECT doc_id, unnest(g) AS tok, unnest(range(len(g)))::INT AS i FROM g0), {_RULED}, w AS (SELECT doc_id, i, tok AS dirty, lower(translate(translate(regexp_replace(tok, '<[^>]*>', '', 'g'), '|-', '□■'), '[]*#%&$^~̄̅', '')) AS norm FROM tok),
s(norm, seg) AS (VALUES {_values(SEGMENTS)}), x AS (SELECT w.doc_id, w.i, dirty, w.norm, coalesce(s.seg, r.seg, w.norm) AS seg FROM w LEFT JOIN s ON s.norm = w.norm LEFT JOIN r ON r.word = w.norm AND length(w.norm) > 1),
y AS (SELECT doc_id, i, dirty, norm, CASE WHEN norm = 'theand' AND seg NOT IN ('theand', 'the|and') THEN 'theand' WHEN norm = 'ander' AND seg NOT IN ('ander', 'and|er') THEN 'ander' ELSE seg END AS seg FROM x),
m AS (SELECT doc_id, i, norm, array_to_string(list_transform(string_split(seg, '|'), lambda u: CASE {_MORPH} ELSE u END), '|') AS seg FROM y),
n AS (SELECT *, lag(seg) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM m)
SELECT norm, CASE WHEN seg = 'an|the' AND string_split(p, '|')[-1] IN ('the', 'of') THEN 'anthe' WHEN seg = 'de|la' THEN 'dela' ELSE replace(seg, 're-ed', 'reed') END AS seg, count(*) AS n FROM n GROUP BY ALL""")
def q98_analysis(spark, d):
    """Groups of whole texts through table, grammar, listed alternatives, morphs and overrides."""
    alternatives = rows(spark, AMBIGUOUS, "norm string, a string, b string").select("norm", F.array("a", "b").alias("alts"))
    stack = X.Stack(
        rows(spark, SEGMENTS, "norm string, seg string"), GRAMMAR, alternatives=alternatives, morphs=lambda u: L.prefix_morphs(u, MORPHS, PREFIXES),
        context_rules=(("an|the", "prev", ["the", "of"], "anthe"),), literal=LITERAL, substrings=(("re-ed", "reed"),),
    )
    return X.analyze(table(spark, d, "documents"), stack).groupBy("norm", "seg").agg(F.count("*").alias("n"))


@query(f"""WITH {GROUPS}, x AS (SELECT DISTINCT word FROM g WHERE length(word) >= 6) SELECT word, word[1:3] || '|' || word[4:] AS same, word[1:3] || '|' || word[4:] AS longer, substr(word, 1, 1) || '*' || substr(word, 2, 2) || '|' || substr(word, 4) AS dirty FROM x""")
def q99_realigned(spark, d):
    """Boundaries put into forms that differ: from the form itself, from one with an ending more, and into one with marks."""
    x = conversation_groups(spark, d).where("length(word) >= 6").select("word").distinct()
    seg = F.concat(F.substring("word", 1, 3), F.lit("|"), F.substring("word", 4, 1 << 20))
    x = x.withColumn("seg", seg).withColumn("more", F.concat("seg", F.lit("ⲁⲃ"))).withColumn("marked", F.concat(F.substring("word", 1, 1), F.lit("*"), F.substring("word", 2, 1 << 20)))
    return x.select("word", X.align_column("word", "seg").alias("same"), X.align_column("word", "more").alias("longer"), X.attach(F.col("marked"), F.col("seg"), "*").alias("dirty"))


BOUND = [("the", 0.9, False), ("of", 0.7, False), ("la", 0.4, False), ("der", 0.8, True), ("le", 0.5, True)]


def _detok_sql(forms: str, name: str) -> str:
    return f"""f{name} AS (SELECT *, coalesce(lag(lower(tok) IN ({forms})) OVER (PARTITION BY doc_id ORDER BY i), false) AND tok NOT IN ('.', ',', ':', ';', '·', '⳩', '⁘') AS j FROM tok),
g{name} AS (SELECT doc_id, tok, i, sum(CASE WHEN j THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM f{name}), m{name} AS (SELECT doc_id, grp, string_agg(lower(tok), '' ORDER BY i) AS form FROM g{name} GROUP BY ALL HAVING count(*) > 1)"""


@query(f"""{TOK}, {_detok_sql("'the', 'of'", 1)}, {_detok_sql("'the', 'of', 'der', 'le'", 2)} SELECT 1 AS level, form, count(*) AS n FROM m1 GROUP BY form UNION ALL SELECT 2, form, count(*) FROM m2 GROUP BY form""")
def q100_detok_levels(spark, d):
    """Groups merged behind proclitics, without and with the aggressive rows of the table."""
    t = rows(spark, BOUND, "form string, p double, aggressive boolean")
    u = S.words(table(spark, d, "documents")).select(F.transform("words", lambda w: F.lower(w)).alias("words"))
    out = None
    for level in (1, 2):
        r = u.select(F.explode(B.merged_forms(F.col("words"), t, level)).alias("form")).groupBy("form").agg(F.count("*").alias("n")).select(F.lit(level).alias("level"), "form", "n")
        out = r if out is None else out.unionAll(r)
    return out


@query(r"""WITH l AS (SELECT conv_id, turn, list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(text, '.', ' .'), '·', ' ·'), ':', ' : '), '(\[F[^\]]+\]|\|F[^|]+\||\([^)]+\)|[aeA-Z0-9|])', '', 'g'), '\n+', chr(10), 'g'), ' +', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, array_to_string(list_transform(l, lambda x: CASE WHEN x LIKE '%n' THEN x[:-2] ELSE x || ' ' END), '') AS text FROM l""")
def q101_raw_lines(spark, d):
    """Raw text without foreign matter, its lines joined, those that end in a hyphen (here: n) without it."""
    foreign = [*B.FOREIGN[:3], "[aeA-Z0-9|]"]
    c = table(spark, d, "conversations").where("text IS NOT NULL")
    return c.select("conv_id", "turn", B.joined_lines(B.clean_raw(F.col("text"), foreign), "n").alias("text"))


@query(f"""WITH {GROUPS}, o AS (SELECT key, string_agg(word, ' ' ORDER BY grp) AS orig, string_agg(array_to_string(units, '_'), '_' ORDER BY grp) AS gold FROM gu GROUP BY key),
c AS (SELECT key, grp, unnest(string_split(word, '')) AS c, unnest(range(length(word))) AS k, length(word) AS n, max(grp) OVER (PARTITION BY key) AS last FROM g)
SELECT key, (row_number() OVER (PARTITION BY key ORDER BY grp, k) - 1)::INT AS n, c, k = n - 1 AND grp < last AS orig_sep, (k = n - 1 AND grp < last) OR (n >= 6 AND k = 2) AS gold_sep FROM c""")
def q102_aligned_letters(spark, d):
    """Two bindings of one text, letter by letter."""
    gold = F.array_join(F.transform("words", lambda w: F.array_join(units_of_word(w), "_")), "_")
    docs = conversation_words(spark, d).where("size(words) > 0").select("key", F.array_join("words", " ").alias("orig"), gold.alias("gold"))
    docs = docs.withColumn("orig", B.checked_same_letters(F.col("orig"), F.col("gold")))
    return B.aligned_letters(docs, "orig", "gold", "key")


@query(f"""{TOK} SELECT doc_id, regexp_replace(string_agg(tok || CASE WHEN i % 3 = 0 THEN '' ELSE '_' END, '' ORDER BY i), '_$', '') AS text FROM tok GROUP BY doc_id""")
def q103_bound_text(spark, d):
    """Tokens bound to the next where that is probable."""
    u = docs_units(spark, d).withColumn("p", F.when(F.col("i") % 3 == 0, 0.9).otherwise(0.5))
    return B.text_with_separators(u, "p")


@query(f"{TOK}, n AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM tok) SELECT doc_id, i, CASE WHEN i + 1 <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM n")
def q104_proportional_split(spark, d):
    return B.proportional_split(docs_units(spark, d)).select("doc_id", "i", "part")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 10 = 0 AS test FROM documents")
def q105_systematic_split(spark, d):
    """Each tenth document is for the test."""
    return B.systematic_split(table(spark, d, "documents").select("doc_id"), 10, ["doc_id"])


@query(f"{TOK}, t AS (SELECT DISTINCT lower(tok) AS w FROM tok WHERE doc_id IN (SELECT doc_id FROM labels)) SELECT lower(tok) AS word, count(*) AS n FROM tok WHERE lower(tok) NOT IN (SELECT w FROM t) GROUP BY 1")
def q106_train_minus_test(spark, d):
    """Words that no labelled document has."""
    u = docs_units(spark, d).withColumn("word", F.lower("tok"))
    test = u.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return B.train_rows(u, test, "word").groupBy("word").agg(F.count("*").alias("n"))


@query(f"{_tok('benchmark', 'item_id').replace('a AS', 'WITH a AS', 1)} SELECT item_id % 7 AS corpus, string_agg(tok, '_' ORDER BY item_id, i) AS text FROM tok GROUP BY 1")
def q107_corpus_text(spark, d):
    u = S.units(table(spark, d, "benchmark"), "item_id").withColumn("corpus", F.col("item_id") % 7)
    return B.corpus_text(u, "corpus", ["item_id", "i"], "tok")


@query(f"""{TOK}, w AS (SELECT doc_id, i, tok, lag(length(tok)) OVER o AS a, lead(length(tok)) OVER o AS b, lead(length(tok), 2) OVER o AS c FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)) SELECT doc_id, i, coalesce(a, 0) AS "len_-1", coalesce(b, 0) AS len_1, coalesce(c, 0) AS len_2 FROM w""")
def q108_windowed_features(spark, d):
    u = docs_units(spark, d)
    return B.windowed(u, F.length("tok").cast("long"), "len", 1, 2, 0, skip_self=True).drop("tok")


@query(f"""{TOK}, s AS (SELECT *, coalesce(sum(CASE WHEN tok LIKE '%.' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM tok),
k AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, s ORDER BY i) - 1) // 12 AS k FROM s) SELECT doc_id, i, (dense_rank() OVER (PARTITION BY doc_id ORDER BY s, k) - 1)::INT AS chunk FROM k""")
def q109_capped_chunks(spark, d):
    """Sentences, those of more than twelve words in pieces."""
    words = S.words(table(spark, d, "documents"))
    t = C.sentence_arrays(words, lambda w: F.endswith(w, F.lit(".")), also=["places"])
    c = t.select("doc_id", "places", F.posexplode(B.chunk_arrays(F.col("s"), 12)).alias("chunk", "c"))
    c = c.select("doc_id", "places", "chunk", "c.start", F.posexplode("c.words").alias("at", "tok")).withColumn("at", F.col("start") + F.col("at"))
    return c.select("doc_id", F.coalesce(F.get("places", F.col("at")), F.col("at")).alias("i"), "chunk")


@query(f"""{TOK}, x AS (SELECT *, i // 3 AS grp, tok LIKE '%.' AS b, max((tok LIKE '%.')::INT) OVER (PARTITION BY doc_id, i // 3) = 1 AS m FROM tok) SELECT doc_id, i, m AND i % 3 = 0 AS new_break FROM x""")
def q110_repaired_breaks(spark, d):
    """Sentence breaks inside groups of three move to the group's begin."""
    u = docs_units(spark, d).withColumn("grp", F.floor(F.col("i") / 3)).withColumn("break", F.endswith("tok", F.lit("."))).withColumn("pos", F.lit("N"))
    return B.repaired_breaks(u).select("doc_id", "i", "new_break")


CORRECTIONS = [("the|re", "THE|RE", "ART|N", "the|re", "Coptic|Greek"), ("der", "D", "ART", "d", "Coptic")]


@query(f"""{TOK}, c(k, j, orig, norm, tag, lemma, lang) AS (VALUES ('there', 0, 'the', 'THE', 'ART', 'the', NULL), ('there', 1, 're', 'RE', 'N', 're', 'Greek'), ('der', 0, 'der', 'D', 'ART', 'd', NULL))
SELECT doc_id, i, j AS unit_idx, orig, norm, tag, lemma, lang FROM tok JOIN c ON k = tok""")
def q111_corrections(spark, d):
    """Groups that corrections name, with the units these give them."""
    c = rows(spark, CORRECTIONS, "orig_group string, norms string, tags string, lemmas string, langs string")
    return X.corrected_units(docs_units(spark, d), c, col="tok")


@query(r"""WITH l AS (SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM conversations) SELECT conv_id || '-' || turn AS key, unnest(range(len(l)))::INT AS grp, unnest(l) AS norm FROM l""")
def q112_lines_as_units(spark, d):
    c = table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("key"), "text")
    return X.lines_as_units(c, "key")


@query(f"""{TOK}, t AS (SELECT DISTINCT lower(tok) AS w FROM tok), n AS (SELECT w FROM t WHERE length(w) = 3), v AS (SELECT w FROM t WHERE length(w) = 4),
k AS (SELECT t.w, arg_min(v.w || '-' || n.w, length(v.w)) AS m FROM t JOIN v ON v.w = t.w[1:4] JOIN n ON n.w = t.w[5:] WHERE length(t.w) = 7 GROUP BY t.w) SELECT t.w AS word, coalesce(m, t.w) AS morphs FROM t LEFT JOIN k USING (w)""")
def q113_compounds(spark, d):
    """Words made of a verb (here: a word of four letters) and a noun (of three)."""
    t = docs_units(spark, d).select(F.lower("tok").alias("word")).distinct()
    form = t.select(F.col("word").alias("form"))
    return X.compound_morphs(t, form.where("length(form) = 3"), form.where("length(form) = 4"))


@query(f"""WITH {GROUPS} SELECT key, string_agg(array_to_string(units, '|'), '_' ORDER BY grp) AS text FROM gu GROUP BY key""")
def q114_piped_text(spark, d):
    g = conversation_groups(spark, d).withColumn("seg", F.array_join("units", "|"))
    return X.piped(g, "key", "grp")


@query("""SELECT conv_id, turn, (list_filter(range(1, length(text) + 1), lambda i: NOT contains('|-_ ', text[i]))[5] - 1)::INT AS place FROM conversations""")
def q115_place_of_letter(spark, d):
    """Where the fifth letter stands when separators don't count."""
    return table(spark, d, "conversations").select("conv_id", "turn", B.place_without_separators(F.col("text"), F.lit(4)).alias("place"))


def q116_synthetic_splits(spark, d):
    """Groups parted at random behind prefixes and before suffixes; no SQL, as chance is a hash of the engine's own."""
    g = conversation_groups(spark, d)
    return B.synthetic_splits(g, ["the", "der"], ["ing", "tion"], ["key", "grp"]).select("key", "grp", "split")


query()(q116_synthetic_splits)
