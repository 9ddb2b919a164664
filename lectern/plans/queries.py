"""Registered queries of the annotation operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import conll as C
from lectern.operators import lexicon as L
from lectern.operators import markup as M
from lectern.operators import metrics as E
from lectern.operators import sequences as S

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def docs_units(spark: SparkSession, d: str) -> DataFrame:
    return S.units(table(spark, d, "documents"))


def rows(spark: SparkSession, data: list, schema: str) -> DataFrame:
    return spark.createDataFrame(data, schema)


def _tok(source: str = "documents", key: str = "doc_id") -> str:
    return rf"""a AS (SELECT {key}, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \n\t\r]+'), lambda x: x <> '') AS a FROM {source}),
tok AS (SELECT {key}, unnest(a) AS tok, unnest(range(len(a)))::INT AS i FROM a)"""


def _values(data: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in r) + ")" for r in data)


TOK = "WITH " + _tok()
# A small lexicon for the driver's invented prose; the package itself takes lexicons as DataFrames.
SEGMENTS = [("theand", "the|and"), ("ofthe", "of|the"), ("onthe", "on|the"), ("anat", "an|at"), ("andthe", "and|the"), ("inthe", "in|the"), ("theon", "the|on"), ("erst", "er|st"), ("dela", "de|la"), ("lela", "le|la")]
LEMMAS = [("is", "V", "be"), ("are", "V", "be"), ("was", "V", "be"), ("was", "V", "become"), ("the", "D", "the"), ("an", "D", "a"), ("des", "D", "de"), ("les", "D", "le"), ("la", "D", "le"), ("der", "D", "d")]
FIXES = [("the", "*", "DET"), ("the", "u", "NAME"), ("of", "*", "ADP"), ("on", "l", "PREP"), ("is", "*", "COP"), ("la", "*", "DET"), ("The", "t", "DETC")]
ORIGINS = [("the", "native"), ("th*", "north"), ("thr*", "west"), ("er*", "east"), ("*ing", "south"), ("*ering", "far"), ("*ment", "latin"), ("eau*", "gallic"), ("*ung", "rhine")]
PHRASES = ["the and", "of the", "and the", "is the", "the of", "on the the", "of the and", "the the", "le de", "de la", "in the and of"]
PREFIXES = ["anti", "un", "ent", "ver", "re", "be"]
MORPHS = {"reed": "reed", "the": "th-e"}
MARKERS = [("fr", ["le", "la", "les", "des", "une"]), ("de", ["der", "die", "das", "und"]), ("es", ["el", "los", "las", "que", "y"])]


@query(f"""{TOK}, seg(norm, seg) AS (VALUES {_values(SEGMENTS)}), t AS (SELECT lower(translate(tok, '.,', '')) AS norm FROM tok),
u AS (SELECT unnest(string_split(coalesce(seg, t.norm), '|')) AS unit FROM t LEFT JOIN seg ON seg.norm = t.norm WHERE t.norm <> '')
SELECT unit, count(*) AS n FROM u GROUP BY unit""")
def q01_min_slice(spark, d):
    """Groups, cleaned, segmented by a lexicon, counted by unit."""
    t = docs_units(spark, d).select(F.lower(F.translate("tok", ".,", "")).alias("norm")).where("norm != ''").groupBy("norm").agg(F.count("*").alias("n"))
    seg = t.join(rows(spark, SEGMENTS, "norm string, seg string"), "norm", "left").select(F.explode(F.split(F.coalesce("seg", "norm"), r"\|")).alias("unit"), "n")
    return seg.groupBy("unit").agg(F.sum("n").alias("n"))


@query(r"""SELECT doc_id, lower(translate(translate(regexp_replace(text, '<[^>]*>', '', 'g'), '|-', '□■'), '[]*#%&$^~̄̅', '')) AS clean,
CASE WHEN NOT regexp_matches(n, '[()]') AND length(n) > 1 THEN translate(n, '[]', '') ELSE n END AS norm
FROM (SELECT *, lower(translate(text, ' #*%&$‴', '')) AS n FROM documents)""")
def q02_clean_chars(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_group(F.col("text")).alias("clean"), T.clean_norm(F.col("text")).alias("norm"))


@query(r"""SELECT doc_id, CASE """ + " ".join(f"WHEN list_has_any(w, {m!r}) THEN '{n}'" for n, m in MARKERS) + r""" ELSE 'en' END AS profile
FROM (SELECT doc_id, regexp_split_to_array(lower(replace(text, '|', '')), '[ \n\t\r"_-]+') AS w FROM documents)""")
def q03_detect_profile(spark, d):
    return table(spark, d, "documents").select("doc_id", T.detect_profile(F.col("text"), MARKERS, "en").alias("profile"))


@query(r"""SELECT conv_id, turn, CASE WHEN text = '' THEN '' ELSE regexp_replace(array_to_string(list_transform(regexp_extract_all(text, '<[^>]*>?|[^<]+'), lambda x: CASE WHEN x[1] = '<' THEN x ELSE regexp_replace(x, '([.,:;])', ' \1 ', 'g') END), ''), ' +', ' ', 'g') END AS spaced FROM conversations""")
def q04_space_punct(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.space_punctuation(F.col("text")).alias("spaced"))


@query(f"""{TOK} SELECT c, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(tok, '[0-9]') THEN 'd' WHEN tok = upper(tok) AND tok <> lower(tok) AND NOT contains(tok, 'ß') THEN 'u' WHEN tok = lower(tok) THEN 'l'
WHEN tok[1] <> lower(tok[1]) AND tok[2:] = lower(tok[2:]) THEN 't' ELSE 'o' END AS c FROM tok) GROUP BY c""")
def q05_case_class(spark, d):
    return docs_units(spark, d).groupBy(T.case_class(F.col("tok")).alias("c")).agg(F.count("*").alias("n"))


@query(f"""{TOK} SELECT doc_id, count(*) FILTER (WHERE regexp_full_match(tok, '\\p{{P}}*')) AS n_all, count(*) FILTER (WHERE regexp_matches(tok, '\\p{{P}}')) AS n_any FROM tok GROUP BY doc_id""")
def q06_all_punct(spark, d):
    c = lambda x: F.sum(x.cast("long"))
    return docs_units(spark, d).groupBy("doc_id").agg(c(T.all_punctuation(F.col("tok"))).alias("n_all"), c(T.any_punctuation(F.col("tok"))).alias("n_any"))


@query(r"""WITH p AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') AS p FROM conversations)
SELECT conv_id, turn, array_to_string(list_transform(p, lambda x, i: repeat('0', length(x) - 1) || CASE WHEN i = len(p) THEN '0' ELSE '1' END), '') AS bits FROM p""")
def q07_boundary_vector(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.boundary_vector(F.col("text")).alias("bits"))


@query(r"""WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INT AS k FROM conversations),
p AS (SELECT conv_id, turn, k, line, sum(CASE WHEN k = 0 AND turn % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, k) AS page FROM l)
SELECT conv_id, turn, k, page::BIGINT AS page, row_number() OVER (PARTITION BY conv_id, page ORDER BY turn, k)::INT AS n, length(line) AS n_chars FROM p""")
def q08_line_numbers(spark, d):
    """Lines numbered from 1 in each page; a page begins with each even turn."""
    lines = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    w = Window.partitionBy("conv_id").orderBy("turn", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("page", F.sum(((F.col("k") == 0) & (F.col("turn") % 2 == 0)).cast("long")).over(w))
    return lines.select("conv_id", "turn", "k", "page", F.row_number().over(Window.partitionBy("conv_id", "page").orderBy("turn", "k")).alias("n"), F.length("line").alias("n_chars"))


@query(r"""SELECT conv_id, turn, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i = 1 OR starts_with(x, 'Th') THEN '<p/>' || x ELSE x END), chr(10)) AS marked FROM conversations""")
def q09_para_insert(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.insert_paragraphs(F.col("text"), "Th", "<p/>").alias("marked"))


@query(f"""{TOK}, c AS (SELECT lower(tok) AS key, tok, count(*) AS n, min(doc_id::HUGEINT * 4294967296 + i) AS f FROM tok GROUP BY ALL)
SELECT key, tok, n FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, f, tok) = 1""")
def q10_majority_norm(spark, d):
    # One number that orders by document, then place: hash aggregation can hold it, which it can't a struct.
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("i")
    return L.majority(docs_units(spark, d).withColumn("key", F.lower("tok")), "key", "tok", place)


@query(f"""{TOK} SELECT lower(tok) AS word, string_agg(DISTINCT quality::VARCHAR, '|' ORDER BY quality::VARCHAR) AS "values" FROM tok JOIN labels USING (doc_id) GROUP BY 1""")
def q11_pos_set(spark, d):
    return L.value_sets(docs_units(spark, d).join(table(spark, d, "labels"), "doc_id").select(F.lower("tok").alias("word"), "quality"), "word", "quality")


@query(f"""{TOK} SELECT tok, count(*) AS n, count(*) / sum(count(*)) OVER () AS freq FROM tok GROUP BY tok""")
def q12_rel_freq(spark, d):
    return L.relative_frequency(docs_units(spark, d), "tok")


@query(f"""{TOK}, c AS (SELECT lower(translate(tok, '.,', '')) AS key, tok, count(*) AS n FROM tok GROUP BY ALL HAVING count(*) >= 3)
SELECT key, count(*) AS n_values, string_agg(tok, '|' ORDER BY n DESC, tok) AS alternatives FROM c GROUP BY key HAVING count(*) > 1""")
def q13_ambig_table(spark, d):
    return L.ambiguous(docs_units(spark, d).select(F.lower(F.translate("tok", ".,", "")).alias("key"), "tok"), "key", "tok", 3)


@query(r"""WITH t AS (SELECT trim(regexp_replace(text, '[ \n\t\r]+', ' ', 'g')) AS t FROM benchmark),
p AS (SELECT '##' || replace(t, ' ', '') AS p, regexp_replace(regexp_replace(t, '[^ ] ', '1', 'g'), '[^1]', '0', 'g') AS m FROM t),
g AS (SELECT substr(p, i, 3) AS ngram, substr(m, i, 1) = '1' AS b FROM (SELECT p, m, unnest(range(1, length(m) + 1)) AS i FROM p))
SELECT ngram, count(*) FILTER (WHERE b) AS n_bound, count(*) FILTER (WHERE NOT b) AS n_not, count(*) FILTER (WHERE b) / count(*) AS p FROM g GROUP BY ngram""")
def q14_ngram_boundary(spark, d):
    return L.boundary_ngrams(table(spark, d, "benchmark"), "item_id", "text")


@query(f"""{TOK} SELECT lower(tok) AS word FROM tok GROUP BY 1 HAVING count(*) = 1""")
def q15_hapax(spark, d):
    return docs_units(spark, d).groupBy(F.lower("tok").alias("word")).agg(F.count("*").alias("n")).where("n = 1").select("word")


@query(f"""{TOK}, {_tok("benchmark", "item_id").replace("a AS", "ba AS").replace("tok AS (", "btok AS (").replace("FROM a)", "FROM ba)")}
SELECT tok, count(*) AS n FROM tok WHERE tok NOT IN (SELECT tok FROM btok) GROUP BY tok""")
def q16_new_lexicon(spark, d):
    return L.new_entries(docs_units(spark, d), S.units(table(spark, d, "benchmark"), "item_id"), "tok")


@query(r"""SELECT conv_id, turn, coalesce(lag(role) OVER w, '_') AS prev, coalesce(lead(role) OVER w, '_') AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def q17_prev_next(spark, d):
    return S.with_neighbours(table(spark, d, "conversations"), "role", "conv_id", "turn").select("conv_id", "turn", "prev", "next")


@query(r"""WITH c AS (SELECT item_id, text, unnest(range(1, length(text) + 1)) AS i FROM benchmark)
SELECT item_id, i::INT AS i, CASE WHEN i > 2 THEN substr(text, i - 2, 1) ELSE '' END AS cm2, CASE WHEN i > 1 THEN substr(text, i - 1, 1) ELSE '' END AS cm1, substr(text, i + 1, 1) AS cp1, substr(text, i + 2, 1) AS cp2,
CASE WHEN regexp_matches(substr(text, i, 1), '[aeiou]') THEN 1 ELSE 0 END AS vowel FROM c""")
def q18_char_window(spark, d):
    c = table(spark, d, "benchmark").select("item_id", "text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("i"))
    return c.select("item_id", "i", *S.char_context(F.col("text"), F.col("i")), F.substring("text", F.col("i"), F.lit(1)).rlike("[aeiou]").cast("int").alias("vowel"))


@query(f"""{TOK} SELECT doc_id, i, coalesce(i - last_value(CASE WHEN p THEN i END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS since,
coalesce(first_value(CASE WHEN p THEN i END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - i, 5) AS until FROM (SELECT *, regexp_matches(tok, '[.,]$') AS p FROM tok)""")
def q19_dist_punct(spark, d):
    return S.distances(docs_units(spark, d), F.col("tok").rlike("[.,]$")).select("doc_id", "i", "since", "until")


@query(r"""WITH n AS (SELECT conv_id, turn, text AS t, max(turn) OVER (PARTITION BY conv_id) + 1 AS n FROM conversations)
SELECT a.conv_id, a.turn, a.t, b.t AS "t-2", c.t AS "t-1", e.t AS "t+1" FROM n a JOIN n b ON b.conv_id = a.conv_id AND b.turn = (a.turn - 2 + 2 * a.n) % a.n
JOIN n c ON c.conv_id = a.conv_id AND c.turn = (a.turn - 1 + a.n) % a.n JOIN n e ON e.conv_id = a.conv_id AND e.turn = (a.turn + 1) % a.n""")
def q20_skipgram(spark, d):
    return S.circular(table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("t")), "t", [-2, -1, 1], "conv_id", "turn")


@query(f"""{TOK} SELECT doc_id, i, max(CASE WHEN tok LIKE '%.' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) = 1 AS soon FROM tok""")
def q21_lookahead(spark, d):
    return docs_units(spark, d).select("doc_id", "i", S.any_ahead(F.endswith("tok", F.lit(".")), 9).alias("soon"))


@query(f"""{TOK}, g AS (SELECT *, coalesce(sum(CASE WHEN tok LIKE '%.' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM tok),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s ORDER BY i) AS k, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g)
SELECT doc_id, i, s, CASE WHEN n = 1 THEN 'S' WHEN k = 1 THEN 'B' WHEN k = n THEN 'E' ELSE 'I' END AS place FROM n""")
def q22_bies(spark, d):
    t = C.sentences(S.words(table(spark, d, "documents")), lambda w: F.endswith(w, F.lit(".")))
    u = t.select("doc_id", F.col("sent").alias("s"), "start", "places", F.size("words").alias("n"), F.posexplode("words").alias("k", "tok"))
    return u.select("doc_id", F.coalesce(F.get("places", F.col("k")), F.col("start") + F.col("k")).alias("i"), "s", S.place_of(F.col("k") + 1, F.col("n")).alias("place"))


@query(f"""{TOK}, g AS (SELECT *, coalesce(sum(CASE WHEN tok LIKE '%.' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM tok)
SELECT doc_id, printf('s%04d', s + 1) AS sent_id, min(i)::INT AS st, max(i)::INT AS en FROM g GROUP BY doc_id, s""")
def q23_sentence_ids(spark, d):
    u = docs_units(spark, d)
    u = u.withColumn("s", S.group_ids(S.after(F.endswith("tok", F.lit(".")))))
    return u.groupBy("doc_id", "s").agg(F.min("i").alias("st"), F.max("i").alias("en")).select("doc_id", F.format_string("s%04d", F.col("s") + 1).alias("sent_id"), "st", "en")


@query(f"""{_tok("conversations", "conv_id, turn").replace("a AS", "WITH a AS", 1)}, n AS (SELECT *, max(i) OVER (PARTITION BY conv_id, turn) + 1 AS n FROM tok),
o AS (SELECT conv_id, turn, i, s.s::INT AS s, (i - s.s + n) % n AS o FROM n, range(0, 5000, 10) s(s) WHERE s.s < n)
SELECT conv_id, turn, i, arg_min(s, abs(o * 2 - 19) * 10000 + s) AS shingle FROM o WHERE o < 20 GROUP BY ALL""")
def q24_shingles(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", T.word_array(F.col("text")).alias("a")).where("size(a) > 0")
    return c.select("conv_id", "turn", F.size("a").alias("n"), F.posexplode("a").alias("i", "tok")).select("conv_id", "turn", "i", S.central_shingle(F.col("i"), F.col("n"), 20, 10).alias("shingle"))


@query(f"""{TOK}, seg(norm, seg) AS (VALUES {_values(SEGMENTS)}) SELECT doc_id, i, coalesce(seg, '_') AS seg FROM tok LEFT JOIN seg ON norm = lower(tok)""")
def q25_lookup_seg(spark, d):
    u = docs_units(spark, d).withColumn("norm", F.lower("tok"))
    return L.lookup(u, rows(spark, SEGMENTS, "norm string, seg string"), "norm", "seg", F.lit("_")).select("doc_id", "i", "seg")


_CASE = "CASE WHEN tok = lower(tok) THEN 'l' WHEN tok = upper(tok) THEN 'u' ELSE 't' END"


@query(f"""{TOK}, t AS (SELECT doc_id, i, tok AS word, {_CASE} AS tag FROM tok), f(word, tag, new_tag) AS (VALUES {_values(FIXES)})
SELECT doc_id, i, t.word, t.tag, coalesce(e.new_tag, s.new_tag, t.tag) AS new_tag FROM t LEFT JOIN f e ON e.word = t.word AND e.tag = t.tag LEFT JOIN f s ON s.word = t.word AND s.tag = '*'""")
def q26_tag_fix(spark, d):
    return L.fix_tags(docs_units(spark, d).select("doc_id", "i", F.col("tok").alias("word"), F.expr(_CASE).alias("tag")), rows(spark, FIXES, "word string, tag string, new_tag string"))


@query(f"""{TOK}, l(word, tag, lemma) AS (VALUES {_values(LEMMAS)}), t AS (SELECT doc_id, i, lower(tok) AS word, CASE WHEN i % 2 = 0 THEN 'V' ELSE 'D' END AS tag FROM tok),
b AS (SELECT word, tag, min(lemma) AS lemma FROM l GROUP BY ALL)
SELECT doc_id, i, t.word, t.tag, coalesce(b.lemma, CASE WHEN t.word IN (SELECT word FROM l) THEN t.word END, 'UNKNOWN') AS lemma FROM t LEFT JOIN b ON b.word = t.word AND b.tag = t.tag""")
def q27_lemma(spark, d):
    u = docs_units(spark, d).select("doc_id", "i", F.lower("tok").alias("word"), F.expr("CASE WHEN i % 2 = 0 THEN 'V' ELSE 'D' END").alias("tag"))
    return L.lemmatize(u, rows(spark, LEMMAS, "word string, tag string, lemma string"))


@query(f"""{TOK}, o(form, lang) AS (VALUES {_values(ORIGINS)}), t AS (SELECT DISTINCT lower(tok) AS word FROM tok),
p AS (SELECT word, arg_min(lang, length(form)) AS lang FROM t JOIN o ON form LIKE '%*' AND starts_with(word, form[:-2]) GROUP BY word),
s AS (SELECT word, arg_max(lang, length(form)) AS lang FROM t JOIN o ON form LIKE '*%' AND ends_with(word, form[2:]) GROUP BY word),
x AS (SELECT word, coalesce(o.lang, p.lang, s.lang) AS origin FROM t LEFT JOIN o ON form = word LEFT JOIN p USING (word) LEFT JOIN s USING (word))
SELECT origin, count(*) AS n FROM tok JOIN x ON word = lower(tok) GROUP BY origin""")
def q28_origin_affix(spark, d):
    found = L.origin(docs_units(spark, d).select(F.lower("tok").alias("word")), rows(spark, ORIGINS, "form string, lang string"))
    return found.groupBy("origin").agg(F.count("*").alias("n"))


_CAND = f"""ph(phrase) AS (VALUES {_values([(p,) for p in PHRASES])}),
r AS (SELECT doc_id, i AS st, unnest([lower(tok) || ' ' || lower(lead(tok) OVER w), lower(tok) || ' ' || lower(lead(tok) OVER w) || ' ' || lower(lead(tok, 2) OVER w), lower(tok) || ' ' || lower(lead(tok) OVER w) || ' ' || lower(lead(tok, 2) OVER w) || ' ' || lower(lead(tok, 3) OVER w)]) AS phrase, unnest([1, 2, 3]) AS k FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cand AS (SELECT doc_id, st, (st + k)::INT AS en, phrase FROM r WHERE phrase IN (SELECT phrase FROM ph))"""


def _candidates(spark, d):
    return L.phrase_candidates(docs_units(spark, d).withColumn("w", F.lower("tok")), rows(spark, [(p,) for p in PHRASES], "phrase string"), "doc_id", "i", "w")


@query(f"{TOK}, {_CAND} SELECT doc_id, st, en, phrase FROM cand")
def q29_mwe_candidates(spark, d):
    return _candidates(spark, d)


@query(f"""WITH RECURSIVE {_tok()}, {_CAND}, nxt AS (SELECT doc_id, st, min(en) AS en FROM cand GROUP BY ALL),
g(doc_id, st, en) AS (SELECT doc_id, min(st), arg_min(en, st) FROM nxt GROUP BY doc_id UNION ALL
  SELECT g.doc_id, min(n.st), arg_min(n.en, n.st) FROM g JOIN nxt n ON n.doc_id = g.doc_id AND n.st > g.en GROUP BY g.doc_id, g.st)
SELECT g.doc_id, g.st::INT AS st, g.en::INT AS en, phrase FROM g JOIN cand c ON c.doc_id = g.doc_id AND c.st = g.st AND c.en = g.en""")
def q30_mwe_greedy(spark, d):
    return L.greedy_spans(_candidates(spark, d), "doc_id")


@query(f"""{TOK} SELECT DISTINCT lower(tok) AS word, CASE {" ".join(f"WHEN lower(tok) = '{k}' THEN '{v}'" for k, v in MORPHS.items())} {" ".join(f"WHEN starts_with(lower(tok), '{p}') AND length(tok) >= {len(p) + 2} THEN '{p}-' || substr(lower(tok), {len(p) + 1})" for p in PREFIXES)} ELSE lower(tok) END AS morphs FROM tok""")
def q31_morph_prefix(spark, d):
    return docs_units(spark, d).select(F.lower("tok").alias("word")).distinct().select("word", L.prefix_morphs(F.col("word"), MORPHS, PREFIXES).alias("morphs"))


@query(f"""{TOK}, c AS (SELECT lower(translate(tok, '.,', '')) AS key, tok, count(*) AS n FROM tok GROUP BY ALL), al AS (SELECT key, list(tok ORDER BY n DESC, tok) AS alts FROM c GROUP BY key HAVING count(*) > 1)
SELECT key, CASE WHEN list_contains(alts, key || '.') THEN key || '.' ELSE alts[1] END AS chosen FROM al""")
def q32_arbitrate(spark, d):
    pairs = docs_units(spark, d).select(F.lower(F.translate("tok", ".,", "")).alias("key"), "tok")
    n = pairs.groupBy("key", "tok").agg(F.count("*").alias("n"))
    alternatives = n.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "tok"))), lambda x: x["tok"]).alias("alts")).where("size(alts) > 1")
    return alternatives.select("key", L.arbitrate(F.concat("key", F.lit(".")), F.col("alts")).alias("chosen"))


@query(f"""{TOK}, f AS (SELECT *, coalesce(lag(lower(tok) IN ('the', 'of', 'le', 'la', 'der')) OVER (PARTITION BY doc_id ORDER BY i), false) AS joined FROM tok),
g AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM f)
SELECT doc_id, grp::BIGINT AS grp, string_agg(tok, '' ORDER BY i) AS merged FROM g GROUP BY ALL HAVING count(*) > 1""")
def q33_detok_islands(spark, d):
    """Proclitics joined to what follows them."""
    u = docs_units(spark, d)
    u = u.withColumn("grp", S.group_ids(~S.after(F.lower("tok").isin("the", "of", "le", "la", "der"))))
    return u.groupBy("doc_id", "grp").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "tok"))), lambda x: x["tok"]), "").alias("merged")).where("n > 1").drop("n")


@query("""SELECT d.doc_id, d.n, coalesce(b.item_id, -1) AS gold FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INT AS n FROM documents) d
LEFT JOIN (SELECT text, min(item_id) AS item_id FROM benchmark GROUP BY text) b ON b.text = d.line""")
def q34_gold_replace(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    gold = table(spark, d, "benchmark").groupBy(F.col("text").alias("line")).agg(F.min("item_id").alias("item_id"))
    return lines.join(gold, "line", "left").select("doc_id", "n", F.coalesce("item_id", F.lit(-1).cast("long")).alias("gold"))


_EVENTS = r"""e0 AS (SELECT page_id, unnest(regexp_extract_all(html, '</?[a-zA-Z][^<>]*>')) AS raw, unnest(range(len(regexp_extract_all(html, '</?[a-zA-Z][^<>]*>'))))::INT AS pos FROM pages),
e AS (SELECT page_id, pos, raw, lower(regexp_extract(raw, '^</?([a-zA-Z0-9]+)', 1)) AS tag, CASE WHEN starts_with(raw, '</') THEN 'close' WHEN ends_with(raw, '/>') THEN 'unary' ELSE 'open' END AS kind FROM e0)"""


def _events(spark, d):
    return M.tag_events(table(spark, d, "pages"), "page_id", "html")


@query(f"WITH {_EVENTS} SELECT page_id, tag, pos, lead(pos) OVER (PARTITION BY page_id, tag ORDER BY pos) AS until FROM e WHERE kind = 'open'")
def q35_milestones(spark, d):
    return M.milestones(_events(spark, d).where("kind = 'open'"), "page_id").select("page_id", "tag", "pos", "until")


@query(f"""WITH {_EVENTS} SELECT page_id, pos, tag, kind, CASE WHEN regexp_matches(raw, ' class="') THEN regexp_extract(raw, ' class="([^"]*)"', 1) END AS class FROM e""")
def q36_sgml_events(spark, d):
    return _events(spark, d).select("page_id", "pos", "tag", "kind", M.attribute("raw", "class").alias("class"))


_SPANS = f"""{_EVENTS}, l AS (SELECT *, sum(CASE WHEN kind = 'open' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id, tag ORDER BY pos) AS level FROM e WHERE kind <> 'unary'),
dp AS (SELECT *, CASE WHEN kind = 'open' THEN level ELSE level + 1 END AS depth FROM l), n AS (SELECT *, lead(kind) OVER o AS next, lead(pos) OVER o AS en FROM dp WINDOW o AS (PARTITION BY page_id, tag, depth ORDER BY pos)),
sp AS (SELECT page_id, tag, pos AS st, en, depth::BIGINT AS depth FROM n WHERE kind = 'open' AND next = 'close')"""


@query(f"WITH {_SPANS} SELECT page_id, tag, st, en, depth FROM sp")
def q37_span_pairing(spark, d):
    return M.paired_spans(_events(spark, d), "page_id")


@query(f"WITH {_SPANS} SELECT page_id, tag, st, en, row_number() OVER (PARTITION BY page_id ORDER BY st, st - en, tag)::INT AS rank FROM sp")
def q38_nest_order(spark, d):
    return M.opening_order(M.paired_spans(_events(spark, d), "page_id"), "page_id").select("page_id", "tag", "st", "en", "rank")


#: Heads for want of a parser: a word's place before it, by a rule; the first has none (0).
_HEAD = "greatest(i - (i % 3), 0)"
_TREE = f"WITH {_tok()}, tr AS (SELECT doc_id, i + 1 AS id, lower(tok) AS form, {_HEAD} AS head, CASE WHEN i % 4 = 0 THEN 'nmod' WHEN i % 4 = 1 THEN 'det' ELSE 'obj' END AS func FROM tok)"


def _tree(spark, d):
    return docs_units(spark, d).select("doc_id", (F.col("i") + 1).alias("id"), F.lower("tok").alias("form"), F.expr(_HEAD).alias("head"), F.expr("CASE WHEN i % 4 = 0 THEN 'nmod' WHEN i % 4 = 1 THEN 'det' ELSE 'obj' END").alias("func"))


@query(f"{_TREE} SELECT doc_id, head AS id, count(*) AS n_children FROM tr WHERE head > 0 GROUP BY ALL")
def q39_tree_children(spark, d):
    return _tree(spark, d).where("head > 0").groupBy("doc_id", F.col("head").alias("id")).agg(F.count("*").alias("n_children"))


@query(f"""{_TREE} SELECT a.doc_id, a.id, a.head, CASE WHEN a.func = 'obj' AND EXISTS (SELECT 1 FROM tr b WHERE b.doc_id = a.doc_id AND b.head = a.id AND b.func = 'det') THEN 'iobj' ELSE a.func END AS func FROM tr a""")
def q40_tree_rule(spark, d):
    """func=/obj/;func=/det/ > #1>#2 > #1:func=iobj"""
    t = _tree(spark, d)
    has = t.where("func = 'det' AND head > 0").select("doc_id", F.col("head").alias("id")).distinct().withColumn("hit", F.lit(True))
    return t.join(has, ["doc_id", "id"], "left").select("doc_id", "id", "head", F.when((F.col("func") == "obj") & F.col("hit"), "iobj").otherwise(F.col("func")).alias("func"))


@query("""SELECT a.conv_id, a.turn AS a, b.turn AS b FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn - a.turn BETWEEN 1 AND 2 WHERE a.role = 'user' AND b.role <> 'user'""")
def q41_order_join(spark, d):
    c = table(spark, d, "conversations")
    a, b = c.where("role = 'user'").select("conv_id", F.col("turn").alias("a")), c.where("role != 'user'").select("conv_id", F.col("turn").alias("b"))
    return a.join(b, "conv_id").where("b - a BETWEEN 1 AND 2")


@query(f"""{_TREE}, ent AS (SELECT doc_id, id AS st, id + 4 AS en FROM tr WHERE id % 10 = 1),
h AS (SELECT e.doc_id, e.st, min(t.id) AS head_tok FROM ent e JOIN tr t ON t.doc_id = e.doc_id AND t.id BETWEEN e.st AND e.en WHERE t.head NOT BETWEEN e.st AND e.en GROUP BY ALL)
SELECT e.doc_id, e.st, e.en, coalesce(head_tok, e.st) AS head_tok FROM ent e LEFT JOIN h ON h.doc_id = e.doc_id AND h.st = e.st""")
def q42_entity_head(spark, d):
    """First token of an entity that is governed from outside it."""
    t = _tree(spark, d)
    ent = t.where("id % 10 = 1").select("doc_id", F.col("id").alias("st"), (F.col("id") + 4).alias("en"))
    inside = t.select("doc_id", "id", "head", (F.col("id") - (F.col("id") - 1) % 10).alias("st")).join(ent, ["doc_id", "st"]).where("id BETWEEN st AND en AND NOT head BETWEEN st AND en")
    return ent.join(inside.groupBy("doc_id", "st").agg(F.min("id").alias("head_tok")), ["doc_id", "st"], "left").withColumn("head_tok", F.coalesce("head_tok", "st"))


LINKS = [("the", "place", "L1"), ("of", "person", "L2"), ("and", "place", "L3"), ("de", "place", "L4")]


@query(f"""{TOK}, k(text, etype, link) AS (VALUES {_values(LINKS)}), m AS (SELECT doc_id, i, lower(tok) AS text, CASE WHEN i % 2 = 0 THEN 'place' ELSE 'person' END AS etype FROM tok)
SELECT doc_id, i, coalesce(a.link, b.link) AS link FROM m LEFT JOIN k a ON a.text = m.text AND a.etype = m.etype LEFT JOIN k b ON b.text = m.text WHERE coalesce(a.link, b.link) IS NOT NULL""")
def q43_link_cascade(spark, d):
    m = docs_units(spark, d).select("doc_id", "i", F.lower("tok").alias("text"), F.expr("CASE WHEN i % 2 = 0 THEN 'place' ELSE 'person' END").alias("etype"))
    k = rows(spark, LINKS, "text string, etype string, link string")
    return L.cascade(m, [(k, ["text", "etype"], "link"), (k, ["text"], "link")], "link").where("link IS NOT NULL").select("doc_id", "i", "link")


@query(f"""{TOK}, k(text, etype, link) AS (VALUES {_values(LINKS)}), m AS (SELECT DISTINCT doc_id, link FROM tok JOIN k ON text = lower(tok))
SELECT d.doc_id, coalesce(string_agg(link, '; ' ORDER BY link), 'none') AS links FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.doc_id""")
def q44_doc_link_summary(spark, d):
    m = docs_units(spark, d).select("doc_id", F.lower("tok").alias("text")).join(rows(spark, LINKS, "text string, etype string, link string"), "text")
    m = m.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("link")), "; ").alias("links"))
    return table(spark, d, "documents").select("doc_id").join(m, "doc_id", "left").withColumn("links", F.coalesce("links", F.lit("none")))


@query("""WITH n AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality <> 1 AND toxic = 1) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic <> 1) AS fn, avg((quality = toxic)::INT) AS accuracy FROM labels),
r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM n)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r""")
def q45_prf(spark, d):
    return E.precision_recall(table(spark, d, "labels"), "quality", "toxic")


@query(f"""{_TREE}, g AS (SELECT *, CASE WHEN id % 5 = 0 THEN id - 1 ELSE head END AS gold_head, CASE WHEN id % 7 = 0 THEN 'x' ELSE func END AS gold_func FROM tr)
SELECT avg(((form LIKE '%.' OR head = gold_head) AND func = gold_func)::INT) AS las, avg((form LIKE '%.' OR head = gold_head)::INT) AS uas, avg((func = gold_func)::INT) AS label_acc FROM g""")
def q46_attachment_scores(spark, d):
    t = _tree(spark, d).withColumn("gold_head", F.expr("CASE WHEN id % 5 = 0 THEN id - 1 ELSE head END")).withColumn("gold_func", F.expr("CASE WHEN id % 7 = 0 THEN 'x' ELSE func END"))
    return E.attachment(t, "head", "gold_head", "func", "gold_func", F.endswith("form", F.lit(".")))


@query("SELECT lang, toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL")
def q47_confusion(spark, d):
    return E.confusion(table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id"), "lang", "toxic")


@query("SELECT doc_id, CASE WHEN toxic <> quality AND toxic = (doc_id % 2) THEN toxic::BIGINT ELSE quality::BIGINT END AS v FROM labels")
def q48_ensemble_vote(spark, d):
    return table(spark, d, "labels").select("doc_id", E.vote(F.col("quality").cast("long"), F.col("toxic").cast("long"), F.col("doc_id") % 2).alias("v"))


@query("""WITH f AS (SELECT event_id, event_type, CASE WHEN user_id % 2 = 0 THEN 'Even' ELSE 'Odd' END AS b FROM events)
SELECT event_id, 'A=' || event_type || '|B=' || b || '|new=1' AS added, 'B=' || b AS dropped, 'A=' || array_to_string(list_sort(list_distinct([event_type, 'click'])), ',') || '|B=' || b AS joined FROM f""")
def q49_feats_update(spark, d):
    b = F.when(F.col("user_id") % 2 == 0, "Even").otherwise("Odd")
    e = table(spark, d, "events").select("event_id", F.create_map(F.lit("B"), b, F.lit("A"), F.col("event_type")).alias("m"))
    lit = lambda k, v: F.create_map(F.lit(k), F.lit(v))
    return e.select("event_id", T.merge_features(F.col("m"), lit("new", "1")).alias("added"), T.drop_features(F.col("m"), ["A"]).alias("dropped"), T.union_features(F.col("m"), lit("A", "click")).alias("joined"))


@query("SELECT conv_id, max(CASE WHEN role = 'user' THEN text END) AS user, max(CASE WHEN role = 'assistant' THEN text END) AS assistant FROM conversations GROUP BY conv_id")
def q50_grid_pivot(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").pivot("role", ["user", "assistant"]).agg(F.max("text"))
