"""Queries of the whole annotation in one call, and of readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.annotate import Options, Tables, annotate, annotate_units
from lectern.operators.models import Registry, chain_parser, lexicon_tagger
from lectern.operators.segmentation import Grammar, Stack
from lectern.plans.norm_queries import BENCH
from lectern.plans.queries import LEMMAS, SEGMENTS, _values, query, rows, table
from lectern.sources import formats as S

#: Groups of conversations, cut by the table of segmentations, as units with tags and sentences.
_UNITS = rf"""p0 AS (SELECT conv_id || '-' || turn AS doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '<[^<>]*>|[^<]+|<'), lambda x: CASE WHEN starts_with(x, '<') AND ends_with(x, '>') THEN translate(x, ' _', chr(57344) || chr(57345)) ELSE x END) AS p FROM conversations),
g0 AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(array_to_string(p, ''), '[ _\n\t\r]+'), lambda x: x <> ''), lambda x: translate(x, chr(57344) || chr(57345), ' _')) AS g FROM p0),
d AS (SELECT doc_id, unnest(g) AS dirty, unnest(range(len(g)))::INT AS grp FROM g0), s(norm, seg) AS (VALUES {_values(SEGMENTS)}),
n AS (SELECT doc_id, grp, lower(translate(translate(regexp_replace(dirty, '<[^>]*>', '', 'g'), '|-', '□■'), '[]*#%&$^~̄̅', '')) AS norm FROM d), c AS (SELECT doc_id, grp, string_split(coalesce(seg, n.norm), '|') AS u FROM n LEFT JOIN s USING (norm)),
u0 AS (SELECT doc_id, grp, unnest(u) AS norm, unnest(range(len(u)))::INT AS unit_idx FROM c)"""
_TAGS = f"""{BENCH}, x AS (SELECT lower(tok) AS w, CASE WHEN i % 3 = 0 THEN 'V' ELSE 'N' END AS tag FROM bt), k AS (SELECT w, tag, count(*) AS n FROM x GROUP BY ALL), b AS (SELECT w, arg_min(tag, (-n, tag)) AS tag FROM k GROUP BY w)"""


def _setting(spark, d):
    from lectern.operators import sequences

    lexicon = sequences.units(table(spark, d, "benchmark"), "item_id").select(F.lower("tok").alias("word"), F.expr("CASE WHEN i % 3 = 0 THEN 'V' ELSE 'N' END").alias("tag"), F.lit(1).alias("freq"))
    docs = table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text")
    tables = Tables(Stack(rows(spark, SEGMENTS, "norm string, seg string"), Grammar({}, [])), rows(spark, LEMMAS, "word string, tag string, lemma string"))
    return docs, tables, Registry().add(lexicon_tagger(lexicon)).add(chain_parser())


@query(f"WITH {_UNITS}, p AS (SELECT doc_id, grp, string_agg(norm, '|' ORDER BY unit_idx) AS seg FROM u0 GROUP BY ALL) SELECT doc_id, string_agg(seg, '_' ORDER BY grp) AS text FROM p GROUP BY doc_id")
def q129_annotate_pipes(spark, d):
    docs, tables, registry = _setting(spark, d)
    return annotate(docs, Options(outmode="pipes"), tables, registry)


@query(f"""WITH {_UNITS}, {_TAGS}, t AS (SELECT u0.*, coalesce(tag, 'UNKNOWN') AS tag FROM u0 LEFT JOIN b ON w = norm), e AS (SELECT *, coalesce(sum(CASE WHEN norm LIKE '%.' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY grp, unit_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS sent FROM t),
i AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sent ORDER BY grp, unit_idx) AS id FROM e), l(lw, lt, lemma) AS (VALUES {_values(LEMMAS)}), m AS (SELECT lw, lt, min(lemma) AS lemma FROM l GROUP BY ALL),
f AS (SELECT i.*, coalesce(m.lemma, norm) AS lemma, CASE WHEN id = 1 THEN 'root' ELSE 'dep' END AS func FROM i LEFT JOIN m ON lw = norm AND lt = tag),
o AS (SELECT doc_id, sent, '# sent_id = ' || doc_id || '-s' || printf('%04d', sent + 1) || chr(10) || '# text = ' || trim(string_agg(norm, ' ' ORDER BY id)) || chr(10) || string_agg(concat_ws(chr(9), id, norm, lemma, CASE tag WHEN 'N' THEN 'NOUN' WHEN 'V' THEN 'VERB' ELSE 'X' END, tag, '_', id - 1, func, '_', '_'), chr(10) ORDER BY id) || chr(10) || chr(10) AS block FROM f GROUP BY doc_id, sent)
SELECT doc_id, string_agg(block, '' ORDER BY sent) AS text FROM o GROUP BY doc_id""")
def q130_annotate_conllu(spark, d):
    """Segmented, tagged, lemmatized and parsed conversations as CoNLL-U."""
    docs, tables, registry = _setting(spark, d)
    return annotate(docs, Options(outmode="conllu", lemma=True, parse=True), tables, registry)


@query(f"""WITH {_UNITS}, {_TAGS}, t AS (SELECT u0.*, coalesce(tag, 'UNKNOWN') AS tag, row_number() OVER (PARTITION BY doc_id ORDER BY grp, unit_idx) AS tok_id FROM u0 LEFT JOIN b ON w = norm) SELECT doc_id, tok_id::INT AS tok_id, norm, tag AS pos FROM t""")
def q131_annotate_sgml(spark, d):
    """Annotated conversations as SGML with spans and metadata, read back: ids, forms and tags of units."""
    docs, tables, registry = _setting(spark, d)
    done = annotate(docs, Options(tag=True, multiword=True, processing_meta=True), Tables(tables.stack, phrases=rows(spark, [("the and",), ("of the",)], "phrase string")), registry)
    e = S.parse_sgml(done).where("kind = 'open' AND tag = 'norm'")
    a = F.col("attrs")
    return e.select("doc_id", F.regexp_extract(a["xml:id"], "[0-9]+", 0).cast("int").alias("tok_id"), a["norm"].alias("norm"), a["pos"].alias("pos"))


@query(f"WITH {_UNITS} SELECT count(*) AS n, count(DISTINCT (doc_id, grp)) AS n_groups FROM u0")
def q132_annotate_units(spark, d):
    docs, tables, registry = _setting(spark, d)
    u = annotate_units(docs, Options(), tables, registry)
    return u.agg(F.count("*").alias("n"), F.count_distinct("doc_id", "grp").alias("n_groups"))
