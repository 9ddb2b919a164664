"""Readers and writers: plain text, lexicon tables, CoNLL-U, SGML, piped groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEXICONS = {
    "norm": "orig string, norm string", "segmentation": "norm string, seg string", "morph": "unit string, analysis string", "lemma": "word string, tag string, lemma string", "origin": "form string, lang string",
    "tag_fix": "word string, tag string, new_tag string", "phrases": "phrase string", "frequency": "word string, freq long", "detok": "word string, n_bound long, n_not_bound long, p double",
    "tagger": "word string, tag string, freq long", "identities": "text string, head string, etype string, link string, freq long", "overrides": "doc_key string, text string, etype string, link string",
}
CONLL = ["id", "form", "lemma", "cpos", "pos", "morph", "head", "func", "deps", "misc"]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: doc_id (its path), text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))


def read_lexicon(spark: SparkSession, path: str, kind: str, strict: bool = False) -> DataFrame:
    """A tab-separated table without header. Lines without a tab are skipped (but in phrases), and '#' begins comments in detok, identities and overrides.

    strict: a line with another number of columns is an error; else it is skipped.
    """
    schema = T.StructType.fromDDL(LEXICONS[kind])
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value")).where("value != ''")
    if kind in ("detok", "identities", "overrides"):
        lines = lines.where(~F.startswith("value", F.lit("#")))
    if len(schema) > 1:
        lines = lines.where(F.col("value").contains("\t"))
    c = F.split("value", "\t")
    right = F.size(c) == len(schema)
    if strict:
        lines = lines.where(F.when(right, True).otherwise(F.raise_error(F.concat(F.lit("malformed line: "), "value")).cast("boolean")))
    else:
        lines = lines.where(right)
    return lines.select(*[F.try_element_at(c, F.lit(i + 1)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])


def parse_conllu(docs: DataFrame, key: str = "doc_id", text: str = "text", comments: bool = False) -> DataFrame:
    """One row a token: key, sent (from 0), line_no, super_token, ellipsis (ids such as 3.1), and CONLL; comments are left out, or in meta, as conllu_comments has them. Lines of eight columns have no deps and misc."""
    sentences = F.filter(F.split(F.regexp_replace(text, "\r", ""), "\n\n+"), lambda s: F.trim(s) != "")
    cut = docs.select(key, F.posexplode(sentences).alias("sent", "s"))
    meta = [_meta(F.filter(F.split("s", "\n"), lambda x: x.rlike("^# [^=]+ = "))).alias("meta")] if comments else []
    lines = cut.select(key, "sent", "s", *meta).select(key, "sent", *["meta"] * comments, F.posexplode(F.filter(F.split("s", "\n"), lambda x: (x != "") & ~F.startswith(x, F.lit("#")))).alias("line_no", "line"))
    c = F.split("line", "\t")
    fields = [F.when(F.size(c) > i, c[i]).alias(n) for i, n in enumerate(CONLL)]
    return lines.select(key, "sent", "line_no", c[0].contains("-").alias("super_token"), c[0].contains(".").alias("ellipsis"), *fields, *["meta"] * comments)


def conllu_comments(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, sent, meta: the '# k = v' comments of each sentence."""
    sentences = F.filter(F.split(F.regexp_replace(text, "\r", ""), "\n\n+"), lambda s: F.trim(s) != "")
    lines = docs.select(key, F.posexplode(sentences).alias("sent", "s")).select(key, "sent", F.filter(F.split("s", "\n"), lambda x: x.rlike("^# [^=]+ = ")).alias("c"))
    return lines.select(key, "sent", _meta(F.col("c")).alias("meta"))


def _meta(comments: Column) -> Column:
    return F.map_from_entries(F.transform(comments, lambda x: F.struct(F.regexp_extract(x, "^# ([^=]+) = ", 1), F.regexp_extract(x, "^# [^=]+ = (.*)", 1))))


def conllu_text(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ten-column text of each document, sentences parted by blank lines; null fields are '_'."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in CONLL])
    s = tokens.groupBy(key, "sent").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", line.alias("t")))), lambda x: x["t"]), "\n").alias("t"))
    return s.groupBy(key).agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent", "t"))), lambda x: x["t"]), "\n\n"), F.lit("\n\n")).alias("text"))


def parse_sgml(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a tag or token of a text with one of these a line: key, line_no, kind (open, close, unary, token), tag, attrs, text."""
    rows = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).where("line != ''")
    starts, unary = lambda x: F.startswith("line", F.lit(x)), F.endswith("line", F.lit("/>")) & (F.instr("line", ">") == F.length("line"))
    kind = F.when(~starts("<"), "token").when(starts("</"), "close").when(unary, "unary").otherwise("open")
    names, values = (F.regexp_extract_all("line", F.lit(r'([\w:.-]+)="([^"]*)"'), i) for i in (1, 2))
    attrs = F.map_from_arrays(names, values)
    return rows.select(key, "line_no", kind.alias("kind"), F.when(kind != "token", F.regexp_extract("line", r"^</?([\w:.-]+)", 1)).alias("tag"), F.when(kind.isin("open", "unary"), attrs).alias("attrs"), F.when(kind == "token", F.col("line")).alias("text"))


def units_of_sgml(events: DataFrame, key: str = "doc_id", element: str = "norm") -> DataFrame:
    """One row for each closing element: its place, its text, and the last attributes seen before it; a missing one keeps the value before."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.sum(F.when((F.col("kind") == "open") & (F.col("tag") == element), 1).otherwise(0)).over(w)
    last = lambda name: F.last(F.col("attrs")[name], True).over(w)
    e = events.select("*", opened.alias("unit"), *[last(n).alias(f"__{n}") for n in ("norm", "pos", "lemma")])
    token = F.when((F.col("kind") == "token") & (F.col("unit") > 0), F.struct("line_no", "text"))
    close = F.when((F.col("kind") == "close") & (F.col("tag") == element), F.struct("line_no", F.col("__norm").alias("norm"), F.col("__pos").alias("pos"), F.col("__lemma").alias("lemma")))
    u = e.groupBy(key, "unit").agg(F.array_sort(F.collect_list(token)).alias("t"), F.collect_list(close).alias("c"))
    orig = F.when(F.size("t") > 0, F.array_join(F.transform("t", lambda x: x["text"]), ""))
    return u.select(key, "unit", orig.alias("orig"), F.explode("c").alias("c")).select(key, "unit", "c.*", "orig")


def sgml_text(groups: Column) -> Column:
    """Nested lines of an array of groups, each an array of struct<norm, orig, morphs>."""
    unit = lambda u: F.concat(F.lit('<norm norm="'), u["norm"], F.lit('">\n'), F.when(F.size(u["morphs"]) > 1, F.array_join(F.transform(u["morphs"], lambda m: F.concat(F.lit('<morph morph="'), m, F.lit('">\n'), m, F.lit("\n</morph>"))), "\n")).otherwise(u["orig"]), F.lit("\n</norm>"))
    group = lambda g: F.concat(F.lit('<norm_group norm_group="'), F.array_join(F.transform(g, lambda u: u["norm"]), ""), F.lit('">\n'), F.array_join(F.transform(g, unit), "\n"), F.lit("\n</norm_group>"))
    return F.array_join(F.transform(groups, group), "\n")


def piped_text(units: DataFrame, key: str = "doc_id") -> DataFrame:
    """Groups joined by '_', their units by '|': from key, grp, unit_idx, norm."""
    g = units.groupBy(key, "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_idx", "norm"))), lambda x: x["norm"]), "|").alias("t"))
    return g.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("grp", "t"))), lambda x: x["t"]), "_").alias("text"))


def parse_piped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The reverse of piped_text; blanks also part groups, and '-' parts morphs within a unit."""
    g = docs.select(key, F.posexplode(F.filter(F.split(text, "[ _\n]+"), lambda x: x != "")).alias("grp", "g"))
    return g.select(key, "grp", F.posexplode(F.split("g", r"\|")).alias("unit_idx", "u")).select(key, "grp", "unit_idx", F.replace("u", F.lit("-"), F.lit("")).alias("norm"), F.split("u", "-").alias("morphs"))


TOKEN_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONLL])
