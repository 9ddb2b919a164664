"""Licence scans by canonical digest lookup.

A text and each of its lines are brought to a canonical form (case, punctuation, copyright lines and
equivalent spellings levelled); the SHA-256 of that form is hash-joined to the digests of known licences
and licence notices. Whole units are compared, never keywords. Catalyst chooses the join: it broadcasts the
known digests if their size allows, and shuffles by digest beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.license_texts import EQUAL_SPELLINGS, KNOWN_LICENSES

COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """Canonical form of a text, with its line breaks; runs of other than letters and digits are one space."""
    t = F.lower(text)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    for a, b in EQUAL_SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_replace(t, NOT_WORD, " ")


def _digest(lines: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(lines, "[ \n]+", " ")), 256)


def read_licenses(spark: SparkSession, path: str) -> DataFrame:
    """license_id, text: a row for each text file under path, named by the file without its ending."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.txt)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("license_id"), F.col("value").alias("text"))


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text_digest, license_id (the whole text is this licence), notices.

    notices: the licences that single lines are notices of, sorted, joined by '|'; null if there are none.
    A null text counts as empty and matches nothing, as do texts and lines without letters or digits. Very
    long texts and lines are digested whole; rows that repeat a document are scanned each; null ids stay null.
    known has license_id, text (default KNOWN_LICENSES); rows with nulls are ignored, and of licences with
    one canonical text the first by name stands. Other columns of docs and known, whatever their names, are
    ignored; an empty docs gives no rows, an empty known no licences.
    """
    spark = docs.sparkSession
    known = known if known is not None else spark.createDataFrame(KNOWN_LICENSES, "license_id string, text string")
    known = known.where("license_id IS NOT NULL AND text IS NOT NULL").select("license_id", _digest(canonical_lines(F.col("text"))).alias("digest"))
    known = known.where(F.col("digest") != F.sha2(F.lit(""), 256)).groupBy("digest").agg(F.min("license_id").alias("license_id"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), canonical_lines(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("lines"))
    rows = rows.select("row", "doc_id", _digest(F.col("lines")).alias("text_digest"), F.filter(F.transform(F.split("lines", "\n"), lambda x: F.trim(x)), lambda x: x != "").alias("lines"))
    # The whole text's digest comes first, then its lines'; only it and the lines that are notices reach the exchange.
    units = rows.select("row", "doc_id", "text_digest", F.posexplode(F.concat(F.array("text_digest"), F.transform("lines", lambda x: F.sha2(x, 256)))).alias("place", "digest"))
    found = units.join(known, "digest", "left").where("place = 0 OR license_id IS NOT NULL")
    own, notices = F.max(F.when(F.col("place") == 0, F.col("license_id"))), F.collect_set(F.when(F.col("place") > 0, F.col("license_id")))
    out = found.groupBy("row", "doc_id", "text_digest").agg(own.alias("license_id"), F.array_join(F.array_sort(notices), "|").alias("notices"))
    return out.select("doc_id", "text_digest", "license_id", F.when(F.col("notices") != "", F.col("notices")).alias("notices"))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every document with the digest of its canonical text and the licences it is or names."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    def canonical(x: str) -> str:
        t = rf"regexp_replace(lower({x}), '{COPYRIGHT_LINE}', '\1', 'g')"
        for a, b in EQUAL_SPELLINGS:
            t = f"replace({t}, '{a}', '{b}')"
        return f"regexp_replace({t}, '{NOT_WORD}', ' ', 'g')"

    digest = "sha256(trim(regexp_replace({}, '[ \n]+', ' ', 'g')))".format
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in KNOWN_LICENSES)
    return f"""
WITH k AS (SELECT min(id) AS license_id, {digest(canonical("t"))} AS digest FROM (VALUES {values}) v(id, t) GROUP BY 2),
d AS (SELECT doc_id, row_number() OVER () AS row, {canonical("coalesce(text, '')")} AS lines FROM documents),
l AS (SELECT row, unnest(string_split(lines, chr(10))) AS line FROM d),
n AS (SELECT row, string_agg(DISTINCT license_id, '|' ORDER BY license_id) AS notices FROM l JOIN k ON k.digest = sha256(trim(line)) GROUP BY row)
SELECT doc_id, {digest("lines")} AS text_digest, k.license_id, n.notices
FROM d LEFT JOIN k ON k.digest = {digest("lines")} LEFT JOIN n USING (row)
"""


OP5_SQL = _sql()
