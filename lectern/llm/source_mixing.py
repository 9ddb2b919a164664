"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 60-bit hash of its id. Tokens are summed by source and leading 12 hash bits; the bucket
in which a source's budget ends is the only one opened further, 12 bits at a time, until it is one hash
value. What lies below the threshold is taken: a filter, with no sort of rows. Thresholds are nested: a
smaller budget takes a subset of what a larger one takes. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.durable import checkpointed

WORDS = r"[^\x20\x09-\x0D]+"
HASH_BITS, DIGIT_BITS = 60, 12
#: A table of one row per source is broadcast up to so many sources, and joined by shuffle beyond.
BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, cap: int = 3, weights: int = 3) -> DataFrame:
    """sizes: sk (sort key of the source), source_size. Adds target, base (whole copies) and extra (words beyond them).

    The k-th source weighs 1, 2, ... weights, repeating. Targets share the total by weight, none above cap
    times its source: sources in order of cap size by weight are capped until the rest fits.
    """
    order = Window.orderBy("sk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = sizes.withColumn("w", (F.row_number().over(order) - 1) % weights + 1).withColumn("cap", F.col("source_size") * cap)
    by_ratio = Window.orderBy("ratio", "sk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("ratio", F.col("cap").cast("double") / F.col("w"))
    s = s.withColumn("left_size", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)))
    s = s.withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(by_ratio), F.lit(0)))
    s = s.withColumn("level", F.col("left_size").cast("double") / F.col("left_w"))
    s = s.withColumn("fill", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sk", "level"))).over(every)["level"])
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("fill") * F.col("w"), F.col("cap").cast("double"))))
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return s.withColumn("base", base).select("sk", "source_size", "target", "base", (F.col("target") - F.col("base") * F.col("source_size")).alias("extra"))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_SOURCES else df


def hash_thresholds(rows: DataFrame, budgets: DataFrame, n_sources: int) -> DataFrame:
    """rows: sk, size, h. budgets: sk, extra. Per source: edge (hash where the budget ends) and take_edge.

    Rows with h < edge are taken, and those with h = edge if take_edge: if that brings the sum nearer to
    the budget. A budget that no row ends has no edge.
    """
    at = budgets.where("extra > 0").select("sk", F.col("extra").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    for level in range(HASH_BITS // DIGIT_BITS):
        shift = HASH_BITS - DIGIT_BITS * (level + 1)
        bucket = F.shiftright("h", shift)
        held = rows.select("sk", "size", bucket.alias("bucket"), F.shiftright("h", shift + DIGIT_BITS).alias("prefix"))
        sums = held.join(_small(at, n_sources), ["sk", "prefix"]).groupBy("sk", "rest", "bucket").agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("sk").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        at = sums.withColumn("upto", upto).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        at = at.select("sk", (F.col("rest") - (F.col("upto") - F.col("n"))).alias("rest"), F.col("bucket").alias("prefix"), "n")
        at = checkpointed(at)
    return at.select("sk", F.col("prefix").alias("edge"), (F.col("n") <= 2 * F.col("rest")).alias("take_edge"))


def _source_key(source: Column) -> Column:
    """Sorts like the source, by code point, with null last."""
    s = source.cast("string")
    return F.when(s.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), s))


def _hash(id_: Column, seed: str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null")))), 1, HASH_BITS // 4), 16, 10).cast("long")


def _copies(h: Column, plan: str = "") -> Column:
    """Copies of a row with hash h under the plan of its source, whose columns have the prefix plan."""
    extra, edge = F.col(f"{plan}extra"), F.col(f"{plan}edge")
    below = (extra > 0) & F.coalesce((h < edge) | (h == edge) & F.col(f"{plan}take_edge"), F.lit(True))
    return (F.col(f"{plan}base") + F.when(below, 1).otherwise(0)).cast("long")


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, cap: int, weights: int, seed: str) -> tuple[DataFrame, DataFrame, int]:
    """Light rows (doc_id, source, sk, size, h), the plan by sk, and the number of sources."""
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORDS)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), _source_key(F.col(source_col)).alias("sk"), size.alias("size"), _hash(F.col(id_col), seed).alias("h"))
    rows = checkpointed(rows)
    targets = checkpointed(source_targets(rows.groupBy("sk").agg(F.sum("size").alias("source_size")), cap, weights))
    n = targets.count()
    return rows, targets.join(hash_thresholds(rows, targets, n), "sk", "left"), n


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = 3, weights: int = 3, seed: str = "mix") -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken.

    Size is the number of words, counted over the whole text however long (null text: 0). Null sources are
    one source, last in order. Rows without words count 0 whatever their copies. Rows that repeat an id share
    its hash; null ids share one. No source, one source or an empty table give what the rule gives: each
    target is at most cap times its source. Other columns of docs, whatever their names, are ignored. Reruns
    agree: nothing depends on partitions or order.
    """
    rows, plan, n = _planned(docs, id_col, text_col, source_col, cap, weights, seed)
    out = rows.join(_small(plan, n), "sk").withColumn("copies", _copies(F.col("h")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = 3, weights: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of docs with all their columns, each as often as the mix takes it; rows without words go.

    A row's copies follow from its source and the hash of its id, so rows meet only the plan of their source
    and are not joined to each other; rows that repeat an id are judged each by its own source.
    """
    _, plan, n = _planned(docs, id_col, text_col, source_col, cap, weights, seed)
    plan = plan.select(F.struct("sk", "base", "extra", "edge", "take_edge").alias("__plan"))
    out = docs.where(F.coalesce(F.col(text_col).cast("string").rlike(WORDS), F.lit(False)))
    out = out.join(_small(plan, n), _source_key(F.col(source_col)) == F.col("__plan.sk"))
    out = out.withColumn("__copies", _copies(_hash(F.col(id_col), seed), "__plan.")).where("__copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words that the mix takes of it."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' END || coalesce(source, '') AS sk,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT sk, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY encode(sk)) - 1) % 3 + 1 AS w FROM d GROUP BY sk),
r AS (SELECT *, 3 * source_size / w::DOUBLE AS ratio, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w FROM s),
l AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE / (all_w - coalesce(sum(w) OVER o, 0)) AS level
      FROM r WINDOW o AS (ORDER BY ratio, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, (ratio, sk)) AS fill FROM l WHERE level <= ratio),
t AS (SELECT sk, source_size, least(3.0::DOUBLE * source_size, fill * w) AS target FROM l, f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS base FROM t),
g AS (SELECT sk, h, sum(size) AS n FROM d GROUP BY sk, h),
c AS (SELECT *, sum(n) OVER (PARTITION BY sk ORDER BY h) AS upto FROM g)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * (b.base + CASE WHEN target - base * source_size > 0 AND 2 * upto - n <= 2 * (target - base * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b USING (sk) JOIN c ON c.sk = d.sk AND c.h = d.h
"""
