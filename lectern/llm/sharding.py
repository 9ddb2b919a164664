"""Sharding by a k-d tree over metadata.

Groups of equal texts are points; each has some numeric metadata dimensions and the bytes of its rows.
From the root, a node that stands for m shards is split at the distributed weighted quantile that gives
ceil(m / 2) and floor(m / 2) of them their share of bytes, along the dimension that is widest in the node
against the whole. A cut is found by refining histograms, so no points are sorted or gathered; the driver
holds only the tree and, per node, BINS sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.durable import checkpointed

BINS = 1024
#: A coordinate is a scaled value in the bits above, with bits of the text's digest below to part equal values.
VALUE_SCALE, TIE_BITS = 1 << 20, 32


def _of_node(values: dict[int, object], kind: str) -> Column:
    """The value for the row's node, from a map of at most one entry a shard."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]).cast(f"map<int,{kind}>"), F.col("node"))


def _coordinate(dims: list[str], chosen: dict[int, str]) -> Column:
    return F.element_at(F.array(*dims), _of_node({n: dims.index(d) + 1 for n, d in chosen.items()}, "int"))


def _split(points: DataFrame, shards: dict[int, int], dims: list[str], tolerance: float) -> dict[int, tuple[str, int]]:
    """Per node: the dimension and the largest coordinate of its left part. Points have node, weight and dims."""
    tie = 1 << TIE_BITS
    spread = points.groupBy("node").agg(F.sum("weight").alias("w"), *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("lo", F.min), ("hi", F.max))]).collect()
    open_cuts, cuts = {}, {}
    for r in spread:
        dim = max(dims, key=lambda d: (r[f"hi_{d}"] // tie - r[f"lo_{d}"] // tie, r[f"hi_{d}"] - r[f"lo_{d}"]))
        m = shards[r.node]
        open_cuts[r.node] = {"dim": dim, "lo": r[f"lo_{dim}"], "hi": r[f"hi_{dim}"], "want": r.w * ((m + 1) // 2) / m, "slack": r.w / m * tolerance}
    while open_cuts:
        here = points.where(F.col("node").isin(list(open_cuts))).select("node", "weight", _coordinate(dims, {n: c["dim"] for n, c in open_cuts.items()}).alias("x"))
        lo, hi = (_of_node({n: c[k] for n, c in open_cuts.items()}, "long") for k in ("lo", "hi"))
        step = _of_node({n: -(-(c["hi"] - c["lo"] + 1) // BINS) for n, c in open_cuts.items()}, "long")
        bins = here.where((F.col("x") >= lo) & (F.col("x") <= hi)).groupBy("node", F.floor((F.col("x") - lo) / step).alias("bin")).agg(F.sum("weight").alias("w"), F.min("x").alias("a"), F.max("x").alias("b"))
        by: dict[int, list] = {}
        for r in sorted(bins.collect(), key=lambda r: r.a):
            by.setdefault(r.node, []).append(r)
        for node, rows in by.items():
            c, before = open_cuts[node], 0
            for i, r in enumerate(rows):
                if before + r.w >= c["want"] or i == len(rows) - 1:
                    break
                before += r.w
            over, under = before + r.w - c["want"], c["want"] - before
            if r.a == r.b or min(abs(over), under) <= c["slack"]:  # near enough, or nothing left to part
                cuts[node] = (c["dim"], r.b if abs(over) <= under else r.a - 1)
                del open_cuts[node]
            else:
                c |= {"lo": r.a, "hi": r.b, "want": under}
    return cuts


def kd_place(points: DataFrame, dims: list[str], shards: int, tolerance: float = 0.002) -> tuple[DataFrame, dict[int, tuple[str, int]]]:
    """points with the shard each falls in, and the cuts by node: the root is 1, the children of n are 2n and 2n + 1.

    points: weight, and dims as non-negative long coordinates. tolerance is in shares of a shard, per cut.
    """
    points = points.withColumn("node", F.lit(1))
    counts, first, cuts = {1: shards}, {1: 0}, {}
    while level := {n: m for n, m in counts.items() if m > 1 and n not in cuts}:
        found = _split(points.where(F.col("node").isin(list(level))), level, dims, tolerance)
        for n, m in level.items():
            cuts[n] = found.get(n, (dims[0], 0))  # of a node without points
            counts |= {2 * n: (m + 1) // 2, 2 * n + 1: m // 2}
            first |= {2 * n: first[n], 2 * n + 1: first[n] + (m + 1) // 2}
        x, cut = _coordinate(dims, {n: cuts[n][0] for n in level}), _of_node({n: cuts[n][1] for n in level}, "long")
        points = points.withColumn("node", F.when(F.col("node").isin(list(level)), 2 * F.col("node") + F.when(x <= cut, 0).otherwise(1)).otherwise(F.col("node")))
        points = checkpointed(points)  # a light row for each distinct text; deeper expressions outgrow one method
    leaves = {n: first[n] for n in counts if n not in cuts}
    return points.withColumn("shard", _of_node(leaves, "int")).drop("node"), cuts


def _heavy(groups: DataFrame, shards: int) -> list[bytearray]:
    """Digests of groups that are larger than the share of a shard, heaviest first: each takes a shard from the others."""
    rest, out = groups.agg(F.sum("weight").alias("w")).first().w or 0, []
    for r in groups.select("digest", "weight").orderBy(F.desc("weight"), "digest").limit(shards).collect():  # at most one a shard
        if r.weight * (shards - len(out)) <= rest or len(out) == shards - 1:
            break
        out.append(r.digest)
        rest -= r.weight
    return out


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ("lang", "source"), slot_rows: int = 100_000) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Size is the UTF-8 bytes of the text (null: none) plus 16; shards are near equal in size. Dimensions:
    bytes of the text on a log scale, and a place for each value of the metadata columns (of a group of
    equal texts, the least value; null first). Equal texts, null being empty, share a shard however many
    they are, so a group larger than a shard's share gets one of its own, and the rest is shared evenly. Slots count
    each shard's rows from 0 without gaps; repeated rows get slots of their own. Columns of metadata that
    docs lacks are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    metadata = tuple(c for c in metadata if c in docs.columns)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"), *[F.col(c).cast("string").alias(f"m_{c}") for c in metadata],
    )
    rows = checkpointed(rows)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("weight"), F.min("size").alias("bytes"), *[F.min(f"m_{c}").alias(f"m_{c}") for c in metadata])
    tie = F.conv(F.substring(F.hex("digest"), 1, TIE_BITS // 4), 16, 10).cast("long")

    def coordinate(value: Column) -> Column:
        """value: 0 to 1."""
        return F.floor(value * VALUE_SCALE).cast("long") * (1 << TIE_BITS) + tie

    # A value's place: 20 bits of its hash, as distinct values may be many; null is 0.
    places = [coordinate(F.coalesce(F.conv(F.substring(F.md5(f"m_{c}"), 1, 5), 16, 10).cast("double") / VALUE_SCALE, F.lit(0.0))).alias(f"d_{c}") for c in metadata]
    groups = checkpointed(groups.select("digest", "weight", coordinate(F.least(F.log2("bytes") / 32, F.lit(1.0))).alias("d_bytes"), *places))
    dims = ["d_bytes", *[f"d_{c}" for c in metadata]]
    heavy = _heavy(groups, shards)
    alone = spark.createDataFrame([(d, shards - 1 - i) for i, d in enumerate(heavy)], "digest binary, shard int")
    light = groups.join(F.broadcast(alone), "digest", "left_anti") if heavy else groups
    placed = kd_place(light, dims, shards - len(heavy))[0].select("digest", "shard")
    placed = checkpointed(placed.unionByName(alone) if heavy else placed)
    rows = rows.join(placed, "digest")
    # Slots: rows are numbered within hashed parts of a shard, of about slot_rows each, behind those of the parts before.
    parts = max(1, -(-groups.count() // slot_rows))
    rows = checkpointed(rows.select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int").alias("part"), F.pmod(F.xxhash64("doc_id", "digest"), F.lit(16)).cast("int").alias("sub")))
    counts = rows.groupBy("shard", "part", "sub").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part", "sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = checkpointed(counts.select("shard", "part", "sub", before.alias("before")))
    numbered = rows.withColumn("i", F.row_number().over(Window.partitionBy("shard", "part", "sub").orderBy("doc_id", "text_crc32", "size")))
    return numbered.join(counts, ["shard", "part", "sub"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("i") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document with its shard (0 to 39) and slot."""
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
