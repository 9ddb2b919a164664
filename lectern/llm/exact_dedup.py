"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes has its top bits clear, so equal passages are
cut alike wherever they stand. Chunks get their SHA-256 as identifier; all chunks of one identifier are
compared before it is used: byte by byte within a batch and between tasks (the one time that content is
shuffled, each distinct chunk once per task), by a BLAKE2b digest with those of a task's earlier batches.
Documents are then compared as ordered identifier lists, some 32 bytes for each 4 KB of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.durable import checkpointed

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 1024, 16384, 12
_GEAR = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 32, 256, dtype=np.uint32)


def joined_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All strings of an Arrow column as one bytes object, and where each begins and ends; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return (data.slice(at[0], at[-1] - at[0]).to_pybytes() if data else b""), at - at[0]


def rolling_cuts(h: np.ndarray, bits: int, steps: tuple[int, ...] = (1, 2, 4, 8, 16)) -> np.ndarray:
    """Positions after which a cut may fall: a gear hash (h: a random uint32 for each item), built by doubling, has its top bits clear."""
    for step in steps:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1


def chunk_ends(cuts: np.ndarray, start: int, end: int, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of items start to end: at cuts, each of least to most items, but for the last."""
    ends, last = [], start
    for cut in cuts[np.searchsorted(cuts, start + least) : np.searchsorted(cuts, end)].tolist():
        while cut - last > most:
            last += most
            ends.append(last)
        if cut - last >= least:
            ends.append(cut)
            last = cut
    while end - last > most:
        last += most
        ends.append(last)
    return [*ends, end]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """Per batch: the ids, and per document its bytes and the ends of its chunks. Only A-Z is lower-cased."""
    for batch in batches:
        data, at = joined_bytes(batch.column(1))
        data = data.lower()
        cuts, view = rolling_cuts(_GEAR[np.frombuffer(data, np.uint8)], CUT_BITS), memoryview(data)
        yield batch.column(0), [(view[a:b], [0, *(e - a for e in chunk_ends(cuts, a, b))]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, bytes] = {}  # a second digest of each name's content; saves shuffling; forgetting it is harmless
    for _, documents in _documents(batches):
        out: dict[bytes, list] = {}
        for text, ends in documents:
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                name = hashlib.sha256(text[a:b]).digest()
                kept = out.setdefault(name, [])
                if all(x != text[a:b] for x in kept):
                    kept.append(text[a:b])
        digests = {k: [hashlib.blake2b(x).digest() for x in v] for k, v in out.items()}
        rows = [(k, x.tobytes()) for k, v in out.items() for x, other in zip(v, digests[k], strict=True) if seen.get(k) != other]
        for k, v in digests.items():
            seen.setdefault(k, v[0])
        if len(seen) > 200_000:
            seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([x for _, x in rows], pa.binary())], ["chunk", "content"])


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, documents in _documents(batches):
        whole = [hashlib.sha256(text).hexdigest() for text, _ in documents]
        recipe = [b"".join(hashlib.sha256(text[a:b]).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)) for text, ends in documents]
        yield pa.RecordBatch.from_arrays([ids, pa.array(whole, pa.string()), pa.array(recipe, pa.binary())], ["doc_id", "text_sha256", "recipe"])


def collisions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Chunk identifiers that stand for more than one content: no rows, unless SHA-256 fails."""
    chunks = docs.select(F.lit(0).alias("i"), F.col(text_col).cast("string").alias("t")).mapInArrow(_chunks, "chunk binary, content binary")
    return chunks.groupBy("chunk").agg(F.min("content").alias("lo"), F.max("content").alias("hi")).where("lo != hi").select("chunk")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal if identical once A-Z is lower-cased; null counts as empty, and all empty texts are
    equal. keep_id is the largest id of the group; null ids never win, and a group of null ids only has
    keep_id null and kept false. Rows that repeat the kept id with the same text are all kept. Other
    columns, whatever their names, are ignored; an empty table gives no rows. A chunk identifier that
    stands for two contents stops the run rather than merging texts.
    """
    if bad := collisions(docs, text_col).head(1):
        raise ValueError(f"chunk identifier {bytes(bad[0][0]).hex()} has several contents")
    kind = docs.schema[id_col].dataType.simpleString()
    recipes = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(_recipes, f"doc_id {kind}, text_sha256 string, recipe binary")
    recipes = checkpointed(recipes)
    groups = checkpointed(recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256", (F.length("recipe") / 32).cast("long").alias("n_chunks")
    )


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the id that its group of equal texts keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       coalesce(doc_id = max(doc_id) OVER (PARTITION BY text_sha256), false) AS kept, text_sha256
FROM t
"""
