"""Token ids in a content-addressed store.

Layout under one folder, all Parquet: kind=chunk (chunk: SHA-256 of the ids as little-endian unsigned
32-bit integers; n_ids; payload: the ids, narrowed and zstd-compressed), each distinct chunk once;
documents (doc_id, start, n_tokens, recipe: its chunks' names in order, merkle: root over them), in
ascending order of doc_id; manifest (part, parts: how many there are, first and last doc_id, documents,
start, n_tokens, merkle root over its documents). Id streams are cut where a rolling hash of 16 ids has its
top bits clear, so documents that share long passages share chunks. Reading checks every payload against
its name, every document's Merkle root, and every part against the manifest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.batches import text_slices
from lectern.llm.caches import only
from lectern.llm.exact_dedup import chunk_ends, rolling_cuts
from lectern.llm.subwords import word_encoder
from lectern.plans.durable import checkpointed, new_folder

MIN_IDS, MAX_IDS, CUT_BITS = 256, 8192, 9
#: Text encoded at a time.
ENCODE_BYTES = 8 << 20
_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC-32's, bits reflected."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ _POLY if b & 1 else b >> 1
    return product


@lru_cache(maxsize=100_000)
def _shift(n: int) -> int:
    """x to the power 8n."""
    power, square = 1 << 31, 1 << 23  # x^0, x^8
    while n:
        if n & 1:
            power = _times(square, power)
        square, n = _times(square, square), n >> 1
    return power


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of data of which the parts have these (crc, bytes)."""
    crc = 0
    for one, n in parts:
        crc = _times(_shift(n), crc) ^ one
    return crc


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of a binary SHA-256 tree; an odd node moves up; no leaves: the hash of nothing."""
    while len(leaves) > 1:
        leaves = [hashlib.sha256(leaves[i] + leaves[i + 1]).digest() if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0] if leaves else hashlib.sha256(b"").digest()


def _encode(path: str, end_id: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        only("words")
        encoder, pack = word_encoder(path), zstandard.ZstdCompressor(level=1)
        gear = np.random.Generator(np.random.PCG64(20240502)).integers(0, 1 << 32, 1 << 16, dtype=np.uint32)
        seen = set()
        for batch in text_slices(batches, 1, ENCODE_BYTES, 10_000):
            found = encoder.slice(encoder.lowered(batch.column(1)))
            ids = np.insert(found.ids, found.ends[1:], encoder.dtype.type(end_id))
            ends = (found.ends + np.arange(len(found.ends))).tolist()
            cuts = rolling_cuts(gear[ids & 0xFFFF], CUT_BITS, (1, 2, 4, 8))
            wide, recipes, fresh = ids.astype("<u4"), [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                names, last = [], a
                for cut in chunk_ends(cuts, a, b, MIN_IDS, MAX_IDS):
                    names.append(hashlib.sha256(wide[last:cut]).digest())
                    if names[-1] not in seen:
                        seen.add(names[-1])
                        fresh.append((names[-1], cut - last, pack.compress(ids[last:cut].tobytes())))
                    last = cut
                recipes.append(b"".join(names))
            n, m = len(recipes), len(fresh)
            columns = [
                pa.array(["doc"] * n + ["chunk"] * m), pa.concat_arrays([batch.column(0).cast(kind), pa.nulls(m, kind)]), pa.array([b - a for a, b in zip(ends[:-1], ends[1:], strict=True)] + [None] * m, pa.int64()),
                pa.array(recipes + [None] * m, pa.binary()), pa.array([None] * n + [x[0] for x in fresh], pa.binary()), pa.array([None] * n + [x[1] for x in fresh], pa.int64()), pa.array([None] * n + [x[2] for x in fresh], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "doc_id", "n_tokens", "recipe", "chunk", "n_ids", "payload"])
            if len(seen) > 500_000:
                seen.clear()  # the exchange drops what is sent twice

    return run


def _each_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for i, name in enumerate(batch.column("chunk").to_pylist()):
            if name is None or name not in seen:
                keep.append(i)
                seen.add(name)
        yield batch.take(pa.array(keep, pa.int64()))


def _starts(offsets: dict[int, int]):
    """Rows of one part in order: start, and the Merkle root of each recipe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n_tokens").to_numpy()
            at = offsets[batch.column("part")[0].as_py()] if at is None else at
            upto = np.cumsum(n)
            roots = [merkle_root([r[i : i + 32] for i in range(0, len(r), 32)]) for r in batch.column("recipe").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(at + upto - n), batch.column("n_tokens"), batch.column("recipe"), pa.array(roots, pa.binary())], ["doc_id", "part", "start", "n_tokens", "recipe", "merkle"])
            at += int(upto[-1])

    return run


def _part_roots(parts: pa.Array) -> pa.Array:
    """Merkle root over the documents' roots of each part, in order."""
    return pa.array([merkle_root([d["merkle"] for d in part]) for part in parts.to_pylist()], pa.binary())


def _manifest(documents: DataFrame) -> DataFrame:
    """What the manifest has to say of these documents: a row for each part of about part_rows documents."""
    listed = F.array_sort(F.collect_list(F.struct("start", "merkle")))
    found = documents.groupBy("part").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("documents"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), listed.alias("listed")
    )
    return found.withColumn("merkle", F.arrow_udf(_part_roots, "binary")("listed")).drop("listed")


def write_store(docs: DataFrame, uri: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", part_rows: int = 50_000) -> None:
    """Encodes all of docs, each with end_id behind it, and writes the store to uri (a folder that does not exist yet).

    Null texts are empty and give end_id alone; very long ones are cut into many chunks. Null ids come first;
    rows that repeat an id are documents of their own, side by side. An empty table gives a store without
    documents. Other columns of docs, whatever their names, are not stored. Writes are Spark's own, so a task
    that is run again leaves nothing behind.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    schema = f"kind string, doc_id {kind.simpleString()}, n_tokens long, recipe binary, chunk binary, n_ids long, payload binary"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(_encode(tokenizer_path, end_id, to_arrow_type(kind)), schema)
    rows = rows.repartition(F.when(F.col("chunk").isNull(), F.xxhash64("doc_id", "recipe")).otherwise(F.xxhash64("chunk"))).mapInArrow(_each_once, schema)
    rows.write.partitionBy("kind").option("compression", "uncompressed").parquet(f"{uri}/stage")
    names = spark.read.schema(f"{schema.split(', ', 1)[1]}, kind string").parquet(f"{uri}/stage").where("kind = 'doc'").select("doc_id", "n_tokens", "recipe")
    parts = max(1, -(-names.count() // part_rows))
    # Rows that repeat a document differ only in where they lie, which parts them too.
    order = [F.col("doc_id").asc_nulls_first(), F.col("recipe").asc(), F.col("at").asc()]
    names = names.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    names = checkpointed(names.drop("at"))
    sums = sorted((r.part, r.n) for r in names.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # one row a part
    offsets, total = {}, 0
    for part, n in sums:
        offsets[part], total = total, total + n
    listed = names.mapInArrow(_starts(offsets), f"doc_id {kind.simpleString()}, part int, start long, n_tokens long, recipe binary, merkle binary")
    listed.write.parquet(f"{uri}/documents")
    _manifest(spark.read.parquet(f"{uri}/documents")).withColumn("parts", F.lit(len(sums))).write.parquet(f"{uri}/manifest")


def check_manifest(spark: SparkSession, uri: str) -> None:
    """Raises ValueError if parts are missing from the manifest, or documents don't give what it says of their part."""
    told = spark.read.parquet(f"{uri}/manifest")
    found = _manifest(spark.read.parquet(f"{uri}/documents"))
    facts = ["first_id", "last_id", "documents", "start", "n_tokens", "merkle"]
    both = told.select("part", F.struct(*facts).alias("told")).join(found.select("part", F.struct(*facts).alias("found")), "part", "full_outer")
    if bad := both.where(~F.col("told").eqNullSafe(F.col("found"))).head(1):
        raise ValueError(f"part {bad[0].part} is not what the manifest says")
    count = told.agg(F.count("*").alias("n"), F.max("parts").alias("parts")).first()
    if count.n != (count.parts or 0):
        raise ValueError(f"the manifest has {count.n} of {count.parts} parts")


def _verified(dtype: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            crcs = []
            for name, n, payload in zip(batch.column("chunk").to_pylist(), batch.column("n_ids").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                ids = np.frombuffer(unpack.decompress(payload, max_output_size=n * width), dtype).astype("<u4")
                if len(ids) != n or hashlib.sha256(ids).digest() != name:
                    raise ValueError(f"chunk {name.hex()} does not hold what its name says")
                crcs.append(zlib.crc32(ids))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("n_ids"), pa.array(crcs, pa.int64())], ["chunk", "n_ids", "crc"])

    return run


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs, n = [], []
        for parts, root, tokens, many in zip(batch.column("parts").to_pylist(), batch.column("merkle").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("many").to_pylist(), strict=True):
            n.append(sum(p["n_ids"] or 0 for p in parts))
            if len(parts) != many or n[-1] != tokens or merkle_root([p["chunk"] for p in parts]) != root:
                raise ValueError("a document's chunks do not give its Merkle root")
            crcs.append(crc32_joined([(p["crc"], 4 * p["n_ids"]) for p in parts]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(n, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _placed(spark: SparkSession, uri: str) -> DataFrame:
    """One row for each chunk of each document: row, doc_id, start, n_tokens, merkle, many, pos, chunk."""
    docs = spark.read.parquet(f"{uri}/documents").withColumn("many", (F.length("recipe") / 32).cast("int"))
    docs = docs.withColumn("row", F.monotonically_increasing_id())
    docs = docs.withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    return docs.select("row", "doc_id", "start", "n_tokens", "merkle", "many", "pos", F.substring("recipe", F.col("pos") * 32 + 1, F.lit(32)).alias("chunk"))


def _stored_chunks(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.schema("chunk binary, n_ids long, payload binary, kind string").parquet(f"{uri}/stage").where("kind = 'chunk'").select("chunk", "n_ids", "payload")


def read_digests(spark: SparkSession, uri: str, tokenizer_path: str) -> DataFrame:
    """One row a document from the files alone: doc_id, start, n_tokens, ids_crc32. Damage stops the run.

    Payloads are read where they lie; only their checksums move, and a document's follows from its chunks'.
    """
    check_manifest(spark, uri)
    dtype = word_encoder(tokenizer_path).dtype
    sums = _stored_chunks(spark, uri).mapInArrow(_verified(dtype.str, dtype.itemsize), "chunk binary, n_ids long, crc long")
    parts = F.array_sort(F.collect_list(F.struct("pos", "chunk", "n_ids", "crc"))).alias("parts")
    placed = _placed(spark, uri).join(sums, "chunk", "left").groupBy("row", "doc_id", "start", "n_tokens", "merkle", "many").agg(parts)
    schema = placed.select("doc_id", "start", "n_tokens", F.lit(0).cast("long").alias("ids_crc32")).schema
    return placed.mapInArrow(_assembled, schema)


def _unpacked(dtype: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            ids = []
            for parts in batch.column("parts").to_pylist():
                data = b"".join(unpack.decompress(p["payload"], max_output_size=p["n_ids"] * width) for p in parts)
                ids.append(np.frombuffer(data, dtype).astype(np.int32))
            ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*ids, np.empty(0, np.int32)])))], ["doc_id", "start", "ids"])

    return run


def read_ids(spark: SparkSession, uri: str, tokenizer_path: str) -> DataFrame:
    """The documents themselves: doc_id, start, ids (array of int)."""
    check_manifest(spark, uri)
    dtype = word_encoder(tokenizer_path).dtype
    whole = _placed(spark, uri).join(_stored_chunks(spark, uri), "chunk").groupBy("row", "doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "n_ids", "payload"))).alias("parts"))
    return whole.mapInArrow(_unpacked(dtype.str, dtype.itemsize), whole.select("doc_id", "start", F.lit(None).cast("array<int>").alias("ids")).schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def stored_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes docs to a store of its own in the shared folder and reads it back."""
    path, uri = tokenizer_path or default_tokenizer(), new_folder(docs.sparkSession, "token-store")
    write_store(docs, uri, path)
    return read_digests(docs.sparkSession, uri, path)


def op8_token_output(spark, sf_dir: str) -> DataFrame:
    """Every document as it stands in the store: where its ids begin, how many they are, their checksum."""
    return stored_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
