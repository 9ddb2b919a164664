"""Similarity join on word n-grams: Jaccard of five-word shingle sets, with Bayesian candidate pruning.

Documents with one shingle set are one class, joined once. Classes that agree in a band of MinHash values
are candidates: within a bucket their values are compared a few at a time, and a pair is dropped as soon as
the posterior probability of reaching the threshold (uniform prior, agreements binomial) is below
TOLERANCE. What is left connects classes into candidate groups; within these each pair is verified
exactly on the shingle sets (as 64-bit hashes), unless the same pruning drops it first. Buckets and groups
beyond BLOCK members are dealt out as pairs of blocks, so no task holds a large one, and no pairs are
written: tasks give each class its links and the edges of a spanning forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import text_slices
from lectern.llm.caches import keeps, only
from lectern.llm.components import connected_components
from lectern.plans.durable import checkpointed

SHINGLE, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8 ** 5) ** 40, about 1e-7.
BANDS, BAND_ROWS = 40, 5
TOLERANCE, STEP = 1e-5, 40
BLOCK = 256
_RANDOM = np.random.Generator(np.random.PCG64(20240503))
_A = _RANDOM.integers(0, 1 << 31, BANDS * BAND_ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32)
_MIX = _RANDOM.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hash of each word, remembered for the words that come first."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 300_000:
            self[word] = h
        return h


_WORDS = WordHashes()
keeps("shingles", _WORDS.clear)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct five-word shingles; a shorter text is one shingle, an empty one none."""
    words = [(t or "").lower().encode("utf-8", "replace").split() for t in texts]
    ends = np.cumsum([0, *map(len, words)]).tolist()
    w = np.fromiter((h for x in words for h in map(_WORDS.__getitem__, x)), np.uint64, ends[-1])
    s = np.zeros(len(w), np.uint64)
    for k in range(SHINGLE):
        s[: max(0, len(w) - k)] += w[k:] * _MIX[k]
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= SHINGLE:
            x = s[a : b - SHINGLE + 1]
        else:
            x = (w[a:b] * _MIX[: b - a]).sum(dtype=np.uint64).reshape(1)[: b - a]
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        out.append(np.unique(x ^ (x >> np.uint64(32))))
    return out


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def minhash(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(16)).astype(np.uint32)
    least = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (x[i : i + 512, None] * _A + _B).min(axis=0), out=least)
    return least


def band_hashes(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's values."""
    h = (values.reshape(BANDS, BAND_ROWS).astype(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def least_agreements(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest agreements of n values at which P(similarity >= threshold) is tolerance at least.

    Under a uniform prior the posterior is Beta(m + 1, n - m + 1), whose tail is that of a binomial: P(Bin(n + 1, threshold) <= m).
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def surviving_pairs(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (a, b) of rows of values that no look at the next STEP values rules out."""
    same = np.zeros(len(a), np.int64)
    for n in range(STEP, values.shape[1] + 1, STEP):
        same += (values[a, n - STEP : n] == values[b, n - STEP : n]).sum(axis=1)
        keep = same >= least_agreements(n)
        a, b, same = a[keep], b[keep], same[keep]
    return a, b


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Least vertex of each one's component, of n vertices under the edges."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


@lru_cache(maxsize=1000)
def _triangle(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _pairs(block: np.ndarray, first: int, second: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within a block, or across two."""
    if first == second:
        return _triangle(len(block))
    a, b = np.meshgrid(np.flatnonzero(block == first), np.flatnonzero(block == second), indexing="ij")
    return a.ravel(), b.ravel()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: id, key, name of its set, a hash for each band, and the low byte of each MinHash value (unequal values agree in one case of 256)."""
    only("shingles")
    for batch in text_slices(batches, 2):
        sets = shingle_sets(batch.column(2).to_pylist())
        bands, low = [], []
        for s in sets:
            v = minhash(s) if len(s) else None
            bands.append(None if v is None else band_hashes(v).tobytes())
            low.append(None if v is None else v.astype(np.uint8).tobytes())
        columns = [batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in ([set_name(s) for s in sets], bands, low))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "name", "bands", "low"])


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a forest over the pairs of each bucket (or pair of its blocks) that pruning leaves.

    Buckets are mostly pairs, so a batch's are taken together. An edge leads to the least name of its
    tree: buckets that hold the same classes then mostly give the same edges.
    """
    for batch in (b.slice(i, 2000) for b in batches for i in range(0, b.num_rows, 2000)):
        members = batch.column("members").flatten()
        sizes = np.diff(batch.column("members").offsets.to_numpy())
        starts = np.cumsum(sizes) - sizes
        names, low, block = (members.field(f) for f in ("name", "low", "block"))
        values = np.frombuffer(b"".join(low.to_pylist()), np.uint8).reshape(len(low), -1)
        names, block = names.to_pylist(), block.to_numpy()
        none = np.empty(0, np.int64)
        left, right, inner = [none], [none], [(none, none)]
        for start, n, i, j in zip(starts.tolist(), sizes.tolist(), batch.column("i").to_pylist(), batch.column("j").to_pylist(), strict=True):
            own, v = block[start : start + n], values[start : start + n]
            a, b = _pairs(own, i, j)
            if len(a) > 10_000:  # one at a time, so that memory stays bounded
                a, b = surviving_pairs(v, a, b)
            if i != j:  # what links a block within itself is another group's to tell
                for k in (i, j):
                    at = np.flatnonzero(own == k)
                    x, y = _triangle(len(at))
                    x, y = surviving_pairs(v, at[x], at[y])
                    inner.append((x + start, y + start))
            left.append(a + start)
            right.append(b + start)
        a, b = surviving_pairs(values, np.concatenate(left), np.concatenate(right))
        # Each bucket's members are apart from the others', by place, so one forest serves all; places follow names.
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        x, y = (np.concatenate(side) for side in zip(*inner, strict=True))
        told = forest(len(names), rank[x], rank[y])
        root = forest(len(names), np.concatenate([rank[a], rank[x]]), np.concatenate([rank[b], rank[y]]))
        edges = {(names[order[k]], names[order[r]]) for k, r in zip(told, root, strict=True) if k != r}
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges], pa.binary()), pa.array([y for _, y in edges], pa.binary())], ["a", "b"])


def common_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (a, b): one by one if they are few, else by products of 0/1 matrices over the shingles that two sets share at least."""
    if 8 * len(a) < len(sets) ** 2:
        return np.array([np.isin(sets[i], sets[j], assume_unique=True, kind="sort").sum() for i, j in zip(a.tolist(), b.tolist(), strict=True)], np.float64)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[at] > 1
    place = np.cumsum(n > 1) - 1
    of, at, width = of[shared], place[at[shared]], int((n > 1).sum())
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    for start in range(0, width, 4096):
        lo, hi = np.searchsorted(at, (start, start + 4096))
        m = np.zeros((len(sets), min(4096, width - start)), np.float32)
        m[of[lo:hi], at[lo:hi] - start] = 1
        out += m @ m.T
    return out[a, b]


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("shingles")
        for batch in batches:
            names, roots, links = [], [], []
            for k in range(batch.num_rows):  # one group of members as objects at a time
                i, j, members = (batch.column(c)[k].as_py() for c in ("i", "j", "members"))
                members = sorted(members, key=lambda m: m["name"])
                a, b = _pairs(np.array([m["block"] for m in members]), i, j)
                a, b = surviving_pairs(np.frombuffer(b"".join([m["low"] for m in members]), np.uint8).reshape(len(members), -1), a, b)
                sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
                size, copies = np.array([len(s) for s in sets]), np.array([m["copies"] for m in members])
                keep = common_counts(sets, a, b) * (1 + threshold) >= threshold * (size[a] + size[b]) - 1e-6
                a, b = a[keep], b[keep]
                n = np.bincount(a, copies[b], len(sets)) + np.bincount(b, copies[a], len(sets))
                for own, root in enumerate(forest(len(sets), a, b)):
                    if n[own]:
                        names.append(members[own]["name"])
                        roots.append(members[root]["name"])
                        links.append(int(n[own]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(roots, pa.binary()), pa.array(links, pa.int64())], ["a", "b", "links"])

    return run


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("shingles")
    for batch in text_slices(batches, "t"):
        sets = shingle_sets(batch.column("t").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array([s.tobytes() for s in sets], pa.binary())], ["name", "shingles"])


def _dealt(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Members of each key in groups of bounded size: whole, or, if the key has more than BLOCK (column n), pairs of blocks i <= j."""
    k = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("name"), k).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return rows.groupBy(key, "i", "j").agg(F.collect_list(F.struct("name", "block", *fields)).alias("members")).where(F.size("members") > 1)


def _row_key(docs: DataFrame) -> Column:
    """128 bits of hash of a row's columns; rows that are equal in all of them share it."""
    columns = [F.to_json(c) if "map<" in docs.schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in docs.columns]
    return F.concat(F.hex(F.xxhash64(F.lit(1), *columns)), F.lit("-"), F.hex(F.xxhash64(F.lit(2), *columns)))


def _classified(rows: DataFrame, threshold: float) -> DataFrame:
    """rows: doc_id, key, t. One row for each: doc_id, key, label (name of the class), class_id, class_size, n_links."""
    if threshold < THRESHOLD:
        raise ValueError(f"the bands find pairs from {THRESHOLD} on")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketched = checkpointed(rows.mapInArrow(_sketches, f"doc_id {kind}, key string, name binary, bands binary, low binary"))
    classes = sketched.groupBy("name").agg(F.min("doc_id").alias("least_id"), F.min("key").alias("text_key"), F.count("*").alias("copies"), F.min("bands").alias("bands"), F.min("low").alias("low"))
    classes = checkpointed(classes)
    # Bands: 8 bytes of hash each. Only buckets of two classes or more go on.
    full = classes.where("bands IS NOT NULL")
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    bands = full.select("name", "bands", band.alias("band")).select("name", F.xxhash64("band", F.substring("bands", F.col("band") * 8 + 1, F.lit(8))).alias("bucket"))
    buckets = checkpointed(bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    members = checkpointed(bands.join(buckets, "bucket").join(full.select("name", "low"), "name"))
    found = _dealt(members, "bucket", ["low"]).mapInArrow(_prune, "a binary, b binary")
    groups = connected_components(found)
    sizes = checkpointed(groups.groupBy("label").agg(F.count("*").alias("n")))
    chosen = checkpointed(groups.join(sizes, "label").select(F.col("v").alias("name"), "label", "n").join(full.select("name", "text_key", "copies", "low"), "name"))
    # One text of each class that is left; rows that are equal in all columns share a key, and one of them is taken.
    texts = rows.join(chosen.select("name", F.col("text_key").alias("key")), "key").select("name", "t")
    sets = texts.mapInArrow(_shingles_of, "name binary, shingles binary").groupBy("name").agg(F.first("shingles").alias("shingles"))
    verified = checkpointed(_dealt(chosen.join(sets, "name"), "label", ["shingles", "copies", "low"]).mapInArrow(_verify(threshold), "a binary, b binary, links long"))
    links = verified.groupBy(F.col("a").alias("name")).agg(F.sum("links").alias("links"))
    # Roots of blocks have rows only if they have links, so every linked class is a vertex.
    joined = connected_components(verified.select("a", "b"))
    placed = checkpointed(classes.select("name", "least_id", "copies").join(joined.withColumnRenamed("v", "name"), "name", "left").join(links, "name", "left").withColumn("label", F.coalesce("label", "name")))
    whole = checkpointed(placed.groupBy("label").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size")))
    placed = checkpointed(placed.join(whole, "label").select("name", "label", "class_id", "class_size", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return sketched.select("doc_id", "key", "name").join(placed, "name").drop("name")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, class_id, class_size, n_links.

    n_links counts the other rows whose shingle sets have a Jaccard similarity of threshold or more; a
    class is what links connect, class_id its least id (null if all its ids are), class_size its rows. Words are what stands
    between ASCII white space, lower-cased; a text of fewer than five is one shingle, a very long one is
    taken whole. Empty and null texts are copies of each other alone. Rows that repeat a document are copies.
    threshold is 0.8 at least: the bands are chosen for that. Other columns of docs, whatever their names, are
    ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    rows = rows.select("doc_id", _row_key(rows).alias("key"), "t")
    return _classified(rows, threshold).select("doc_id", "class_id", "class_size", "n_links")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, with all its columns, of each class: that with the least id (null ids last), of rows that share it the one with the least hash.

    Null and empty texts are one class, so one such row stays. Whether ids repeat or are null makes no
    difference: rows are told apart by a hash of all columns, and of rows equal in all of them one stays.
    """
    keyed = docs.withColumn("__key", _row_key(docs))
    rows = checkpointed(_classified(keyed.select(F.col(id_col).alias("doc_id"), F.col("__key").alias("key"), F.col(text_col).cast("string").alias("t")), THRESHOLD).select("doc_id", "key", "label"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")
    best = checkpointed(rows.groupBy("label").agg(F.min(order).alias("best")).select(F.col("best.key").alias("key")))
    same = checkpointed(rows.join(best, "key", "left_semi").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("__key")))
    gone = rows.join(best, "key", "left_anti").select(F.col("key").alias("__key")).unionAll(same)
    kept = keyed.join(gone, "__key", "left_anti").select(*docs.columns)
    if same.isEmpty():
        return kept
    whole = keyed.join(same, "__key").groupBy("__key").agg(F.first(F.struct(*docs.columns)).alias("r"))
    return kept.unionAll(whole.select("r.*"))


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Every document with its class of similar documents and the number of those it is linked to."""
    return ngram_jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
