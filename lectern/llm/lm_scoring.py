"""Scoring texts with a causal self-attention model on subword ids, trained in numpy.

The model (attention_model) predicts a slot: one of the most frequent ids, the end of a text, or the tail,
whose ids have add-one shares by their counts in all training texts. Texts are encoded once, into Parquet in
the shared folder. Training is local SGD: a task is a learner, and each of ROUNDS rounds takes every
ROUNDS-th window of its texts, from weights that are the mean of the round before; so each id of each
training text is learned from once, at every size of the input. Texts are scored in windows of WINDOW ids that
overlap by OVERLAP; each id is scored once, in the first window that has it. A unigram base over words goes
beside it: words frequent in training are counted from a bounded table that tasks hold, the others by a join
with all counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress, repeat
from operator import add, not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.attention_model import LOT, SLOTS, WINDOW, Model, first_weights
from lectern.llm.batches import text_slices
from lectern.llm.caches import only
from lectern.llm.exact_dedup import joined_bytes
from lectern.llm.subwords import Slice, word_encoder
from lectern.llm.token_store import default_tokenizer
from lectern.plans.durable import checkpointed, new_folder

TAIL, END = SLOTS - 1, 0
OVERLAP = 6
#: Windows in a step of each round of training, and its rate: many small steps first.
BATCHES, RATES = (32, 64, 128, 128, 128), (1.6e-2, 1.2e-2, 1e-2, 6e-3, 3e-3)
ROUNDS = len(BATCHES)
#: Windows that a learner shuffles at a time.
POOL = 8192
#: Words whose counts every task holds, and the most bytes of one; all others are joined.
HOT_WORDS, HOT_BYTES = 1 << 18, 64
#: Words counted by a task before it sends what it has.
COUNTED_WORDS = 200_000
#: Text encoded at a time.
ENCODE_BYTES = 4 << 20


def _encoded(path: str, kind: pa.DataType):
    """Per row its lower-cased text, words (with the end) and ids; beside them, rows with the counts of words of training texts, and of their ids (id in n_tokens)."""
    names = ["doc_id", "held", "t", "n_tokens", "ids", "word", "c"]

    def doc_rows(batch: pa.RecordBatch, texts: pa.Array, found: Slice) -> pa.RecordBatch:
        n = len(texts)
        columns = [batch.column(0), batch.column(1), texts, pa.array(found.word_counts() + 1, pa.int64()), pa.array([x.tobytes() for x in found.texts()], pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names)

    def count_rows(counts: dict[bytes, int]) -> pa.RecordBatch:
        n = len(counts)
        columns = [pa.nulls(n, kind), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names)

    def id_rows(total: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(total)
        n = len(some)
        columns = [pa.nulls(n, kind), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string()), pa.array(some), pa.nulls(n, pa.binary()), pa.nulls(n, pa.string()), pa.array(total[some])]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("words")
        encoder, counts = word_encoder(path), {}
        total = np.zeros(encoder.tokenizer.get_vocab_size(), np.int64)
        for batch in text_slices(batches, 2, ENCODE_BYTES, 10_000):
            texts = pc.ascii_lower(batch.column(2).fill_null(""))
            found, training = encoder.slice(texts), ~batch.column(1).to_numpy(zero_copy_only=False)
            n = np.bincount(found.codes[np.repeat(training, np.diff(found.word_ends))], minlength=len(found.words))
            some = np.flatnonzero(n)
            words = [found.words[i] for i in some.tolist()]
            counts.update(zip(words, map(add, map(counts.get, words, repeat(0)), n[some].tolist()), strict=True))
            counts.pop(b"", None)
            total += np.bincount(found.ids[np.repeat(training, np.diff(found.ends))], minlength=len(total))
            yield doc_rows(batch, texts, found)
            if len(counts) > COUNTED_WORDS:
                yield count_rows(counts)
                counts.clear()
        yield count_rows(counts)
        yield id_rows(total)

    return run


def training_windows(documents: list[np.ndarray], first: int, turn: int, rounds: int) -> tuple[np.ndarray, int]:
    """Those windows of the documents (slots) that are up in this turn, as rows of WINDOW + 1 slots, -1 behind the end; and how many windows there are.

    Windows follow each other without overlap, and are numbered on from first: each id and each end is the target of one.
    """
    length = np.array([len(d) + 1 for d in documents])
    s = np.concatenate([x for d in documents for x in ([END], d)] + [[END]]).astype(np.int16)
    begin = np.cumsum(length) - length
    many = -(-length // WINDOW)
    doc = np.repeat(np.arange(len(documents)), many)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    up = (first + np.arange(len(doc))) % rounds == turn
    doc, k = doc[up], k[up]
    at = k[:, None] * WINDOW + np.arange(WINDOW + 1)
    end = length[doc][:, None]
    # What follows a document's last id is its end; in s it is the begin of the next, which is the same slot.
    return np.where(at <= end, s[np.minimum(begin[doc][:, None] + at, len(s) - 1)], -1).astype(np.int16), len(up)


def _learner(weights, slot_of, dtype: str, turn: int):
    """One row: the weights after this task's windows of the turn, times how many these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        model, slots, random = Model(weights.value), slot_of.value, np.random.Generator(np.random.PCG64(turn))
        seen, n, pool, size = 0, 0, [], 0

        def learn() -> None:
            windows = np.concatenate(pool)
            windows = windows[random.permutation(len(windows))]
            for i in range(0, len(windows), BATCHES[turn]):
                model.train(windows[i : i + BATCHES[turn]], RATES[turn])

        for batch in text_slices(batches, 0):
            windows, many = training_windows([slots[np.frombuffer(x, dtype)] for x in batch.column(0).to_pylist()], seen, turn, ROUNDS)
            seen, n, size = seen + many, n + len(windows), size + len(windows)
            pool.append(windows)
            if size >= POOL:
                learn()
                pool, size = [], 0
        if size:
            learn()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([(model.flat * np.float32(n)).tobytes()], pa.binary())], ["n", "weights"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n, x = n + k, np.frombuffer(x, np.float32).astype(np.float64)
            total = x if total is None else total + x
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["n", "weights"])


def train(ids: DataFrame, slots: np.ndarray, slot_counts: np.ndarray, dtype: str) -> np.ndarray:
    """Weights learned from the rows of ids (column ids: binary), by ROUNDS of local SGD and averaging. ids must come in the same tasks each time."""
    sc = ids.sparkSession.sparkContext
    flat, slot_of = first_weights(slot_counts), sc.broadcast(slots)
    learners = max(1, ids.rdd.getNumPartitions())
    for turn in range(ROUNDS):
        sums = ids.mapInArrow(_learner(sc.broadcast(flat), slot_of, dtype, turn), "n long, weights binary")
        sums = sums.repartition(max(1, int(learners**0.5))).mapInArrow(_summed, "n long, weights binary")  # the driver gets a row for each of these
        total, mass = np.zeros(len(flat)), 0
        for r in sums.toLocalIterator():
            total, mass = total + np.frombuffer(r.weights, np.float32), mass + r.n
        if mass:
            flat = (total / mass).astype(np.float32)
    return flat


def score_ids(model: Model, tail: np.ndarray, slots: np.ndarray, documents: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of each id sequence and its end, LOT windows at a time."""
    length = np.array([len(d) + 1 for d in documents])
    s = np.concatenate([x for d in documents for x in ([END], slots[d])] + [[END]]).astype(np.int64)
    begin = np.cumsum(length) - length  # of each document's targets: its n-th target is s[begin + n + 1], but the last is END
    many = 1 + np.maximum(0, -(-(length - WINDOW) // (WINDOW - OVERLAP)))
    doc = np.repeat(np.arange(len(documents)), many)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    first = k * (WINDOW - OVERLAP)
    out = np.array([tail[d].sum() for d in documents])
    steps = np.arange(WINDOW)
    for some, known in ((np.flatnonzero(first == 0), 0), (np.flatnonzero(first), OVERLAP)):  # known: ids that the window before has scored
        for i in range(0, len(some), LOT):
            d, f = doc[some[i : i + LOT]], first[some[i : i + LOT]]
            t = f[:, None] + steps
            inside = t < length[d][:, None]
            place = np.minimum(begin[d][:, None] + t, len(s) - 2)
            at = np.flatnonzero(inside & (steps >= known))
            found = model.log_probabilities(np.where(inside, s[place], END), at, s[place.ravel()[at] + 1], known)
            out += np.bincount(d[at // WINDOW], found, len(documents))
    return out / np.log(10)


def _score(model_data, hot_words, dtype: str):
    """hot_words: words, and log10 of their counts and one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        flat, slots, tail = model_data.value
        model, get = Model(flat), hot_words.value.get
        for batch in text_slices(batches, 1):
            data, at = joined_bytes(batch.column(1))
            known, base, rare = [], [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                words = data[a:b].split()
                logs = list(map(get, words, repeat(0.0)))
                others = list(compress(words, map(not_, logs)))
                known.append(len(words) - len(others))
                base.append(sum(logs, 0.0))
                rare.append(b" ".join(others))
            score = score_ids(model, tail, slots, [np.frombuffer(x, dtype) for x in batch.column(3).to_pylist()])
            columns = [batch.column(0), batch.column(2), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(rare, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "known", "base", "rare", "score"])

    return run


def frequent_words(counts: DataFrame, most: int = HOT_WORDS) -> dict[bytes, int]:
    """Words of at most HOT_BYTES bytes with their counts, from a count on that at most about most words reach, the most frequent first; found by a histogram, without sorting all words."""
    short = counts.where(F.octet_length("word") <= HOT_BYTES).withColumn("bin", F.floor(F.log2("c") * 8).cast("int"))
    upto, least = 0, None
    for r in sorted(short.groupBy("bin").agg(F.count("*").alias("n")).collect(), reverse=True):  # 8 bins a doubling
        upto += r.n
        if upto > most:
            break
        least = r.bin
    if least is None:
        return {}
    found = [(r.word.encode(), r.c) for r in short.where(F.col("bin") >= least).select("word", "c").toLocalIterator()]
    return dict(sorted(found, key=lambda x: -x[1]))  # what is looked up most lies together


def lm_scores(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(id as text) mod modulus is not held_out; a null id is learned from, and
    rows that repeat a document are learned from and scored each. Null texts are empty and have one token, the
    end. Very long texts are scored whole, window by window. Without training rows all counts are 0 and the
    model is its random start; an empty table gives no rows. Other columns, whatever their names, are ignored.
    The base counts A-Z as lower case; the model's ids are of lower-cased text, where every id and the end
    have a probability above 0.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    path, spark = tokenizer_path or default_tokenizer(), docs.sparkSession
    sc, encoder = spark.sparkContext, word_encoder(path)
    kind = docs.schema[id_col].dataType
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).select("doc_id", out.alias("held"), F.coalesce("t", F.lit("")).alias("t"))
    folder = new_folder(spark, "lm-ids")
    schema = f"doc_id {kind.simpleString()}, held boolean, t string, n_tokens long, ids binary, word string, c long"
    rows.mapInArrow(_encoded(path, to_arrow_type(kind)), schema).write.parquet(folder)
    stored = spark.read.schema(schema).parquet(folder)
    texts, training = stored.where("t IS NOT NULL"), stored.where("NOT held")
    counts = checkpointed(stored.where("word IS NOT NULL").groupBy("word").agg(F.sum("c").alias("c")))
    ends = training.count()
    total = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n, v = total.n + ends, total.v + bool(ends)
    id_counts = np.zeros(encoder.tokenizer.get_vocab_size(), np.int64)
    for r in stored.where("t IS NULL AND word IS NULL").groupBy(F.col("n_tokens").alias("id")).agg(F.sum("c").alias("n")).collect():  # one row an id of the vocabulary at most
        id_counts[r.id] = r.n
    top = np.argsort(-id_counts, kind="stable")[: SLOTS - 2]
    slots = np.full(len(id_counts), TAIL, np.int16)
    slots[top] = np.arange(1, SLOTS - 1)
    rest = np.where(slots == TAIL, id_counts + 1.0, 0.0)
    tail = np.where(slots == TAIL, np.log(np.maximum(rest, 1e-300) / rest.sum()), 0.0)
    flat = train(training.select("ids"), slots, np.array([ends, *id_counts[top], rest.sum()]), encoder.dtype.str)
    scored = texts.select("doc_id", "t", "n_tokens", "ids").mapInArrow(
        _score(sc.broadcast((flat, slots, tail)), sc.broadcast({w: math.log10(c + 1) for w, c in frequent_words(counts).items()}), encoder.dtype.str),
        f"doc_id {kind.simpleString()}, n_tokens long, known long, base double, rare string, score double",
    )
    scored = checkpointed(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.where("rare != ''").select("row", F.explode(F.split("rare", " ")).alias("word")).join(counts, "word")
    rare = rare.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("add"))
    base = F.col("base") + F.coalesce("add", F.lit(0.0)) + F.lit(float(np.log10(ends + 1))) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    known = F.col("known") + F.coalesce("more", F.lit(0)) + (1 if ends else 0)
    return scored.drop("rare").join(rare, "row", "left").select("doc_id", out.alias("held_out"), "n_tokens", known.cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Every document with its probability under the model, and under the unigram base."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
