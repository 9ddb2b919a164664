"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND.

Every window of every training text is a query against the index of the items of its length class. Impacts
are BM25 weights divided by the item's own score, so a threshold is a share of an item. A window is
dropped once the sum of its terms' largest impacts, or of their largest impacts in each block of items,
cannot reach the threshold; the rest go through document-at-a-time WAND with block maxima, which returns
every item above the threshold. Such a pair is verified by the five-word shingles of the item's question
(all but its last sentence) and answer (the last) that the whole text holds.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import bounds, text_slices
from lectern.llm.caches import only
from lectern.plans.durable import checkpointed

K1, B, SHINGLE = 1.2, 0.75, 5
MIN_SCORE, MIN_QUESTION, MIN_ANSWER = 0.5, 0.6, 0.5
#: Items are indexed in passes over the texts, each of at most so many characters of items: what a pass broadcasts.
PASS_CHARS = 8_000_000
LEAST_WINDOW, BLOCKS = 16, 32
#: Texts searched at a time, and word positions whose block maxima are in memory at a time.
SEARCH_BYTES, SEARCH_POSITIONS = 1 << 19, 1 << 15
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _words(texts: pa.Array) -> pa.Array:
    return pa.array([words_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The item's words before its last sentence, and those of it; of one sentence, the last quarter is the answer."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if _WORD.search(p)]
    if len(parts) > 1:
        return words_of(" ".join(parts[:-1])), words_of(parts[-1])
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return (words[:cut], words[cut:]) if cut else (words, words)


def shingles(words: list[str]) -> set[tuple]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class BlockMaxIndex:
    """Items of one length class: postings by term in item order, and largest impacts by list and by block of items."""

    def __init__(self, items: list[tuple[int, Counter, int]], idf: dict[str, float], mean_length: float, window: int):
        self.window, self.ids = window, [i for i, _, _ in items]
        self.block = max(1, -(-len(items) // BLOCKS))
        self.terms: dict[str, int] = {}
        self.lists: list[list[tuple[int, float]]] = []
        for place, (_, tf, length) in enumerate(items):
            weight = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean_length)) for t, n in tf.items()}
            own = sum(weight.values())
            for t, w in weight.items():
                term = self.terms.setdefault(t, len(self.terms))
                if term == len(self.lists):
                    self.lists.append([])
                self.lists[term].append((place, w / own))
        self.places = [[p for p, _ in x] for x in self.lists]
        self.block_max = np.zeros((len(self.lists) + 1, -(-len(items) // self.block)))  # the last row: words that no item has
        for term, x in enumerate(self.lists):
            for p, w in x:
                self.block_max[term, p // self.block] = max(self.block_max[term, p // self.block], w)
        self.list_max = self.block_max.max(axis=1)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items (by place) whose score for the distinct terms is least at least: WAND with block maxima."""
        at, found, least = dict.fromkeys(terms, 0), [], least - 1e-9
        while True:
            live = sorted((self.places[t][i], t) for t, i in at.items() if i < len(self.places[t]))
            bound, pivot = 0.0, -1
            for place, t in live:
                bound += self.list_max[t]
                if bound >= least:
                    pivot = place
                    break
            if pivot < 0:
                return found
            block = pivot // self.block
            upto = [t for place, t in live if place <= pivot]
            if sum(self.block_max[t, block] for t in upto) < least:
                # No item before the block's end, or before the next list's item, can reach it.
                to = min([(block + 1) * self.block, *(place for place, t in live if place > pivot)])
            elif live[0][0] == pivot:
                score = sum(self.lists[t][at[t]][1] for t in upto)
                if score >= least:
                    found.append((pivot, score))
                to = pivot + 1
            else:
                to = pivot
            for t in upto:
                at[t] = bisect_left(self.places[t], to, at[t])

    def windows(self, words: list[int], starts: list[int]) -> Iterator[tuple[int, list[int]]]:
        """Document and terms of each window that the bounds don't rule out. words: all documents' terms; starts: where each begins, and the end."""
        ids = np.array(words, np.int64)
        at = np.flatnonzero(ids < len(self.lists))
        ids, half = ids[at], max(1, self.window // 2)
        docs, begins = [], []
        for d, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            s = np.arange(a, max(a + 1, b - half), half)
            begins.append(s)
            docs.append(np.full(len(s), d))
        if not docs or not len(ids):
            return
        begin, doc = np.concatenate(begins), np.concatenate(docs)
        end = np.minimum(begin + self.window, np.array(starts)[doc + 1])
        lo, hi = np.searchsorted(at, begin), np.searchsorted(at, end)
        upto = np.concatenate([[0.0], np.cumsum(self.list_max[ids])])
        keep = np.flatnonzero(upto[hi] - upto[lo] >= MIN_SCORE - 1e-6)
        # The bound by blocks, for so many windows at a time that their positions stay within SEARCH_POSITIONS.
        width = np.cumsum(hi[keep] - lo[keep])
        at = 0
        while at < len(keep):
            to = max(at + 1, int(np.searchsorted(width, (width[at - 1] if at else 0) + SEARCH_POSITIONS, "right")))
            own, at = keep[at:to], to
            for w in own[self._block_bounds(ids, lo[own], hi[own]) >= MIN_SCORE - 1e-6].tolist():
                yield int(doc[w]), list(set(ids[lo[w] : hi[w]].tolist()))

    def _block_bounds(self, ids: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Per window of positions lo to hi (none of them empty): the largest sum of its terms' impacts in a block."""
        n = hi - lo
        first = np.cumsum(n) - n
        positions = np.arange(int(n.sum())) + np.repeat(lo - first, n)
        return np.add.reduceat(self.block_max[ids[positions]], first, axis=0).max(axis=1)


def build_index(items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_length: float) -> tuple[list[BlockMaxIndex], dict[int, tuple[set, set]]]:
    """Indexes by length class (windows of 16, 32, 64, ... words), and the question and answer shingles by item."""
    classes: dict[int, list] = {}
    parts = {}
    idf = {t: math.log(1 + (n_items - n + 0.5) / (n + 0.5)) for t, n in frequency.items()}
    for i, text in items:
        words = words_of(text)
        if words:
            q, a = question_and_answer(text)
            parts[i] = (shingles(q), shingles(q[-(SHINGLE - 1) :] + a if q is not a else a))
            classes.setdefault(max(LEAST_WINDOW, 1 << (len(words) - 1).bit_length()), []).append((i, Counter(words), len(words)))
    return [BlockMaxIndex(x, idf, mean_length, w) for w, x in sorted(classes.items())], parts


def _matches(index: tuple, texts: list[str | None], min_question: float, min_answer: float) -> list[tuple[int, int, float, float, float]]:
    """(place of the text, item, score, question overlap, answer overlap) of every verified pair, in order."""
    classes, parts = index
    words = [words_of(t) for t in texts]
    starts = np.cumsum([0, *map(len, words)]).tolist()
    best: dict[tuple[int, int], float] = {}
    for c in classes:
        get, none = c.terms.get, len(c.lists)
        for doc, terms in c.windows([get(w, none) for own in words for w in own], starts):
            for place, score in c.search(terms, MIN_SCORE):
                key = doc, c.ids[place]
                best[key] = max(best.get(key, 0.0), score)
    items_of: dict[int, list[int]] = {}
    for doc, item in sorted(best):
        items_of.setdefault(doc, []).append(item)
    out = []
    for doc, items in items_of.items():
        wanted = set().union(*(s for item in items for s in parts[item]))
        own = words[doc]
        held = {s for n in {len(x) for x in wanted} for i in range(len(own) - n + 1) if (s := tuple(own[i : i + n])) in wanted}
        for item in items:
            q, a = (len(s & held) / len(s) for s in parts[item])
            if q >= min_question and a >= min_answer:
                out.append((doc, item, best[doc, item], q, a))
    return out


def _searcher(index, min_question: float, min_answer: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in text_slices(batches, 1, SEARCH_BYTES):
            columns = list(zip(*_matches(index.value, batch.column(1).to_pylist(), min_question, min_answer), strict=True)) or [()] * 5
            out = [batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(x, k) for x, k in zip(columns[1:], (pa.int64(), *[pa.float64()] * 3), strict=True))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "item_id", "bm25_share", "question_overlap", "answer_overlap"])

    return run


def _indexes(items: DataFrame, item_col: str, item_text_col: str) -> Iterator[tuple]:
    """An index, broadcast, for each pass over the texts: one, unless the items have more than PASS_CHARS characters."""
    spark = items.sparkSession
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    tokens = F.arrow_udf(_words, "array<string>")
    items = checkpointed(items.withColumn("words", tokens("text")))
    stats = items.where("size(words) > 0").agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean"), F.sum(F.length("text")).alias("chars")).first()
    passes = -(-2 * stats.chars // PASS_CHARS) if (stats.chars or 0) > PASS_CHARS else 1
    frequency = items.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    for k in range(passes):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        terms = own.select(F.explode(F.array_distinct("words")).alias("term")).distinct()
        index = build_index([tuple(r) for r in own.select("item_id", "text").collect()], {r.term: r.n for r in frequency.join(terms, "term").collect()}, stats.n, stats["mean"] or 1.0)
        yield spark.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_question: float = MIN_QUESTION, min_answer: float = MIN_ANSWER) -> DataFrame:
    """Pairs of a row of docs and an item that it holds: doc_id, item_id, bm25_share, question_overlap, answer_overlap.

    bm25_share is the best window's score as a share of the item's own. Null and empty texts match
    nothing; items without words or with a null id are ignored, and items that repeat a text are found each.
    Rows that repeat a document give their pairs again, and a null id is reported as null. Items shorter than
    five words are one shingle. Very long texts are searched whole, a bounded number of windows at a time.
    Other columns of docs and items, whatever their names, are ignored; an empty table on either side gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id long, bm25_share double, question_overlap double, answer_overlap double"
    found = [rows.mapInArrow(_searcher(index, min_question, min_answer), schema) for index in _indexes(items, item_col, item_text_col)]
    return reduce(DataFrame.unionAll, found)


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_question: float = MIN_QUESTION, min_answer: float = MIN_ANSWER) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item; each row is judged by its own text, whatever its id."""

    def clean_under(index):
        def clean(texts: pa.Array) -> pa.Array:
            only()
            out = np.ones(len(texts), bool)
            for start, end in bounds(texts, SEARCH_BYTES):
                for doc, *_ in _matches(index.value, texts.slice(start, end - start).to_pylist(), min_question, min_answer):
                    out[start + doc] = False
            return pa.array(out)

        return F.arrow_udf(clean, "boolean")

    for index in _indexes(items, item_col, item_text_col):
        docs = docs.where(clean_under(index)(F.col(text_col).cast("string")))
    return docs


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
