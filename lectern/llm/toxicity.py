"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat verb, target, negation, reporting verb, modal, intensifier or other.
Sequential transducers with weights on their arcs, for insults, threats, negation, reported speech and
targets, are composed into one; run over a clause, it rewrites each insult and threat by what stands around
it (negated, reported, aimed at someone, plain) and adds the weights of the arcs taken to the word's own.
Insult words and their weights are learned from labels beside a few given ones; so is the weight of each
kind of match, starting from given ones. Documents are scored by their matched clauses.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import text_slices
from lectern.llm.caches import only
from lectern.llm.ngram_join import shingle_sets

# Seed words of the grammar in four languages.
INSULTS = "idiot moron stupid imbecile loser scum trash pathetic worthless disgusting dumb jerk bastard idiote imbécile crétin dumm trottel dummkopf idiota imbécil estúpido".split()
THREATS = "kill hurt beat destroy murder punish tuer frapper töten schlagen matar golpear".split()
TARGETS = "you your he she they them him her this these du dich ihr euch sie tu vous toi ils tú usted ustedes ellos".split()
NEGATIONS = "not no never none cannot nicht kein keine nie pas jamais ne nunca ni".split()
REPORTS = "said says say called calls wrote claims claimed quoted reported sagte sagt nannte dit disait dijo dice llamó".split()
MODALS = "will shall should must gonna werde wirst soll vais va voy debe".split()

INTENSIFIERS = "so such very really utterly total complete absolute so sehr völlig total si tellement vraiment tan muy".split()

SEED_WEIGHT = 3.0
#: At most about so many labelled rows are learned from, chosen by a hash of their id.
TRAIN_ROWS = 20_000
OTHER = "x"
SYMBOLS = "xihtnrms"
# Weights on the arcs that rewrite an insult or a threat, in the unit of word weights.
ARC_WEIGHTS = {"intensified": 0.5, "aimed": 1.0, "threat": 1.0, "negated": -1.0, "reported": -0.5}
KINDS = "iujqv"  # plain insult, insult at a target, negated, reported, threat
FEATURES = [*KINDS, "clauses", "strongest"]
PREDICT_FROM = 0.3
_TOKEN = re.compile(r"\w+|[.!?;:,\n]")


class Transducer:
    """A weighted sequential transducer: a state and a symbol give the next state, the symbol put out, and the arc's weight."""

    def __init__(self, start, step, alphabet: str):
        self.start, self.alphabet, self.arcs = start, alphabet, {}
        todo = [start]
        while todo:
            s = todo.pop()
            for a in alphabet:
                if (s, a) not in self.arcs:
                    self.arcs[s, a] = step(s, a)
                    todo.append(self.arcs[s, a][0])

    def then(self, other: Transducer) -> Transducer:
        """Composition: other reads what this one puts out; weights add up."""

        def step(state, a):
            s, out, w = self.arcs[state[0], a]
            t, out, v = other.arcs[state[1], out]
            return (s, t), out, w + v

        return Transducer((self.start, other.start), step, self.alphabet)

    def run(self, symbols) -> tuple[list[str], list[float]]:
        state, out, weights = self.start, [], []
        for a in symbols:
            state, b, w = self.arcs[state, a]
            out.append(b)
            weights.append(w)
        return out, weights


def within(trigger: str, reach: int, rewrite: dict[str, str], alphabet: str, weight: float = 0.0, otherwise: dict[str, str] | None = None) -> Transducer:
    """Rewrites symbols up to reach places after a trigger (0: to the end of the clause), on arcs with a weight, and others as in otherwise."""

    def step(left: int, a: str):
        hit = left and a in rewrite
        b = (rewrite if left else otherwise or {}).get(a, a)
        return (reach or 1) if a == trigger else left if left and not reach else max(0, left - 1), b, weight if hit else 0.0

    return Transducer(0, step, alphabet)


#: The transducers in order. Threat verbs need a modal before them; negation outranks reported speech, which outranks targets.
PARTS = ("insult", "threat", "negation", "reported", "target")


def clause_grammar(parts: tuple[str, ...] = PARTS, weights: dict[str, float] = ARC_WEIGHTS) -> Transducer:
    """The composed machine; parts: without some of them, to see what they do."""
    every = "".join(dict.fromkeys(SYMBOLS + KINDS))
    machines = {
        "insult": within("s", 2, {"i": "i"}, every, weights["intensified"]),
        "threat": within("m", 4, {"h": "v"}, every, weights["threat"], {"h": OTHER}),
        "negation": within("n", 3, {"i": "j", "v": "j"}, every, weights["negated"]),
        "reported": within("r", 0, {"i": "q", "v": "q"}, every, weights["reported"]),
        "target": within("t", 4, {"i": "u"}, every, weights["aimed"]),
    }
    return reduce(Transducer.then, [machines[p] for p in PARTS if p in parts])


class Scorer:
    """Features of texts under a lexicon of insult words with weights."""

    def __init__(self, lexicon: dict[str, float], parts: tuple[str, ...] = PARTS):
        self.grammar, self.lexicon = clause_grammar(parts), lexicon
        lists = ((INTENSIFIERS, "s"), (MODALS, "m"), (REPORTS, "r"), (NEGATIONS, "n"), (TARGETS, "t"), (THREATS, "h"), (lexicon, "i"))
        self.symbol = {w: s for words, s in lists for w in words} | dict.fromkeys(".!?;:,\n", "|")

    def features(self, text: str | None) -> np.ndarray:
        tokens = _TOKEN.findall((text or "").lower())
        get = self.symbol.get
        symbols = "".join([get(w, OTHER) for w in tokens])
        sums, clauses, strongest, at = dict.fromkeys(KINDS, 0.0), 0, 0.0, 0
        if "i" in symbols or "h" in symbols:
            for clause in symbols.split("|"):
                if "i" in clause or "h" in clause:
                    own = [(kind, max(0.0, self.lexicon.get(tokens[at + i], SEED_WEIGHT) + w)) for i, (kind, w) in enumerate(zip(*self.grammar.run(clause), strict=True)) if kind in KINDS]
                    for kind, w in own:
                        sums[kind] += w
                    clauses += any(kind not in "jq" for kind, _ in own)
                    strongest = max([strongest, *(w for kind, w in own if kind not in "jq")])
                at += len(clause) + 1
        return np.array([*(np.log1p(sums[k]) for k in KINDS), np.log1p(clauses), strongest])


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: label, the least hash of its five-word shingles (texts of similarity s share it with probability s), text."""
    only("shingles")
    for batch in text_slices(batches, 1):
        least = [int(s[0]) - (1 << 63) if len(s) else 0 for s in shingle_sets(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.int64()), batch.column(1)], ["toxic", "family", "text"])


def _words_by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update(set(_TOKEN.findall((text or "").lower())))
        words = list(counts[1])  # a word that no toxic row of the batch has counts below, with the rest
        rest = [w for w in counts[0] if w not in counts[1]]
        yield pa.RecordBatch.from_arrays([pa.array(words + rest), pa.array([counts[1][w] for w in words + rest], pa.int64()), pa.array([counts[0][w] for w in words + rest], pa.int64())], ["word", "pos", "neg"])


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Words that toxic rows hold beyond chance (G of 18 or more), with log odds; train: text, toxic (0 or 1).

    All such words are taken. They stand in three toxic rows at least, of a training sample of bounded size.
    """
    totals = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    p, n = totals.get(1, 0), totals.get(0, 0)
    seeds = dict.fromkeys(INSULTS, SEED_WEIGHT)
    if not p or not n:
        return seeds
    rate = p / (p + n)
    words = train.select("text", "toxic").mapInArrow(_words_by_label, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    share = F.col("pos") / (F.col("pos") + F.col("neg"))
    g = 2 * (F.col("pos") * F.log(share / rate) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    odds = F.log((F.col("pos") + 0.5) / (p + 1)) - F.log((F.col("neg") + 0.5) / (n + 1))
    found = words.where("pos >= 3").withColumn("g", g).withColumn("odds", odds).where("g >= 18 AND odds >= 1")
    return seeds | {r.word: r.odds for r in found.select("word", "odds").collect() if r.word not in "|.!?;:,\n"}


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression, the constant first, by Newton steps. Features that rows say nothing of keep the weight they have in prior."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = prior.astype(float), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ (w - prior))
        step *= min(1.0, 4.0 / np.abs(step).max())
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _scores(scorer: Scorer, weights: np.ndarray, texts: list[str | None]) -> np.ndarray:
    x = np.array([scorer.features(t) for t in texts]).reshape(-1, len(FEATURES))
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))


def _score_with(scorer, weights: np.ndarray | None, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([scorer.value.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            if weights is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], [name, "x"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30))))], [name, "score"])

    return run


# Weights where labels say nothing: the constant, then FEATURES.
DEFAULT_WEIGHTS = np.array([-3.0, 1.0, 1.5, -0.5, -0.5, 1.5, 0.3, 0.3])


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and weights, from the labelled rows whose crc32(id as text) mod 4 is not 2.

    The classifier is fitted on a hash sample of about train_rows of them at most; rows without id or label don't count.
    """
    own = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("toxic")).where("__id IS NOT NULL AND toxic IN (0, 1)")
    own = own.where(F.crc32(F.col("__id").cast("string").cast("binary")) % 4 != 2)
    n = own.count()
    if n > train_rows:
        own = own.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 24)) < int(train_rows / n * (1 << 24)))
    # The sample is bounded, so it may be broadcast; an id with several labels takes the highest.
    own = F.broadcast(own.groupBy("__id").agg(F.max("toxic").alias("toxic")))
    train = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(own, "__id")
    # Near copies are evidence once: of rows with one label that share their least shingle, one text counts.
    kinds = train.select("toxic", "text").mapInArrow(_families, "toxic int, family long, text string")
    lexicon = learn_lexicon(kinds.groupBy("toxic", "family").agg(F.min("text").alias("text")))
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(lexicon))
    rows = train.select("toxic", "text").mapInArrow(_score_with(scorer, None, "toxic"), "toxic int, x array<double>").collect()
    y = np.array([r.toxic for r in rows], float)
    if not len(y) or y.min() == y.max():
        return lexicon, DEFAULT_WEIGHTS
    return lexicon, fit_logistic(np.array([r.x for r in rows]), y, DEFAULT_WEIGHTS)


def score_toxicity(docs: DataFrame, lexicon: dict[str, float], weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted.

    Null texts are scored as empty; null ids are not held out. Very long texts are scored whole; rows that
    repeat a document score alike. Other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(lexicon))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(_score_with(scorer, weights, "doc_id"), f"doc_id {kind}, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, lexicon: dict[str, float], weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that score below PREDICT_FROM; rows are judged one by one, and only texts go to Python."""
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(lexicon))

    def score(texts: pa.Array) -> pa.Array:
        only()
        return pa.array(_scores(scorer.value, weights, texts.to_pylist()))

    return docs.where(F.arrow_udf(score, "double")(F.col(text_col).cast("string")) < PREDICT_FROM)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity, as learned from the labels of three quarters of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(docs, *train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
