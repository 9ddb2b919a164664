"""Learned steps: a segmenter over characters, arbitration, binding and sentence splitting, as pipelines that can be saved and read.

Neural taggers and parsers are an interface (Annotator) with lexicon baselines behind it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def _stages(categories: list[str], numbers: list[str], last: Estimator) -> list:
    """Categories by their frequency, unseen ones as a category of their own, then one vector."""
    indexed = StringIndexer(inputCols=categories, outputCols=[f"{c}__i" for c in categories], handleInvalid="keep", stringOrderType="frequencyDesc")
    vector = VectorAssembler(inputCols=[*([f"{c}__i" for c in categories]), *numbers], outputCol="features", handleInvalid="keep")
    return [*([indexed] if categories else []), vector, last]


def estimator(kind: str = "trees", depth: int = 5, rounds: int = 20, bins: int = 512) -> Estimator:
    """trees: boosted; forest; logistic. bins: as many categories as a column may have."""
    if kind == "logistic":
        return LogisticRegression(maxIter=50, regParam=0.01)
    if kind == "forest":
        return RandomForestClassifier(numTrees=rounds, maxDepth=depth, maxBins=bins, seed=SEED)
    if kind == "trees":
        return GBTClassifier(maxIter=rounds, maxDepth=depth, maxBins=bins, seed=SEED, stepSize=0.3)
    raise ValueError(f"unknown kind of model: {kind}")


def fit(rows: DataFrame, categories: list[str], numbers: list[str], kind: str = "trees", **options) -> PipelineModel:
    """A pipeline learned from rows with a label of 0 or 1."""
    return Pipeline(stages=_stages(categories, numbers, estimator(kind, **options))).fit(rows)


def search(rows: DataFrame, categories: list[str], numbers: list[str], depths: list[int], rounds: list[int], train_share: float = 0.8) -> PipelineModel:
    """The best of boosted trees over a grid, by the area under the curve on held-out rows."""
    trees = estimator("trees")
    pipeline = Pipeline(stages=_stages(categories, numbers, trees))
    grid = ParamGridBuilder().addGrid(trees.maxDepth, depths).addGrid(trees.maxIter, rounds).build()
    return TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), trainRatio=train_share, seed=SEED).fit(rows).bestModel


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importances(model: PipelineModel) -> dict[str, float]:
    """Importance of each column, the largest first."""
    names = [c.removesuffix("__i") for c in model.stages[-2].getInputCols()]
    values = model.stages[-1].featureImportances.toArray() if hasattr(model.stages[-1], "featureImportances") else abs(model.stages[-1].coefficients.toArray())
    return dict(sorted(zip(names, map(float, values), strict=True), key=lambda x: -x[1]))


def probability(model: PipelineModel, rows: DataFrame, name: str = "p") -> DataFrame:
    """rows with the probability of label 1."""
    out = model.transform(rows).withColumn(name, vector_to_array("probability")[1])
    return out.select(*rows.columns, name)


def majority_label(rows: DataFrame, label: str = "label") -> DataFrame:
    """The baseline: label and its share; of equals the smaller."""
    n = rows.groupBy(label).agg(F.count("*").alias("n"))
    return n.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias(label), (F.max("n") / F.sum("n")).alias("share"))


def boundary_labels(characters: DataFrame, segmentations: DataFrame, col: str = "form") -> DataFrame:
    """characters (form, k, ...) with label: whether the segmentation (form, seg) has a boundary behind the character. The last character of a form is no case and goes, as do forms whose segmentation has other letters."""
    fits = segmentations.where(F.length(col) == F.length(F.replace("seg", F.lit("|"), F.lit(""))))
    bits = F.split(F.array_join(F.transform(F.split("seg", "[|]"), lambda x: F.concat(F.repeat(F.lit("0"), F.length(x) - 1), F.lit("1"))), ""), "")
    gold = fits.groupBy(col).agg(F.max("seg").alias("seg")).select(col, F.posexplode(F.filter(bits, lambda b: b != "")).alias("k", "label"))
    return characters.join(gold.withColumn("label", F.col("label").cast("double")), [col, "k"]).where(F.col("k") < F.length(col) - 1)


def segment(characters: DataFrame, p: str = "p", col: str = "form", threshold: float = 0.5, allowed: Column | None = None, fixed: DataFrame | None = None) -> DataFrame:
    """form, seg, confidence: boundaries behind characters of a probability of threshold or more.

    allowed: where boundaries may be. fixed (form, seg): forms whose segmentation is known. Forms of one letter
    stay whole. confidence is that of the least sure character.
    """
    cut = (F.col(p) >= threshold) & (F.col("k") < F.length(col) - 1) & (allowed if allowed is not None else F.lit(True))
    sure = F.when(F.col("k") < F.length(col) - 1, F.greatest(F.col(p), 1 - F.col(p))).otherwise(1.0)
    piece = F.concat(F.substring(col, F.col("k") + 1, F.lit(1)), F.when(cut, "|").otherwise(""))
    out = characters.groupBy(col).agg(F.array_sort(F.collect_list(F.struct("k", piece.alias("x")))).alias("l"), F.min(sure).alias("confidence"))
    out = out.select(col, F.array_join(F.transform("l", lambda e: e["x"]), "").alias("seg"), "confidence")
    if fixed is None:
        return out
    known = fixed.groupBy(col).agg(F.max("seg").alias("__s"))
    return out.join(known, col, "left").select(col, F.coalesce("__s", "seg").alias("seg"), F.when(F.col("__s").isNotNull(), 1.0).otherwise(F.col("confidence")).alias("confidence"))


def accept_grammar(rows: DataFrame, trust: str = "p", grammar: str = "seg", model: str = "model_seg", threshold: float = 0.1) -> DataFrame:
    """rows with chosen: the grammar's segmentation where it is trusted with threshold or more, else the model's."""
    return rows.withColumn("chosen", F.when((F.col(trust) >= threshold) & F.col(grammar).contains("|"), F.col(grammar)).otherwise(F.col(model)))


def split_sentences(features: DataFrame, model: PipelineModel, key: str = "doc_id", by: str = "i", threshold: float = 0.5) -> DataFrame:
    """features (sentence_features) with sent: a sentence begins where the model says so with threshold or more, and with the text."""
    p = probability(model, features).withColumn("__b", (F.col("p") >= threshold).cast("int"))
    w = Window.partitionBy(key).orderBy(by)
    first = F.row_number().over(w) == 1
    return p.withColumn("sent", F.sum(F.when(first, 0).otherwise(F.col("__b"))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__b")


BINDING_STRATEGIES = ("naive", "table", "stacked", "logistic", "trees")


def bind(features: DataFrame, strategy: str, model: PipelineModel | None = None) -> DataFrame:
    """features (binding_features) with p, the probability that a token is bound to the next.

    naive: never. table: what the table of tokens says. stacked: that, or the table of endings if it lacks the token. logistic, trees: a fitted model.
    """
    if strategy not in BINDING_STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy in ("logistic", "trees"):
        if model is None:
            raise ValueError(f"{strategy} needs a model")
        return probability(model, features)
    seen = F.col("morph_bound") + F.col("morph_not_bound") > 0
    p = {"naive": F.lit(0.0), "table": F.when(seen, F.col("morph_p")).otherwise(0.0), "stacked": F.when(seen, F.col("morph_p")).otherwise(F.col("ngram_p"))}[strategy]
    return features.withColumn("p", p)


@dataclass(frozen=True)
class Annotator:
    """A step that adds columns to tokens; name and kind (tagger, parser, segmenter, entities) are how options choose it."""

    name: str
    kind: str
    run: Callable[[DataFrame], DataFrame]


@dataclass
class Registry:
    """Annotators by kind and name; models that are loaded already may be handed in, so that they are not read again."""

    annotators: dict[tuple[str, str], Annotator] = field(default_factory=dict)
    preloaded: dict[str, object] = field(default_factory=dict)

    def add(self, annotator: Annotator) -> Registry:
        self.annotators[annotator.kind, annotator.name] = annotator
        return self

    def get(self, kind: str, name: str) -> Annotator:
        if (kind, name) not in self.annotators:
            have = sorted(n for k, n in self.annotators if k == kind)
            raise ValueError(f"no {kind} named {name}; there are {have}")
        return self.annotators[kind, name]

    def model(self, path: str) -> object:
        if path not in self.preloaded:
            self.preloaded[path] = load(path)
        return self.preloaded[path]


def lexicon_tagger(lexicon: DataFrame, default: str = "UNKNOWN", col: str = "word") -> Annotator:
    """A tagger that gives each word its most frequent tag in the lexicon (word, tag, freq; of equals the first by name), and default to others."""
    best = lexicon.groupBy("word", "tag").agg(F.sum("freq").alias("n")).groupBy("word").agg(F.min_by("tag", F.struct(-F.col("n"), F.col("tag"))).alias("tag"))

    def run(tokens: DataFrame) -> DataFrame:
        return tokens.join(best.withColumnRenamed("word", col), col, "left").withColumn("tag", F.coalesce("tag", F.lit(default)))

    return Annotator("lexicon", "tagger", run)


def chain_parser(root: str = "root", func: str = "dep") -> Annotator:
    """A parser that hangs each token on the one before; the first of a sentence is its root."""
    def run(tokens: DataFrame) -> DataFrame:
        return tokens.withColumn("head", F.col("id") - 1).withColumn("func", F.when(F.col("id") == 1, root).otherwise(func))

    return Annotator("chain", "parser", run)
