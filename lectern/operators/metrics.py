"""Evaluation: precision, accuracy, attachment, confusion, voting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def precision_recall(df: DataFrame, gold: str, pred: str) -> DataFrame:
    g, p = F.col(gold) == 1, F.col(pred) == 1
    n = df.agg(*[F.sum(c.cast("long")).alias(k) for k, c in (("tp", g & p), ("fp", ~g & p), ("fn", g & ~p))], F.avg((F.col(gold) == F.col(pred)).cast("int")).alias("accuracy"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    n = n.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return n.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def confusion(df: DataFrame, gold: str, pred: str) -> DataFrame:
    return df.groupBy(gold, pred).agg(F.count("*").alias("n"))


def attachment(df: DataFrame, head: str, gold_head: str, label: str, gold_label: str, punctuation: Column) -> DataFrame:
    """Labelled and unlabelled attachment, and labels; punctuation counts as rightly attached."""
    u = punctuation | (F.col(head) == F.col(gold_head))
    lab = F.col(label) == F.col(gold_label)
    return df.agg(F.avg((u & lab).cast("int")).alias("las"), F.avg(u.cast("int")).alias("uas"), F.avg(lab.cast("int")).alias("label_acc"))


def vote(a: Column, b: Column, c: Column) -> Column:
    """a, unless b and c agree against it."""
    return F.when((b != a) & (b == c), b).otherwise(a)


def most_common(df: DataFrame, col: str, top: int = 100) -> DataFrame:
    """The top values by count, with their counts and ranks; of equals the first by name."""
    n = df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(top)
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), col)))


def boundary_counts(df: DataFrame, gold: str, pred: str, separator: str = "|") -> DataFrame:
    """tp, fp, fn, tn over the places behind each letter but the last of a group, and n, perfect: groups, and those that are right in full. gold and pred: segmentations of one form."""
    def bits(seg: str) -> Column:
        parts = F.split(seg, "[" + separator + "]")
        return F.array_join(F.transform(parts, lambda x, i: F.concat(F.repeat(F.lit("0"), F.length(x) - 1), F.when(i == F.size(parts) - 1, "").otherwise("1"))), "")

    both = df.select(bits(gold).alias("g"), bits(pred).alias("p"), (F.col(gold) == F.col(pred)).alias("same"))
    both = both.withColumn("x", F.transform(F.split("g", ""), lambda a, i: F.concat(a, F.substring("p", i + 1, F.lit(1)))))
    count = lambda k: F.coalesce(F.sum(F.size(F.filter("x", lambda v: v == k)).cast("long")), F.lit(0)).alias({"11": "tp", "01": "fp", "10": "fn", "00": "tn"}[k])
    return both.agg(*map(count, ("11", "01", "10", "00")), F.count("*").alias("n"), F.sum(F.col("same").cast("long")).alias("perfect"))


def tag_accuracy(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """accuracy, and that of giving every token the most frequent gold tag (of equals the first by name)."""
    n = df.groupBy(gold).agg(F.count("*").alias("n"), F.sum((F.col(gold) == F.col(pred)).cast("long")).alias("right"))
    top = n.agg(F.min_by(F.struct(F.col(gold).alias("tag"), "n"), F.struct(-F.col("n"), F.col(gold))).alias("top"), F.sum("right").alias("right"), F.sum("n").alias("total"))
    return top.select((F.col("right") / F.col("total")).alias("accuracy"), F.col("top.tag").alias("baseline_tag"), (F.col("top.n") / F.col("total")).alias("baseline"))


def normalization_accuracy(df: DataFrame, orig: str, gold: str, pred: str, lacuna: str = r"[\[\]…]") -> DataFrame:
    """accuracy over all, over those without lacunae, the share of trivial cases (norm as the original), and accuracy on the others."""
    right, clean, trivial = F.col(gold) == F.col(pred), ~F.col(orig).rlike(lacuna), F.col(orig) == F.col(gold)
    ratio = lambda cond, among: F.avg(F.when(among, cond.cast("int")))
    every = F.lit(True)
    return df.agg(ratio(right, every).alias("accuracy"), ratio(right, clean).alias("no_lacunae"), ratio(trivial, every).alias("trivial"), ratio(right, ~trivial).alias("non_trivial"))


def confidence(df: DataFrame, keys: list[str], p: str) -> DataFrame:
    """The least probability of each group's characters."""
    return df.groupBy(*keys).agg(F.min(p).alias("confidence"))


def error_table(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """gold, pred, n, rank of what went wrong, the most frequent first."""
    n = confusion(df.where(F.col(gold) != F.col(pred)), gold, pred)
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), gold, pred)))


def error_context(df: DataFrame, gold: str, pred: str, key: str, by: str, around: int = 1) -> DataFrame:
    """Rows up to around places from a row in which gold and pred differ, with wrong: whether it is such a row."""
    w = Window.partitionBy(key).orderBy(by)
    wrong = (F.col(gold) != F.col(pred)).cast("int")
    return df.withColumn("wrong", wrong).withColumn("__near", F.max("wrong").over(w.rowsBetween(-around, around))).where("__near = 1").drop("__near")


def first_values(rows: DataFrame, keys: list[str], value: str, line: str) -> tuple[DataFrame, DataFrame]:
    """The first row's value of each key, and the rows that are discarded: those with another value."""
    first = rows.groupBy(*keys).agg(F.min_by(value, line).alias("__first"))
    kept = first.withColumnRenamed("__first", value)
    gone = rows.join(first, keys).where(F.col(value) != F.col("__first")).drop("__first")
    return kept, gone
