"""Units in order: keys, neighbours, distances, sentences, islands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import word_array


def units(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a word: key, i (from 0), tok."""
    return df.select(key, F.posexplode(word_array(F.col(text))).alias("i", "tok"))


def shares(df: DataFrame, text: str = "text", each: int = 1 << 18) -> int:
    """How many partitions have some each bytes of text, so that what one task sorts does not grow with the input: rows made of a text take a hundred times its room and more."""
    return max(1, -(-(df.agg(F.sum(F.octet_length(text))).first()[0] or 0) // each))


def words(df: DataFrame, key: str = "doc_id", text: str = "text", cut: Callable[[Column], Column] = word_array, parts: int | None = None) -> DataFrame:
    """One row a text: key, words (as cut has them) and places, what units gives as rows: places is null where they are 0, 1, ...

    Texts, not words, are brought together by key, so that windows and groups by key over what is made of them need no exchange; those
    that share a key are taken place by place, as windows over units take them. parts: see shares; for what is sorted afterwards.
    """
    df = df.select(key, text).repartition(parts, key) if parts else df
    g = df.groupBy(key).agg(F.collect_list(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    placed = lambda t: F.transform(cut(t), lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    several = F.when(F.size("__t") > 1, F.array_sort(F.flatten(F.transform("__t", placed))))
    g = g.select(key, F.get("__t", F.lit(0)).alias("__t"), several.alias("__s"))
    own = F.when(F.col("__s").isNull(), cut(F.col("__t"))).otherwise(F.transform("__s", lambda x: x["w"]))
    return g.select(key, own.alias("words"), F.transform("__s", lambda x: x["i"]).alias("places"))


def order(key: str = "doc_id", by: str = "i") -> Window:
    return Window.partitionBy(key).orderBy(by)


def with_neighbours(u: DataFrame, col: str, key: str = "doc_id", by: str = "i", edge: str = "_") -> DataFrame:
    """prev and next of col; edge at either end and for empty neighbours."""
    w = order(key, by)
    fill = lambda c: F.when(F.coalesce(c, F.lit("")) == "", edge).otherwise(c)
    return u.withColumn("prev", fill(F.lag(col).over(w))).withColumn("next", fill(F.lead(col).over(w)))


def circular(u: DataFrame, col: str, offsets: list[int], key: str, by: str, block: int = 4096) -> DataFrame:
    """col at each offset from the row, going round at the ends of its sequence; by counts from 0 without gaps.

    Sequences are dealt out in blocks of places, each with the few rows around it (those of the other end
    at an end), so that a window serves all offsets and a very long sequence is no single task.
    """
    left, right = max(0, -min(offsets)), max(0, max(offsets))
    n = u.groupBy(key).agg((F.max(by) + 1).alias("__n"))
    turn = F.sequence(-F.ceil(F.lit(right) / F.col("__n")).cast("int"), F.ceil(F.lit(left) / F.col("__n")).cast("int"))
    # A row's places: its own, and those at which it is seen from behind the ends. Turns go the other way: what is right of the end begins at the begin.
    places = F.transform(turn, lambda m: (F.col(by) - m * F.col("__n")).cast("long"))
    near = F.filter(places, lambda p: (p >= -left) & (p < F.col("__n") + right))
    spread = u.join(n, key).withColumn("__place", F.explode(near))
    first = F.greatest(F.lit(0), F.floor((F.col("__place") - right) / block))
    last = F.least(F.floor((F.col("__n") - 1) / block), F.floor((F.col("__place") + left) / block))
    spread = spread.withColumn("__block", F.explode(F.sequence(first.cast("long"), F.greatest(first, last).cast("long"))))
    w = Window.partitionBy(key, "__block").orderBy("__place")
    out = spread.select("*", *[F.lead(col, k).over(w).alias(f"{col}{k:+d}") if k > 0 else F.lag(col, -k).over(w).alias(f"{col}{k:+d}") for k in offsets])
    own = (F.col("__place") == F.col(by)) & (F.floor(F.col("__place") / block) == F.col("__block"))
    return out.where(own).select(*u.columns, *[f"{col}{k:+d}" for k in offsets])


def distances(u: DataFrame, flag: Column, key: str = "doc_id", by: str = "i", missing: int = -1, ahead_missing: int = 5) -> DataFrame:
    """Places since the last flagged row before this one, and until the next after it; both are running values, the second from the end."""
    at = F.when(flag, F.col(by))
    running = lambda w: F.last(at, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    back, ahead = F.col(by) - running(order(key, by)), running(Window.partitionBy(key).orderBy(F.desc(by))) - F.col(by)
    return u.withColumn("since", F.coalesce(back, F.lit(missing))).withColumn("until", F.coalesce(ahead, F.lit(ahead_missing)))


def any_ahead(flag: Column, reach: int, key: str = "doc_id", by: str = "i") -> Column:
    """Whether this row or one of the next reach has the flag."""
    return F.max(flag.cast("int")).over(order(key, by).rowsBetween(0, reach)) == 1


def place_in_group(key: list[str], by: str) -> Column:
    """S alone, B first, E last, I between."""
    w = Window.partitionBy(*key)
    return place_of(F.row_number().over(w.orderBy(by)), F.count("*").over(w))


def place_of(i: Column, n: Column) -> Column:
    """S alone, B first, E last, I between, of the i-th (from 1) of n."""
    return F.when(n == 1, "S").when(i == 1, "B").when(i == n, "E").otherwise("I")


def group_ids(starts: Column, key: str = "doc_id", by: str = "i") -> Column:
    """Running number of the group that a row is in; starts: whether a row opens one."""
    return F.sum(starts.cast("long")).over(order(key, by).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def after(flag: Column, key: str = "doc_id", by: str = "i") -> Column:
    """Whether the row before has the flag."""
    return F.coalesce(F.lag(flag).over(order(key, by)), F.lit(False))


def central_shingle(by: Column, n: Column, span: int, stride: int) -> Column:
    """Of shingles that begin at multiples of stride and go round at n, the begin of the one in which the place is most central.

    Only the starts that can cover the place are looked at: the nearest before it, and the last ones, which go round.
    """
    reach = range(-(-span // stride))
    own, final = F.floor(by / stride) * stride, F.floor((n - 1) / stride) * stride
    starts = F.array_distinct(F.array(*[(s - k * stride).cast("int") for s in (own, final) for k in reach]))
    options = F.transform(starts, lambda s: F.struct(F.abs(F.pmod(by - s, n) * 2 - (span - 1)).alias("d"), s.alias("s"), F.pmod(by - s, n).alias("o")))
    return F.array_min(F.filter(options, lambda x: (x["s"] >= 0) & (x["o"] < span)))["s"]


def char_context(text: Column, at: Column) -> list[Column]:
    """Letters two and one before and after the 1-based place at; '' outside."""
    return [F.when(at + k >= 1, F.substring(text, at + k, F.lit(1))).otherwise("").alias(f"c{k:+d}".replace("-", "m").replace("+", "p")) for k in (-2, -1, 1, 2)]
