"""Tags as rows: events, milestones, spans and their nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TAG = r"<(/?[a-zA-Z][a-zA-Z0-9]*)[^<>]*>"


def tag_events(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row a tag: key, pos (from 0), raw, tag, kind (open, close or unary)."""
    raw = F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r"(</?[a-zA-Z][^<>]*>)"), 1)).alias("pos", "raw")
    e = df.select(key, raw)
    kind = F.when(F.startswith("raw", F.lit("</")), "close").when(F.endswith("raw", F.lit("/>")), "unary").otherwise("open")
    return e.select(key, "pos", "raw", F.lower(F.regexp_extract("raw", "^</?([a-zA-Z0-9]+)", 1)).alias("tag"), kind.alias("kind"))


def attribute(raw: str, name: str):
    """Value of an attribute in a tag; null if it has none."""
    v = F.regexp_extract(raw, f' {name}="([^"]*)"', 1)
    return F.when(F.col(raw).rlike(f' {name}="'), v)


def milestones(events: DataFrame, key: str) -> DataFrame:
    """Each milestone reaches to the next of its tag, the last to the end (null)."""
    return events.withColumn("until", F.lead("pos").over(Window.partitionBy(key, "tag").orderBy("pos")))


def paired_spans(events: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Opening and closing tags of one name, matched by depth: key, tag, st, en, depth. What has no partner is left out, or, if strict, a closing tag without one is an error."""
    w = Window.partitionBy(key, "tag").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = events.where("kind != 'unary'").withColumn("level", F.sum(F.when(F.col("kind") == "open", 1).otherwise(-1)).over(w))
    if strict:
        message = F.concat(F.lit("unmatched closing tag: "), "raw")
        e = e.withColumn("level", F.when(F.col("level") < 0, F.raise_error(message).cast("long")).otherwise(F.col("level")))
    e = e.withColumn("depth", F.when(F.col("kind") == "open", F.col("level")).otherwise(F.col("level") + 1))
    # At one depth, what closes an opening tag is the next tag.
    at_depth = Window.partitionBy(key, "tag", "depth").orderBy("pos")
    e = e.withColumn("en", F.when(F.lead("kind").over(at_depth) == "close", F.lead("pos").over(at_depth)))
    return e.where("kind = 'open' AND en IS NOT NULL").select(key, "tag", F.col("pos").alias("st"), "en", "depth")


def opening_order(spans: DataFrame, key: str) -> DataFrame:
    """rank: place of a span among those that open at its start, longest first, then by tag."""
    return spans.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("st", (F.col("st") - F.col("en")), "tag")))


def minimal_cover(points: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """points: key, tok. The shortest span that covers each; of equals the first."""
    hit = points.join(spans, (points[key] == spans[key]) & F.col("tok").between(F.col("st"), F.col("en"))).drop(spans[key])
    return hit.groupBy(key, "tok").agg(F.min_by(F.struct("st", "en"), F.struct((F.col("en") - F.col("st")), F.col("st"))).alias("s")).select(key, "tok", "s.st", "s.en")
