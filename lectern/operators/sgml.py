"""Annotated text as rows: events of tags and tokens, edited as tables and written back as lines.

Events are what sources.formats.parse_sgml gives: key, line_no, kind (open, close, unary, token), tag, attrs, text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _running(key: str) -> Window:
    return Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _opens(element: str) -> Column:
    return (F.col("kind") == "open") & (F.col("tag") == element)


def numbered(events: DataFrame, element: str, key: str = "doc_id", name: str = "unit") -> DataFrame:
    """Adds the running number of the last opened element: 1 from the first on, 0 before it."""
    return events.withColumn(name, F.sum(_opens(element).cast("int")).over(_running(key)))


def last_attribute(element: str, name: str, key: str = "doc_id") -> Column:
    """The attribute of the last opened element that has it."""
    return F.last(F.when(_opens(element), F.col("attrs")[name]), True).over(_running(key))


def event_text(events: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text: the lines of each document."""
    attrs = F.array_join(F.transform(F.map_entries("attrs"), lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), e["value"], F.lit('"'))), "")
    head = F.concat(F.lit("<"), F.col("tag"), F.coalesce(attrs, F.lit("")))
    line = F.when(F.col("kind") == "token", F.col("text")).when(F.col("kind") == "close", F.concat(F.lit("</"), F.col("tag"), F.lit(">"))).when(F.col("kind") == "unary", F.concat(head, F.lit("/>"))).otherwise(F.concat(head, F.lit(">")))
    listed = F.array_sort(F.collect_list(F.struct("line_no", line.alias("line"))))
    return events.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("text"))


def _with_attribute(attrs: Column, name: str, value: Column, before: str | None = None) -> Column:
    """attrs with name set to value, in front of the attribute named before, or at the end."""
    rest = F.filter(F.map_entries(attrs), lambda e: e["key"] != name)
    new = F.array(F.struct(F.lit(name).alias("key"), value.alias("value")))
    if before is None:
        return F.map_from_entries(F.concat(rest, new))
    return F.map_from_entries(F.flatten(F.transform(rest, lambda e: F.when(e["key"] == before, F.concat(new, F.array(e))).otherwise(F.array(e)))))


def inject_attribute(events: DataFrame, values: DataFrame | Column, name: str, anchor: str, key: str = "doc_id", replace: bool = True) -> DataFrame:
    """The n-th tag (from 1) that has the attribute anchor gets name=value in front of it. values: key, n, value, or a column made of n and the tag's own; empty and null values change nothing."""
    has = (F.col("kind") == "open") & F.col("attrs")[anchor].isNotNull()
    e = events.withColumn("n", F.when(has, F.sum(has.cast("int")).over(_running(key))))
    if isinstance(values, Column):
        e = e.withColumn("__value", F.when(has, values))
    else:
        e = e.join(values.select(key, "n", F.col("value").alias("__value")), [key, "n"], "left")
    set_ = (F.coalesce("__value", F.lit("")) != "") & (F.lit(replace) | F.col("attrs")[name].isNull())
    return e.withColumn("attrs", F.when(set_, _with_attribute(F.col("attrs"), name, F.col("__value"), anchor)).otherwise(F.col("attrs"))).drop("n", "__value")


def drop_attribute_if(events: DataFrame, name: str, value: str) -> DataFrame:
    """Tags lose the attribute where it has the value."""
    return events.withColumn("attrs", F.map_filter("attrs", lambda k, v: ~((k == name) & (v == value))))


def drop_elements(events: DataFrame, *elements: str) -> DataFrame:
    """Tags of the elements go; what they hold stays."""
    return events.where(F.col("tag").isNull() | ~F.col("tag").isin(*elements))


def collapse_element(events: DataFrame, kill: str, into: str, key: str = "doc_id") -> DataFrame:
    """<kill kill="v"> inside <into> becomes its attribute kill; the last one in it counts."""
    e = numbered(events, into, key)
    own = F.when(_opens(kill) & (F.col("unit") > 0), F.struct("line_no", F.col("attrs")[kill].alias("v")))
    e = drop_elements(e.withColumn("__value", F.max(own).over(Window.partitionBy(key, "unit"))["v"]), kill)
    hit = _opens(into) & F.col("__value").isNotNull()
    return e.withColumn("attrs", F.when(hit, _with_attribute(F.col("attrs"), kill, F.col("__value"))).otherwise(F.col("attrs"))).drop("unit", "__value")


def drop_if_nested_has(events: DataFrame, nester: str, nested: str, name: str, key: str = "doc_id") -> DataFrame:
    """An element loses the attribute if one nested in it carries it."""
    e = numbered(events, nester, key)
    e = e.withColumn("__hit", F.max(_opens(nested) & F.col("attrs")[name].isNotNull()).over(Window.partitionBy(key, "unit")))
    return e.withColumn("attrs", F.when(_opens(nester) & F.col("__hit"), F.map_filter("attrs", lambda k, _: k != name)).otherwise(F.col("attrs"))).drop("unit", "__hit")


def roll_up(events: DataFrame, group: str, element: str, name: str, key: str = "doc_id", separator: str = "") -> DataFrame:
    """key, grp (from 1), value: the attribute's values of the elements in each group, joined."""
    e = numbered(events, group, key, "grp").where(_opens(element) & (F.col("grp") > 0))
    listed = F.array_sort(F.collect_list(F.struct("line_no", F.coalesce(F.col("attrs")[name], F.lit("")).alias("v"))))
    return e.groupBy(key, "grp").agg(F.array_join(F.transform(listed, lambda x: x["v"]), separator).alias("value"))


def tokens_from_attribute(events: DataFrame, element: str, name: str, key: str = "doc_id") -> DataFrame:
    """The first token in an element is its attribute's value, further ones go; tokens outside stay."""
    e = numbered(events, element, key)
    w = _running(key)
    value = F.last(F.when(_opens(element), F.col("attrs")[name]), True).over(w)
    depth = F.sum(F.when(_opens(element), 1).when((F.col("kind") == "close") & (F.col("tag") == element), -1).otherwise(0)).over(w)
    e = e.withColumn("__value", value).withColumn("__in", depth > 0)
    nth = F.sum(F.when(F.col("kind") == "token", 1).otherwise(0)).over(Window.partitionBy(key, "unit").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    e = e.withColumn("__nth", nth).where((F.col("kind") != "token") | ~F.col("__in") | (F.col("__nth") == 1))
    inner = (F.col("kind") == "token") & F.col("__in") & F.col("__value").isNotNull()
    return e.withColumn("text", F.when(inner, F.col("__value")).otherwise(F.col("text"))).drop("unit", "__value", "__in", "__nth")


def running_ids(events: DataFrame, element: str, key: str = "doc_id", name: str = "xml:id", prefix: str = "u") -> DataFrame:
    """Each element gets an id by its place."""
    e = numbered(events, element, key)
    value = F.concat(F.lit(prefix), F.col("unit").cast("string"))
    return e.withColumn("attrs", F.when(_opens(element), _with_attribute(F.col("attrs"), name, value)).otherwise(F.col("attrs"))).drop("unit")


def span_tags(spans: DataFrame, key: str = "doc_id", priorities: list[str] = ()) -> DataFrame:
    """key, at, phase (0 before the place, 1 behind it), n, kind, tag, attrs: tags of spans (key, st, en, tag, attrs) so that they nest.

    Spans that open at one place: the longest first, then by the list of priorities, then by name; those that close at one place: the shortest first, then the other way round.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, priorities)).cast("array<string>"), F.col("tag")), F.lit(0)) if priorities else F.lit(0)
    s = spans.withColumn("__p", F.when(rank > 0, rank).otherwise(len(priorities) + 1)).withColumn("__len", F.col("en") - F.col("st"))
    opened = F.row_number().over(Window.partitionBy(key, "st").orderBy(F.desc("__len"), "__p", "tag"))
    closed = F.row_number().over(Window.partitionBy(key, "en").orderBy("__len", F.desc("__p"), F.desc("tag")))
    o = s.select(key, F.col("st").alias("at"), F.lit(0).alias("phase"), opened.alias("n"), F.lit("open").alias("kind"), "tag", "attrs")
    c = s.select(key, F.col("en").alias("at"), F.lit(1).alias("phase"), closed.alias("n"), F.lit("close").alias("kind"), "tag", F.lit(None).cast("map<string,string>").alias("attrs"))
    return o.unionByName(c)


def wrap_spans(events: DataFrame, spans: DataFrame, around: str, key: str = "doc_id", priorities: list[str] = (), parts: int | None = None) -> DataFrame:
    """Events with the tags of spans put around the elements named around. spans: key, st, en (numbers of such elements, from 1), tag, attrs. parts: partitions to do it in."""
    opens, closes = _opens(around), (F.col("kind") == "close") & (F.col("tag") == around)
    nth = lambda what: F.sum(F.coalesce(what, F.lit(False)).cast("int")).over(_running(key))
    at, phase = F.when(opens, nth(opens)).when(closes, nth(closes)), F.when(opens, 0).when(closes, 1)
    old = events.select(key, F.col("line_no").alias("l"), F.lit(0).alias("side"), F.lit(0).alias("n"), "kind", "tag", "attrs", "text", at.cast("long").alias("at"), phase.alias("phase"))
    # Openers stand before the line, closers behind it.
    none = F.lit(None).cast("string")
    new = span_tags(spans, key, priorities).select(key, F.lit(None).cast(events.schema["line_no"].dataType).alias("l"), F.when(F.col("phase") == 0, -1).otherwise(1).alias("side"), "n", "kind", "tag", "attrs", none.alias("text"), F.col("at").cast("long").alias("at"), "phase")
    # Lines and tags meet once, by key: a tag's line is that of the element at its place.
    both = old.unionByName(new)
    both = both.repartition(parts, key) if parts else both.repartition(key)
    line = F.coalesce("l", F.max("l").over(Window.partitionBy(key, "at", "phase")))
    both = both.withColumn("l", F.when(F.col("side") == 0, F.col("l")).otherwise(line)).where("l IS NOT NULL")
    return both.withColumn("line_no", F.row_number().over(Window.partitionBy(key).orderBy("l", "side", "n")) - 1).select(key, "line_no", "kind", "tag", "attrs", "text")


def with_metadata(events: DataFrame, meta: Column, key: str = "doc_id") -> DataFrame:
    """The meta element first and its end last; what meta says is added to the attributes that are there, and wins."""
    w = Window.partitionBy(key).orderBy("line_no")
    is_meta = F.coalesce(F.col("tag") == "meta", F.lit(False))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    have = F.coalesce(F.first(F.when(is_meta & (F.col("kind") == "open"), F.col("attrs")), True).over(whole), F.create_map().cast("map<string,string>"))
    e = events.withColumn("__have", have).withColumn("__first", F.row_number().over(w) == 1).withColumn("__last", F.lead(F.lit(1)).over(w).isNull())
    attrs = F.map_concat(F.map_filter("__have", lambda k, _: ~F.array_contains(F.map_keys(meta), k)), meta)
    none, text = F.lit(None).cast("map<string,string>"), F.lit(None).cast("string")
    row = lambda side, kind, tag, attrs, text: F.struct(F.lit(side).alias("side"), kind.alias("kind"), tag.alias("tag"), attrs.alias("attrs"), text.alias("text"))
    lines = F.array_compact(F.array(
        F.when(F.col("__first"), row(0, F.lit("open"), F.lit("meta"), attrs, text)), F.when(~is_meta, row(1, F.col("kind"), F.col("tag"), F.col("attrs"), F.col("text"))),
        F.when(F.col("__last"), row(2, F.lit("close"), F.lit("meta"), none, text)),
    ))
    out = e.select(key, "line_no", F.explode(lines).alias("x"))
    return out.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("line_no", "x.side")) - 1).alias("line_no"), "x.kind", "x.tag", "x.attrs", "x.text")


def processing_metadata(segmentation: str = "automatic", tagging: str = "automatic", parsing: str | None = None, entities: str | None = None, version: str | None = None) -> Column:
    """Attributes that say how a document was annotated: automatic, checked or gold."""
    facts = {"segmentation": segmentation, "tagging": tagging, "parsing": parsing, "entities": entities, "version": version}
    return F.create_map(*[F.lit(x) for kv in facts.items() if kv[1] for x in kv])


def group_segmentations(events: DataFrame, key: str = "doc_id", group: str = "norm_group", element: str = "norm") -> DataFrame:
    """key, grp, norm (of the whole group), seg (its units, joined by '|')."""
    e = numbered(events, group, key, "grp").where("grp > 0")
    unit = F.when(_opens(element), F.struct("line_no", F.coalesce(F.col("attrs")[element], F.lit("")).alias("v")))
    g = e.groupBy(key, "grp").agg(F.max(F.when(_opens(group), F.col("attrs")[group])).alias("norm"), F.array_sort(F.collect_list(unit)).alias("u"))
    return g.select(key, "grp", "norm", F.when(F.size("u") > 0, F.array_join(F.transform("u", lambda x: x["v"]), "|")).alias("seg"))


def consistent_segmentations(pairs: DataFrame) -> DataFrame:
    """Rows of norm and seg in which seg without its separators is as long as norm."""
    return pairs.where(F.length("norm") == F.length(F.replace("seg", F.lit("|"), F.lit(""))))


def plain_groups(text: Column) -> Column:
    """Groups of a plain text in order: what stands between blanks and underscores outside tags."""
    pieces = F.regexp_extract_all(text, F.lit("<[^<>]*>|[^<]+|<"), F.lit(0))
    kept = F.transform(pieces, lambda x: F.when(F.startswith(x, F.lit("<")) & F.endswith(x, F.lit(">")), F.translate(x, " _", "")).otherwise(x))
    groups = F.filter(F.split(F.array_join(kept, ""), "[ _\n\t\r]+"), lambda g: g != "")
    return F.transform(groups, lambda g: F.translate(g, "", " _"))


def separators_outside_brackets(segmented: Column) -> Column:
    """'[|' and '|]' become '|[' and ']|'."""
    return F.replace(F.replace(segmented, F.lit("[|"), F.lit("|[")), F.lit("|]"), F.lit("]|"))


def tagger_rows(units: DataFrame, key: str = "doc_id") -> DataFrame:
    """Units with a form: key, unit, norm, pos, lemma ('_' where missing); empty ones are left out."""
    fill = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "_").otherwise(F.col(c))
    return units.where(F.coalesce("norm", F.lit("")) != "").select(key, "unit", "norm", fill("pos").alias("pos"), fill("lemma").alias("lemma"))


def sentence_tagging_rows(units: DataFrame, key: str = "doc_id", group: str = "grp", sentence: str = "sent") -> DataFrame:
    """key, unit, norm, place (B, I, E, S in its group), label (SENT on the first unit of a sentence, else O)."""
    w = Window.partitionBy(key, group)
    n, i = F.count("*").over(w), F.row_number().over(w.orderBy("unit"))
    place = F.when(n == 1, "S").when(i == 1, "B").when(i == n, "E").otherwise("I")
    first = F.row_number().over(Window.partitionBy(key, sentence).orderBy("unit")) == 1
    return units.select(key, "unit", "norm", place.alias("place"), F.when(first, "SENT").otherwise("O").alias("label"))


def milestone_spans(events: DataFrame, elements: list[str], key: str = "doc_id") -> DataFrame:
    """Events in which unary tags of the elements are spans: each closes the one before, and the last ones close at the end, in order of their names."""
    m = (F.col("kind") == "unary") & F.col("tag").isin(elements)
    w = Window.partitionBy(key, "tag").orderBy("line_no")
    spans = events.where(m).withColumn("first", F.row_number().over(w) == 1)
    none, no_text = F.lit(None).cast("map<string,string>"), F.lit(None).cast("string")
    closes = spans.where("NOT first").select(key, "line_no", F.lit(0).alias("__s"), F.lit("close").alias("kind"), "tag", none.alias("attrs"), no_text.alias("text"))
    last = events.groupBy(key).agg(F.max("line_no").alias("line_no"))
    ends = spans.select(key, "tag").distinct().join(last, key).select(key, F.col("line_no") + 1, F.lit(0), F.lit("close"), "tag", none, no_text)
    opens = events.select(key, "line_no", F.lit(1).alias("__s"), F.when(m, "open").otherwise(F.col("kind")).alias("kind"), "tag", "attrs", "text")
    both = opens.unionAll(closes).unionAll(ends)
    return both.withColumn("line_no", F.row_number().over(Window.partitionBy(key).orderBy("line_no", "__s", "tag")) - 1).select(key, "line_no", "kind", "tag", "attrs", "text")


def super_token_rows(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, sent, id, form, place, tag: training rows of a tagger, with the place of each token in its super-token (B, I, E; O outside of any). tokens: with upto."""
    w = Window.partitionBy(key, "sent").orderBy("id", F.col("upto").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = tokens.withColumn("__end", F.last("upto", True).over(w)).withColumn("__begin", F.last(F.when(F.col("upto").isNotNull(), F.col("id")), True).over(w)).where("upto IS NULL")
    place = F.when(F.col("id") > F.col("__end"), "O").when(F.col("id") == F.col("__begin"), "B").when(F.col("id") == F.col("__end"), "E").when(F.col("__end").isNotNull(), "I").otherwise("O")
    return t.select(key, "sent", "id", "form", place.alias("place"), F.col("pos").alias("tag"))


def documents_with(events: DataFrame, name: str, values: list[str], key: str = "doc_id") -> DataFrame:
    """key of the documents whose meta element has one of the values: those checked by hand, say."""
    return events.where(_opens("meta") & F.col("attrs")[name].isin(values)).select(key).distinct()
