"""Lexicon tables: how they are made from corpora, and how words are looked up in them.

A lexicon is a DataFrame; joins leave the strategy to Catalyst, which broadcasts what is small enough.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def majority(pairs: DataFrame, key: str, value: str, first: Column | str) -> DataFrame:
    """Most frequent value of each key; of equals, the one seen first (first: what orders the rows, a struct if it takes several columns)."""
    n = pairs.groupBy(key, value).agg(F.count("*").alias("n"), F.min(first).alias("__first"))
    best = F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col("__first"), F.col(value)))
    return n.groupBy(key).agg(best.alias("b")).select(key, F.col(f"b.{value}"), "b.n")


def value_sets(pairs: DataFrame, key: str, value: str) -> DataFrame:
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), "|").alias("values"))


def relative_frequency(words: DataFrame, col: str) -> DataFrame:
    n = words.groupBy(col).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("total")))).select(col, "n", (F.col("n") / F.col("total")).alias("freq"))


def ambiguous(pairs: DataFrame, key: str, value: str, least: int = 1) -> DataFrame:
    """Keys with two values or more that are each seen least times; alternatives by count."""
    n = pairs.groupBy(key, value).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    alternatives = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v")))), lambda x: x["v"])
    return n.groupBy(key).agg(F.count("*").alias("n_values"), F.array_join(alternatives, "|").alias("alternatives")).where("n_values > 1")


def boundary_ngrams(text: DataFrame, key: str, col: str, n: int = 3) -> DataFrame:
    """Per n-gram of characters (blanks dropped, '#' before the text): how often a blank follows, or not, and the share."""
    plain = F.regexp_replace(F.trim(F.regexp_replace(col, "[ \n\t\r]+", " ")), " ", "")
    marks = F.regexp_replace(F.trim(F.regexp_replace(col, "[ \n\t\r]+", " ")), "[^ ] ", "1")
    rows = text.select(F.concat(F.repeat(F.lit("#"), n - 1), plain).alias("p"), F.regexp_replace(marks, "[^1]", "0").alias("m"))
    grams = rows.where("length(m) > 0").select("p", "m", F.explode(F.sequence(F.lit(1), F.length("m"))).alias("i")).select(F.substring("p", F.col("i"), F.lit(n)).alias("ngram"), (F.substring("m", F.col("i"), F.lit(1)) == "1").alias("b"))
    out = grams.groupBy("ngram").agg(F.sum(F.col("b").cast("long")).alias("n_bound"), F.sum((~F.col("b")).cast("long")).alias("n_not"))
    return out.withColumn("p", F.col("n_bound") / (F.col("n_bound") + F.col("n_not")))


def new_entries(words: DataFrame, known: DataFrame, col: str) -> DataFrame:
    return words.groupBy(col).agg(F.count("*").alias("n")).join(known.select(col).distinct(), col, "left_anti")


def lookup(words: DataFrame, table: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Left join with a table; a miss, or a null key, gives default. Of rows of the table with one key the last by value counts. The table is joined to distinct words, and those to the rows."""
    table = table.groupBy(key).agg(F.max(value).alias(value))
    types = words.select(key).where(F.col(key).isNotNull()).distinct().join(table, key, "left").select(key, F.struct(value).alias("__hit"))
    return words.join(types, key, "left").withColumn(value, F.coalesce(f"__hit.{value}", default)).drop("__hit")


def fix_tags(words: DataFrame, fixes: DataFrame) -> DataFrame:
    """words: word, tag. fixes: word, tag ('*': any), new_tag; the exact rule comes before the open one, of equal rules the first by new_tag."""
    fixes = fixes.groupBy("word", "tag").agg(F.min("new_tag").alias("new_tag"))
    exact = fixes.where("tag != '*'").withColumnRenamed("new_tag", "__exact")
    star = fixes.where("tag = '*'").select("word", F.col("new_tag").alias("__star"))
    return words.join(exact, ["word", "tag"], "left").join(star, "word", "left").withColumn("new_tag", F.coalesce("__exact", "__star", "tag")).drop("__exact", "__star")


def lemmatize(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """words: word, tag. lexicon: word, tag, lemma. The smallest lemma of word and tag, else the word if it is known, else 'UNKNOWN'."""
    best = lexicon.groupBy("word", "tag").agg(F.min("lemma").alias("__lemma"))
    known = lexicon.select("word").distinct().withColumn("__known", F.lit(True))
    return words.join(best, ["word", "tag"], "left").join(known, "word", "left").withColumn("lemma", F.coalesce("__lemma", F.when(F.col("__known"), F.col("word")), F.lit("UNKNOWN"))).drop("__lemma", "__known")


def origin(words: DataFrame, entries: DataFrame, col: str = "word") -> DataFrame:
    """entries: form, lang; 'abc*' is a prefix, '*abc' a suffix. Exact, then the shortest prefix, then the longest suffix; null if there is none.

    Words are cut only at the lengths that affixes have: a handful of numbers, collected.
    """
    exact = entries.where("form NOT LIKE '%*%'").groupBy(F.col("form").alias(col)).agg(F.min("lang").alias("__exact"))
    prefix = entries.where("form LIKE '%*'").select(F.expr("substring(form, 1, length(form) - 1)").alias("affix"), "lang")
    suffix = entries.where("form LIKE '*%'").select(F.expr("substring(form, 2)").alias("affix"), "lang")
    types = words.select(col).where(F.col(col).isNotNull()).distinct()

    def longest_or_shortest(affixes: DataFrame, cut, best: Column, name: str) -> DataFrame:
        lengths = F.array(*[F.lit(r.n) for r in affixes.select(F.length("affix").alias("n")).distinct().collect()]).cast("array<int>")
        cuts = types.select(col, F.explode(F.filter(lengths, lambda n: n <= F.length(col))).alias("n")).withColumn("affix", cut(F.col("n")))
        return cuts.join(affixes, "affix").groupBy(col).agg(F.min_by("lang", best).alias(name))

    p = longest_or_shortest(prefix, lambda n: F.substring(col, F.lit(1), n), F.struct("n", "lang"), "__prefix")
    s = longest_or_shortest(suffix, lambda n: F.substring(col, F.length(col) - n + 1, n), F.struct(-F.col("n"), F.col("lang")), "__suffix")
    found = types.join(exact, col, "left").join(p, col, "left").join(s, col, "left").select(col, F.coalesce("__exact", "__prefix", "__suffix").alias("origin"))
    return words.join(found, col, "left")


def phrase_candidates(units: DataFrame, phrases: DataFrame, key: str, by: str, col: str, longest: int = 4) -> DataFrame:
    """Runs of 2 to longest units that are phrases: key, st, en, phrase."""
    w = Window.partitionBy(key).orderBy(by)
    ahead = units.select(key, F.col(by).alias("st"), F.col(col).alias("w0"), *[F.lead(col, k).over(w).alias(f"w{k}") for k in range(1, longest)])
    runs = F.array(*[F.struct(F.lit(n).alias("n"), F.when(F.col(f"w{n - 1}").isNotNull(), F.concat_ws(" ", *[f"w{k}" for k in range(n)])).alias("p")) for n in range(2, longest + 1)])
    found = ahead.select(key, "st", F.explode(runs).alias("r")).where("r.p IS NOT NULL")
    return found.select(key, "st", (F.col("st") + F.col("r.n") - 1).alias("en"), F.col("r.p").alias("phrase")).join(phrases.select("phrase").distinct(), "phrase", "left_semi")


def _greedy(spans: pa.Array) -> pa.Array:
    """Which of each row's spans, by start and end, are taken: leftmost first, none before the last one's end."""
    st, en = (spans.flatten().field(k).to_pylist() for k in ("st", "en"))
    ends, keep = spans.offsets.to_pylist(), []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        last = None
        for i in range(a - ends[0], b - ends[0]):
            taken = last is None or st[i] > last
            keep.append(taken)
            last = en[i] if taken else last
    return pa.ListArray.from_arrays(pa.array([e - ends[0] for e in ends], pa.int32()), pa.array(keep, pa.bool_()))


def greedy_spans(candidates: DataFrame, key: str) -> DataFrame:
    """Leftmost, then shortest, and none that overlaps one taken before.

    A span that begins behind all before it is taken whatever was taken of these, so the pass runs apart over each island of spans that overlap.
    """
    before = F.max("en").over(Window.partitionBy(key).orderBy("st", "en").rowsBetween(Window.unboundedPreceding, -1))
    c = candidates.withColumn("__new", F.when(F.coalesce(F.col("st") > before, F.lit(True)), 1).otherwise(0))
    c = c.withColumn("__island", F.sum("__new").over(Window.partitionBy(key).orderBy("st", "en").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    islands = c.groupBy(key, "__island").agg(F.array_sort(F.collect_list(F.struct("st", "en", "phrase"))).alias("c"))
    kept = islands.withColumn("__keep", F.arrow_udf(_greedy, "array<boolean>")("c"))
    return kept.select(key, F.inline(F.filter("c", lambda _, i: F.get("__keep", i))))


def prefix_morphs(word: Column, table: dict[str, str], prefixes: list[str], least: int = 2) -> Column:
    """A table's analysis, else the first prefix cut off that leaves least letters."""
    out = None
    for k, v in table.items():
        out = F.when(word == k, v) if out is None else out.when(word == k, v)
    for p in prefixes:
        hit = F.startswith(word, F.lit(p)) & (F.length(word) >= len(p) + least)
        cut = F.concat(F.lit(p + "-"), F.substring(word, len(p) + 1, 1 << 30))
        out = F.when(hit, cut) if out is None else out.when(hit, cut)
    return out.otherwise(word)


def arbitrate(predicted: Column, alternatives: Column) -> Column:
    """The prediction if it is listed, else the first alternative."""
    return F.when(F.array_contains(alternatives, predicted), predicted).otherwise(alternatives[0])


def cascade(rows: DataFrame, levels: list[tuple[DataFrame, list[str], str]], out: str) -> DataFrame:
    """First hit of several left joins: (table, keys, value column). Of rows of a table with equal keys the least value counts."""
    names = []
    for i, (table, keys, value) in enumerate(levels):
        names.append(f"__level{i}")
        rows = rows.join(table.groupBy(*keys).agg(F.min(value).alias(names[-1])), keys, "left")
    return rows.withColumn(out, F.coalesce(*names)).drop(*names)


def origin_by_tag(words: DataFrame, exceptions: list[tuple[str, str, str | None]], col: str = "word", tag: str = "tag") -> DataFrame:
    """words with origin after exceptions: (word, tag, origin or null)."""
    out = F.col("origin")
    for word, t, value in reversed(exceptions):
        out = F.when((F.col(col) == word) & (F.col(tag) == t), F.lit(value).cast("string")).otherwise(out)
    return words.withColumn("origin", out)


def lemmas_in_context(words: DataFrame, rules: list[tuple[str, str, list[str], str]], key: str = "doc_id", by: str = "i", col: str = "word") -> DataFrame:
    """words with lemma after rules: (word, 'prev' or 'next', neighbours, lemma); the first that holds counts."""
    w = Window.partitionBy(key).orderBy(by)
    side = {"prev": F.lag(col).over(w), "next": F.lead(col).over(w)}
    out = F.col("lemma")
    for word, where, near, lemma in reversed(rules):
        out = F.when((F.col(col) == word) & F.coalesce(side[where].isin(near), F.lit(False)), lemma).otherwise(out)
    return words.withColumn("lemma", out)


def without_rare(lexicon: DataFrame, counts: DataFrame, share: float = 0.1, col: str = "word", seed: str = "rare") -> DataFrame:
    """lexicon without a share of its words that counts (word, n) has once or never; which ones is a hash of the word."""
    chance = F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    n = counts.groupBy(col).agg(F.sum("n").alias("__n"))
    return lexicon.join(n, col, "left").where((F.coalesce("__n", F.lit(0)) > 1) | (chance >= share)).drop("__n")


def last_values(rows: DataFrame, key: str, value: str, line: str) -> DataFrame:
    """key, value: of rows with one key the last by line."""
    return rows.groupBy(key).agg(F.max_by(value, line).alias(value))


def grid(units: DataFrame, group: DataFrame | None, key: str, by: str, columns: list[str], group_columns: list[str]) -> DataFrame:
    """Rows of a spreadsheet: row (from 1), a column for each annotation of the unit and of its group, and span: over how many rows a group's cells reach (0 on rows inside it).

    units and group share key and grp; without group, units have the columns of their groups. A sheet has 26 columns at most.
    """
    if len(columns) + len(group_columns) > 26:
        raise ValueError("a sheet has at most 26 columns")
    w = Window.partitionBy(key).orderBy("grp", by)
    g = Window.partitionBy(key, "grp")
    first = F.row_number().over(g.orderBy(by)) == 1
    u = units if group is None else units.join(group.select(key, "grp", *group_columns), [key, "grp"], "left")
    cells = [F.when(first, F.col(c)).alias(c) for c in group_columns]
    return u.select(key, F.row_number().over(w).alias("row"), *columns, *cells, F.when(first, F.count("*").over(g)).otherwise(0).alias("span"))
