"""Groups of a raw text bound anew: cleaning of lines, merges of proclitics, separators by prediction, alignment of two versions of a text letter by letter."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What is no text of the language in a raw edition, and groups that nothing is merged into.
FOREIGN = [r"\[F[^\]]+\]", r"\|F[^|]+\|", r"\([^)]+\)", r"[A-Za-z0-9|]"]
PUNCTUATION = [".", ",", ":", ";", "·", "⳩", "⁘"]


def clean_raw(text: Column, foreign: list[str] = FOREIGN) -> Column:
    """Raw text without foreign matter: points and colons spaced out, runs of line breaks and of blanks made one."""
    t = F.replace(F.replace(F.replace(text, F.lit("."), F.lit(" .")), F.lit("·"), F.lit(" ·")), F.lit(":"), F.lit(" : "))
    t = F.regexp_replace(t, "(" + "|".join(foreign) + ")", "")
    return F.regexp_replace(F.regexp_replace(t, "\n+", "\n"), " +", " ")


def joined_lines(text: Column, hyphen: str = "‐") -> Column:
    """Lines put together: one that ends in a hyphen loses it and runs on, others get a blank; empty ones go."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    piece = lambda x: F.when(F.endswith(x, F.lit(hyphen)), F.regexp_replace(x, f"{hyphen}$", "")).otherwise(F.concat(x, F.lit(" ")))
    return F.array_join(F.transform(lines, piece), "")


def merge_flags(groups: list[str], bound: set[str], no_merge: set[str]) -> list[int]:
    """Number of the merged group that each group belongs to: one is joined to what stands before if that, as merged so far, is bound, or the group before it is."""
    out, number, merged, last = [], -1, "", None
    for g in groups:
        if last is not None and (last in bound or merged in bound) and g not in no_merge:
            merged += g
        else:
            number, merged = number + 1, g
        last = g
        out.append(number)
    return out


def detokenize(groups: DataFrame, table: DataFrame, level: int = 1, key: str = "doc_id", by: str = "i", col: str = "tok", no_merge: list[str] = PUNCTUATION) -> DataFrame:
    """groups with grp, the number of the merged group: proclitics of the table (form, p, aggressive) are joined to what follows, and merged groups looked up again.

    Level 0 merges nothing, 1 what the table holds bound with p of 0.5 or more, 2 its aggressive rows too. The table is one that
    a lexicon is: its forms go to every task.
    """
    bound = table.where("p >= 0.5") if level > 1 else table.where("p >= 0.5 AND NOT aggressive")
    known = groups.sparkSession.sparkContext.broadcast(({r.form for r in bound.select("form").collect()} if level else set(), set(no_merge)))

    def flags(lists: pa.Array) -> pa.Array:
        return pa.array([merge_flags(x, *known.value) for x in lists.to_pylist()], pa.list_(pa.int32()))

    docs = groups.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(by, col))).alias("g"))
    docs = docs.withColumn("f", F.arrow_udf(flags, "array<int>")(F.transform("g", lambda x: x[col])))
    return docs.select(key, F.explode(F.arrays_zip("g", "f")).alias("z")).select(key, f"z.g.{by}", f"z.g.{col}", F.col("z.f").alias("grp"))


def merged_forms(words: Column, table: DataFrame, level: int = 1, no_merge: list[str] = PUNCTUATION) -> Column:
    """The forms of the groups that detokenize makes of several words each, as an array; words: those of a text in order."""
    bound = table.where("p >= 0.5") if level > 1 else table.where("p >= 0.5 AND NOT aggressive")
    known = table.sparkSession.sparkContext.broadcast(({r.form for r in bound.select("form").collect()} if level else set(), set(no_merge)))

    def forms(lists: pa.Array) -> pa.Array:
        out = []
        for x in lists.to_pylist():
            numbers, own, last = merge_flags(x or [], *known.value), [], None
            for k, number in enumerate(numbers):
                if number == last:  # the second of a group brings the first along
                    own.append([x[k - 1], x[k]]) if k < 2 or numbers[k - 2] != number else own[-1].append(x[k])
                last = number
            out.append(["".join(g) for g in own])
        return pa.array(out, pa.list_(pa.string()))

    return F.arrow_udf(forms, "array<string>")(words)


def merged_groups(groups: DataFrame, key: str = "doc_id", by: str = "i", col: str = "tok", boundary: str = "") -> DataFrame:
    """key, grp, form: the pieces of merged groups joined, with a boundary between them if wanted."""
    listed = F.array_sort(F.collect_list(F.struct(by, col)))
    return groups.groupBy(key, "grp").agg(F.array_join(F.transform(listed, lambda x: x[col]), boundary).alias("form"))


def text_with_separators(tokens: DataFrame, p: str, key: str = "doc_id", by: str = "i", col: str = "tok", separator: str = "_") -> DataFrame:
    """key, text: tokens joined, with a separator behind those that are bound to the next with a probability of 0.5 at most; none at the end."""
    piece = F.concat(F.col(col), F.when(F.col(p) <= 0.5, separator).otherwise(""))
    listed = F.array_sort(F.collect_list(F.struct(by, piece.alias("t"))))
    text = F.array_join(F.transform(listed, lambda x: x["t"]), "")
    return tokens.groupBy(key).agg(F.regexp_replace(text, f"{separator}$", "").alias("text"))


def letters(text: Column, separators: str = " _|-") -> Column:
    """The text without separators."""
    return F.translate(text, separators, "")


def same_letters(a: Column, b: Column, separators: str = " _|-") -> Column:
    """Whether two texts have the same letters, whatever their separators; null if one is null."""
    return letters(a, separators) == letters(b, separators)


def checked_same_letters(a: Column, b: Column, separators: str = " _|-") -> Column:
    """a, or an error where the letters of the two differ."""
    return F.when(F.coalesce(same_letters(a, b, separators), F.lit(True)), a).otherwise(F.raise_error(F.lit("texts differ in their letters")).cast("string"))


def place_without_separators(text: Column, n: Column, separators: str = "|-_ ") -> Column:
    """Place (from 0) of the n-th letter (from 0) of a text in which separators don't count; null if there are fewer."""
    places = F.filter(F.transform(F.split(text, ""), lambda c, i: F.when(~F.lit(separators).contains(c) & (c != ""), i)), lambda x: x.isNotNull())
    return F.get(places, n)


def letter_rows(docs: DataFrame, text: str, key: str = "doc_id", separators: str = " _") -> DataFrame:
    """key, n (from 0, separators not counted), c, sep: whether a separator follows."""
    c = docs.select(key, F.posexplode(_letters(F.col(text), separators)).alias("n", "l"))
    return c.select(key, "n", F.substring("l", 1, 1).alias("c"), (F.length("l") > 1).alias("sep"))


def _letters(text: Column, separators: str) -> Column:
    """The letters of a text in order, each with a separator that follows it."""
    own = "".join("\\" + c for c in separators)
    return F.regexp_extract_all(text, F.lit(f"[^{own}][{own}]?" if own else "(?s)."), F.lit(0))


def aligned_letters(docs: DataFrame, orig: str, gold: str, key: str = "doc_id", orig_separators: str = " ", gold_separators: str = "_") -> DataFrame:
    """key, n, c, orig_sep, gold_sep: letters of two versions of a text, put together by their places without separators; texts are rows, so no letter leaves its own."""
    both = F.arrays_zip(_letters(F.col(orig), orig_separators).alias("a"), _letters(F.col(gold), gold_separators).alias("b"))
    z = docs.select(key, F.posexplode(both).alias("n", "z")).where(F.substring("z.a", 1, 1) == F.substring("z.b", 1, 1))
    return z.select(key, "n", F.substring("z.a", 1, 1).alias("c"), (F.length("z.a") > 1).alias("orig_sep"), (F.length("z.b") > 1).alias("gold_sep"))


def proportional_split(groups: DataFrame, share: float = 0.8, key: str = "doc_id", by: str = "i") -> DataFrame:
    """groups with part: train for the first share of each text's groups, test for the rest; a text is cut between groups."""
    w = Window.partitionBy(key)
    return groups.withColumn("part", F.when(F.row_number().over(w.orderBy(by)) <= F.floor(F.count("*").over(w) * share), "train").otherwise("test"))


def systematic_split(rows: DataFrame, every: int, order: list[str]) -> DataFrame:
    """rows with test: each every-th in order, the first one included. Ranges of the order are numbered apart, so no task sees all rows."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id())
    counts = placed.groupBy("__p").agg(F.count("*").alias("c"), F.min("__m").alias("__lo"))
    before = counts.withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    return placed.join(F.broadcast(before), "__p").withColumn("test", (F.col("__m") - F.col("__lo") + F.col("before")) % every == 0).drop("__p", "__m", "__lo", "before")


def train_rows(rows: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """rows whose key the test rows don't have."""
    return rows.join(test.select(key).distinct(), key, "left_anti")


def corpus_text(groups: DataFrame, corpus: str, order: list[str], col: str, separator: str = "_") -> DataFrame:
    """corpus, text: all groups of a corpus in order."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(col).alias("__v"))))
    return groups.groupBy(corpus).agg(F.array_join(F.transform(listed, lambda x: x["__v"]), separator).alias("text"))


def synthetic_splits(groups: DataFrame, prefixes: list[str], suffixes: list[str], keys: list[str], col: str = "units", seed: str = "split", shares: tuple[float, float] = (0.5, 0.8)) -> DataFrame:
    """groups (col: array of units) with split: the units, bound again as a careless scribe would part them: behind a first unit that is a prefix, before a last one that is a suffix, each by chance.

    Chance is a hash of the keys, so that reruns agree.
    """
    chance = lambda salt: F.pmod(F.xxhash64(*keys, F.lit(f"{seed}{salt}")), F.lit(1 << 20)) / float(1 << 20)
    u = F.col(col)
    cut_first = (F.size(u) > 1) & u[0].isin(prefixes) & (chance("p") < shares[0])
    cut_last = (F.size(u) > 1) & F.element_at(u, -1).isin(suffixes) & (chance("s") < shares[1])
    n = F.size(u)
    piece = lambda x, i: F.concat(x, F.when((cut_first & (i == 0)) | (cut_last & (i == n - 2)), " ").otherwise(""))
    return groups.withColumn("split", F.array_join(F.transform(u, piece), ""))


def windowed(df: DataFrame, feature: Column, name: str, left: int, right: int, default: object, key: str = "doc_id", by: str = "i", skip_self: bool = False) -> DataFrame:
    """The feature at each place from left before a row to right behind it, as columns name_-1, name_0, ...; default outside the text."""
    w = Window.partitionBy(key).orderBy(by)
    df = df.withColumn("__f", feature)
    for k in range(-left, right + 1):
        if k or not skip_self:
            at = F.col("__f") if k == 0 else F.lead("__f", k).over(w) if k > 0 else F.lag("__f", -k).over(w)
            df = df.withColumn(f"{name}_{k}", F.coalesce(at, F.lit(default)))
    return df.drop("__f")


def capped_chunks(units: DataFrame, ends: Column, most: int = 100, key: str = "doc_id", by: str = "i") -> DataFrame:
    """units with chunk: sentences, of which those longer than most units are cut after each most."""
    w = Window.partitionBy(key).orderBy(by)
    u = units.withColumn("__s", F.coalesce(F.sum(ends.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    u = u.withColumn("__k", F.floor((F.row_number().over(Window.partitionBy(key, "__s").orderBy(by)) - 1) / most))
    return u.withColumn("chunk", F.dense_rank().over(Window.partitionBy(key).orderBy("__s", "__k")) - 1).drop("__s", "__k")


def chunk_arrays(sentences: Column, most: int = 100) -> Column:
    """capped_chunks of one text: from its sentences (struct<start, words, ...>) its chunks in order, as struct<start, words>."""
    pieces = lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.size(s["words"]) - 1) / most).cast("int")), lambda k: F.struct((s["start"] + k * most).alias("start"), F.slice(s["words"], k * most + 1, most).alias("words")))
    return F.flatten(F.transform(sentences, pieces))


def repaired_breaks(units: DataFrame, key: str = "doc_id", by: str = "i", flag: str = "break", group: str = "grp", tag: str = "pos", punctuation: str = "PUNCT", bad: list[str] = (), least: int = 50) -> DataFrame:
    """units with new_break: breaks inside a group move to its begin; a break on punctuation waits for the next other unit; one on a bad start is dropped if the sentence would be shorter than least."""

    def fix(tags: list, groups: list, flags: list) -> list[bool]:
        want, out, waiting = [False] * len(tags), [False] * len(tags), False
        start = {}
        for i, g in enumerate(groups):
            start.setdefault(g, i)
        for i, f in enumerate(flags):
            if f:
                want[start[groups[i]]] = True
        last = 0
        for i, t in enumerate(tags):
            waiting = waiting or want[i]
            if waiting and t != punctuation:
                if i == 0 or t not in bad or i - last >= least:
                    out[i], last = True, i
                waiting = False
        return out

    def run(tags: pa.Array, groups: pa.Array, flags: pa.Array) -> pa.Array:
        return pa.array([fix(*x) for x in zip(tags.to_pylist(), groups.to_pylist(), flags.to_pylist(), strict=True)], pa.list_(pa.bool_()))

    docs = units.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(by, tag, group, flag))).alias("u"))
    field = lambda c: F.transform("u", lambda x: x[c])
    fields = [field(c) for c in (tag, group, flag)]
    docs = docs.withColumn("n", F.arrow_udf(run, "array<boolean>")(*fields))
    return docs.select(key, F.explode(F.arrays_zip("u", "n")).alias("z")).select(key, "z.u.*", F.col("z.n").alias("new_break"))
