"""Features of characters, groups and tokens for the learned steps: looked up and computed as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.lexicon import value_sets

TINY = 1e-10


def tag_table(units: DataFrame, form: str = "form", tag: str = "pos") -> DataFrame:
    """form, tags: all tags of a form, sorted, joined by '|'."""
    return value_sets(units, form, tag).select(F.col(form).alias("form"), F.col("values").alias("tags"))


def _spans(k: Column, n: Column, reach: int) -> dict[str, tuple[Column, Column]]:
    """Name of each part of a form that is looked up, with its begin (from 1) and length; k: the character's place (from 0), n: the form's length."""
    out = {"prefix": (F.lit(1), k + 1), "suffix": (k + 2, n - k - 1), "suffix_1": (k + 1, n - k), "suffix_2": (k, n - k + 1)}
    for r in range(1, reach + 1):
        out[f"back_{r}"] = (k + 1 - r, F.lit(r + 1))
        out[f"ahead_{r}"] = (k + 1, F.lit(r + 1))
    return out


def character_features(types: DataFrame, lexicon: DataFrame, frequencies: DataFrame, col: str = "form", vowels: str = "aeiou", reach: int = 4) -> DataFrame:
    """One row for each character of each distinct form: form, k, n, letters and vowel flags up to two places around (-1 outside), tags of the parts of the form that meet here, freq_ratio.

    lexicon: form, tags. frequencies: form, freq. The parts: what ends and what begins here, and grams of up to
    reach letters more; '_' for those that the lexicon lacks. freq_ratio sets the frequencies of the two halves
    against that of the whole. All lookups are one join.
    """
    t = types.select(col).where(F.col(col) != "").distinct().withColumn("n", F.length(col))
    c = t.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    spans = _spans(F.col("k"), F.col("n"), reach)
    part = lambda name: F.when((spans[name][0] >= 1) & (spans[name][1] >= 1) & (spans[name][0] + spans[name][1] - 1 <= F.col("n")), F.substring(col, spans[name][0], spans[name][1]))
    parts = c.select(col, "k", F.explode(F.array(*[F.struct(F.lit(name).alias("name"), part(name).alias("form")) for name in spans], F.struct(F.lit("whole").alias("name"), F.col(col).alias("form")))).alias("p"))
    known = lexicon.select("form", "tags").join(frequencies.groupBy("form").agg(F.sum("freq").alias("freq")), "form", "full_outer").withColumnRenamed("form", "__f")
    found = parts.where("p.form IS NOT NULL").join(known, F.col("p.form") == F.col("__f"))
    of = lambda name, what: F.max(F.when(F.col("p.name") == name, F.col(what)))
    looked = found.groupBy(col, "k").agg(*[of(name, "tags").alias(name) for name in spans], *[of(name, "freq").alias(f"f_{name}") for name in ("prefix", "suffix", "whole")])
    out = c.join(looked, [col, "k"], "left")
    for d in (-2, -1, 0, 1, 2):
        at = F.col("k") + d
        inside = (at >= 0) & (at < F.col("n"))
        letter = F.substring(col, at + 1, F.lit(1))
        name = f"c{d:+d}" if d else "c"
        out = out.withColumn(name, F.when(inside, letter).otherwise("_")).withColumn(f"v{d:+d}" if d else "v", F.when(inside, F.lit(vowels).contains(letter).cast("int")).otherwise(-1))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    ratio = zero("f_prefix") * zero("f_suffix") / (zero("f_whole") + TINY)
    filled = [F.coalesce(name, F.lit("_")).alias(name) for name in spans]
    letters = [x for d in (-2, -1, 0, 1, 2) for x in ((f"c{d:+d}", f"v{d:+d}") if d else ("c", "v"))]
    return out.select(col, "k", "n", *letters, *filled, ratio.alias("freq_ratio"))


def gated(features: DataFrame, seen: DataFrame, columns: list[str]) -> DataFrame:
    """Categories that training data doesn't have become '_'. seen: training rows; their values are a vocabulary, collected by column."""
    for c in columns:
        values = [r[0] for r in seen.select(c).distinct().collect()]
        features = features.withColumn(c, F.when(F.col(c).isin(values), F.col(c)).otherwise("_"))
    return features


def context_features(groups: DataFrame, key: str = "doc_id", by: str = "i", col: str = "form", tags: DataFrame | None = None) -> DataFrame:
    """groups with first and last letter, length and tags of the group before and after; '_' and 0 at the ends."""
    g = groups.join(tags.withColumnRenamed("form", col), col, "left") if tags is not None else groups.withColumn("tags", F.lit("_"))
    w = Window.partitionBy(key).orderBy(by)
    out = g
    for name, shift in (("prev", F.lag), ("next", F.lead)):
        form = shift(col).over(w)
        out = out.withColumn(f"{name}_first", F.coalesce(F.substring(form, 1, 1), F.lit("_"))).withColumn(f"{name}_last", F.coalesce(F.right(form, F.lit(1)), F.lit("_")))
        out = out.withColumn(f"{name}_len", F.coalesce(F.length(form), F.lit(0))).withColumn(f"{name}_tags", F.coalesce(shift("tags").over(w), F.lit("_")))
    return out.drop("tags")


def arbitration_features(rows: DataFrame, seg: str = "seg", rule: str = "rule", vowels: str = "ⲁⲉⲓⲟⲩⲏⲱ") -> DataFrame:
    """rows with the nine numbers that say whether a grammar's segmentation can be trusted: length, pieces, rule, first and last letter, first and last inner vowel and consonant (code points, 0 for none)."""
    plain = F.replace(F.col(seg), F.lit("|"), F.lit(""))
    inner = F.filter(F.split(F.when(F.length(plain) > 2, F.substring(plain, F.lit(2), F.length(plain) - 2)).otherwise(""), ""), lambda c: c != "")
    v = F.filter(inner, lambda c: F.lit(vowels).contains(c))
    k = F.filter(inner, lambda c: ~F.lit(vowels).contains(c))
    code = lambda c: F.coalesce(F.ascii(c), F.lit(0))
    ends = {"first_vowel": F.get(v, F.lit(0)), "last_vowel": F.try_element_at(v, F.lit(-1)), "first_cons": F.get(k, F.lit(0)), "last_cons": F.try_element_at(k, F.lit(-1))}
    return rows.select(
        "*", F.length(plain).alias("length"), (F.size(F.split(seg, "[|]")) - 1).alias("pieces"), F.coalesce(F.col(rule), F.lit(0)).alias("rule_number"),
        F.ascii(seg).alias("first"), F.ascii(F.right(F.col(seg), F.lit(1))).alias("last"), *[code(c).alias(n) for n, c in ends.items()],
    )


def binding_features(tokens: DataFrame, group_freq: DataFrame, bound: DataFrame, ngrams: DataFrame, tags: DataFrame, prepositions: list[str], key: str = "doc_id", by: str = "i", col: str = "tok", gram: int = 3, undefined: tuple[int, float] = (0, 0.5)) -> DataFrame:
    """Features of a token for whether it is bound to the next.

    Counts of the token and of it with the next as groups (group_freq: form, freq); how often the two tables saw
    it bound and not (bound, ngrams: form, n_bound, n_not_bound, p; ngrams by its last letters), alone and with the next; length, tags,
    is_prep, first and last letter, whether it is punctuation. Unseen counts and probabilities are undefined.
    """
    nothing, unsure = undefined
    w = Window.partitionBy(key).orderBy(by)
    t = tokens.withColumn("__next", F.lead(col).over(w)).withColumn("__both", F.concat(col, F.coalesce("__next", F.lit(""))))
    t = t.withColumn("__gram", F.right(F.col(col), F.lit(gram)))
    freq = group_freq.groupBy("form").agg(F.sum("freq").alias("freq"))
    for on, name in ((col, "group_count"), ("__both", "combined_count")):
        t = t.join(freq.select(F.col("form").alias(on), F.col("freq").alias(name)), on, "left")
    for on, table, name in ((col, bound, "morph"), ("__gram", ngrams, "ngram"), ("__both", bound, "combined")):
        b = table.groupBy(F.col("form").alias(on)).agg(F.max("n_bound").alias(f"{name}_bound"), F.max("n_not_bound").alias(f"{name}_not_bound"), F.max("p").alias(f"{name}_p"))
        t = t.join(b, on, "left")
    t = t.join(tags.select(F.col("form").alias(col), "tags"), col, "left")
    counts = ["group_count", "combined_count", *[f"{n}_{x}" for n in ("morph", "ngram", "combined") for x in ("bound", "not_bound")]]
    shares = [f"{n}_p" for n in ("morph", "ngram", "combined")]
    t = t.na.fill(nothing, counts).na.fill(unsure, shares).na.fill("_", ["tags"])
    t = t.withColumn("combined_count", F.when(F.col("__next").isNull(), 0).otherwise(F.col("combined_count")))
    return t.select(
        key, by, col, *counts, *shares, "tags", F.length(col).alias("length"), F.col(col).isin(prepositions).cast("int").alias("is_prep"), F.substring(col, 1, 1).alias("first"), F.right(F.col(col), F.lit(1)).alias("last"),
        F.col(col).rlike(r"^\p{P}*$").cast("int").alias("all_punct"), F.col(col).rlike(r"\p{P}").cast("int").alias("any_punct"),
    )


def longest_known_ends(words: DataFrame, lexicon: DataFrame, col: str = "form") -> DataFrame:
    """words with right_sub, right_tags, right_share and left_sub, left_tags, left_share: the longest proper ending and beginning that the lexicon (form, tags) has, and its share of the word."""
    types = words.select(col).where(F.length(col) > 1).distinct()
    cuts = types.withColumn("m", F.explode(F.sequence(F.lit(1), F.length(col) - 1)))
    out = words
    for name, part in (("right", F.right(F.col(col), F.col("m"))), ("left", F.substring(col, F.lit(1), F.col("m")))):
        hit = cuts.withColumn("__p", part).join(lexicon.select(F.col("form").alias("__p"), F.col("tags").alias("__t")), "__p")
        best = hit.groupBy(col).agg(F.max_by(F.struct(F.col("__p").alias("sub"), F.col("__t").alias("tags"), (F.col("m") / F.length(col)).alias("share")), "m").alias("b"))
        out = out.join(best.select(col, *[F.col(f"b.{x}").alias(f"{name}_{x}") for x in ("sub", "tags", "share")]), col, "left")
    return out


def sentence_features(tokens: DataFrame, frequent: DataFrame, key: str = "doc_id", by: str = "i", col: str = "tok", tag: str = "pos", punctuation: str = "PUNCT") -> DataFrame:
    """tokens with what a sentence splitter looks at: the word if it is frequent (frequent: word), else its tag; case; length; distance since the last punctuation and to the next; tags of two tokens around."""
    w = Window.partitionBy(key).orderBy(by)
    back = Window.partitionBy(key).orderBy(F.desc(by))
    is_punct = F.when(F.col(tag) == punctuation, F.col(by))
    last = lambda o: F.last(is_punct, True).over(o.rowsBetween(Window.unboundedPreceding, -1))
    t = tokens.join(frequent.select(F.col("word").alias(col)).distinct().withColumn("__f", F.lit(True)), col, "left")
    near = [F.coalesce((F.lag(tag, abs(d)) if d < 0 else F.lead(tag, d)).over(w), F.lit("_")).alias(f"tag{d:+d}") for d in (-2, -1, 1, 2)]
    case = F.when((F.col(col) == F.upper(col)) & (F.col(col) != F.lower(col)), "u").when(F.col(col) == F.lower(col), "l").otherwise("t")
    return t.select(key, by, F.when(F.col("__f"), F.col(col)).otherwise(F.col(tag)).alias("word"), case.alias("case"), F.length(col).alias("length"), F.coalesce(F.col(by) - last(w), F.lit(-1)).alias("since"), F.coalesce(last(back) - F.col(by), F.lit(5)).alias("until"), *near)


def letter_context(docs: DataFrame, text: str, key: str = "doc_id", left: int = 8, right: int = 18, separator: str = "_", pad: str = "#") -> DataFrame:
    """key, n, before, after, label: for each letter of a text without separators, the letters up to it and behind it, padded, and whether a separator follows."""
    plain = F.replace(F.col(text), F.lit(separator), F.lit(""))
    padded = F.split(F.concat(F.repeat(F.lit(pad), left - 1), plain, F.repeat(F.lit(pad), right)), "")
    pieces = F.filter(F.split(text, separator), lambda p: p != "")
    labels = F.flatten(F.transform(pieces, lambda p, i: F.concat(F.array_repeat(F.lit(0), F.length(p) - 1), F.array(F.when(i == F.size(pieces) - 1, 0).otherwise(1)))))
    # Made once for each text, below the explosion.
    made = docs.select(key, F.filter(padded, lambda c: c != "").alias("p"), labels.alias("l"))
    rows = made.select(key, "p", F.posexplode("l").alias("n", "label"))
    window = lambda start, n: F.array_join(F.slice("p", start, n), "")
    return rows.select(key, "n", window(F.col("n") + 1, left).alias("before"), window(F.col("n") + left + 1, right).alias("after"), "label")


def unit_roles(units: DataFrame, prefixes: list[str], suffixes: list[str], key: list[str], by: str, col: str = "norm") -> DataFrame:
    """units with role: P for a prefix before other units of its group, S for a suffix behind others, W else."""
    w = Window.partitionBy(*key)
    i, n = F.row_number().over(w.orderBy(by)), F.count("*").over(w)
    return units.withColumn("role", F.when(F.col(col).isin(prefixes) & (i < n), "P").when(F.col(col).isin(suffixes) & (i > 1), "S").otherwise("W"))
