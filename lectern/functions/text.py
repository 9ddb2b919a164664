"""Column expressions that clean, classify and mark up text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning drops before segmentation, before normalization, and before re-binding: three sets on purpose.
STRIP_SEGMENT, STRIP_NORMALIZE, STRIP_REBIND = "[]*#%&$^~̄̅", " #*%&$‴", "*#%&$^~̄̅"
BLANKS = "[ \n\t\r]+"


def word_array(text: Column) -> Column:
    """Words between blanks, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda x: x != "")


def clean_group(text: Column) -> Column:
    """Segmentation form of a group: no tags, no strip characters, lower case; literal separators are escaped."""
    t = F.regexp_replace(text, "<[^>]*>", "")
    return F.lower(F.translate(F.translate(t, "|-", "□■"), STRIP_SEGMENT, ""))


def clean_norm(text: Column) -> Column:
    """Normalization form: brackets go only from longer forms without parentheses."""
    t = F.lower(F.translate(text, STRIP_NORMALIZE, ""))
    return F.when(~t.rlike("[()]") & (F.length(t) > 1), F.translate(t, "[]", "")).otherwise(t)


def space_punctuation(text: Column) -> Column:
    """Blanks around punctuation outside tags, an open tag reaching to the end; runs of blanks become one."""
    parts = F.regexp_extract_all(text, F.lit("<[^>]*>?|[^<]+"), F.lit(0))
    return F.regexp_replace(F.array_join(F.transform(parts, lambda x: F.when(F.startswith(x, F.lit("<")), x).otherwise(F.regexp_replace(x, "([.,:;])", " $1 "))), ""), " +", " ")


def case_class(word: Column) -> Column:
    """u all upper, t first letter upper, l all lower, d with digits, o other."""
    return (
        F.when(word.rlike("[0-9]"), "d").when((word == F.upper(word)) & (word != F.lower(word)), "u").when(word == F.lower(word), "l")
        .when((F.substring(word, 1, 1) != F.lower(F.substring(word, 1, 1))) & (F.substring(word, 2, 1 << 30) == F.lower(F.substring(word, 2, 1 << 30))), "t").otherwise("o")
    )


def all_punctuation(word: Column) -> Column:
    return word.rlike(r"^\p{P}*$")


def any_punctuation(word: Column) -> Column:
    return word.rlike(r"\p{P}")


def detect_profile(text: Column, markers: list[tuple[str, list[str]]], default: str) -> Column:
    """First profile of which a marker word stands in the text."""
    words, out = F.split(F.lower(F.replace(text, F.lit("|"), F.lit(""))), r'[ \n\t\r"_-]+'), None
    for name, own in markers:
        hit = F.arrays_overlap(words, F.array(*map(F.lit, own)))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(default)


def boundary_vector(text: Column, separator: str = " ") -> Column:
    """For each character but separators: 1 if a separator follows, else 0, as a string."""
    parts = F.filter(F.split(text, separator), lambda x: x != "")
    return F.array_join(F.transform(parts, lambda x, i: F.concat(F.repeat(F.lit("0"), F.length(x) - 1), F.when(i == F.size(parts) - 1, "0").otherwise("1"))), "")


def trim_separators(segmented: Column) -> Column:
    """No doubled, leading or trailing separators."""
    return F.regexp_replace(F.regexp_replace(segmented, r"\|+", "|"), r"^\||\|$", "")


def split_fused(segmented: Column, fused: str = "ⶑ", first: str = "⶝", second: str = "ⶳ") -> Column:
    """A fused letter before a boundary gives its second sound to the next unit."""
    t = F.replace(segmented, F.lit(fused + "|"), F.lit(first + "|" + second))
    return F.replace(t, F.lit(fused + "-"), F.lit(first + "-" + second))


def insert_paragraphs(text: Column, opener: str, mark: str) -> Column:
    """mark before the first piece and before each that begins with opener and holds the paragraph word."""
    parts = F.split(text, "\n")
    return F.array_join(F.transform(parts, lambda x, i: F.when((i == 0) | F.startswith(x, F.lit(opener)), F.concat(F.lit(mark), x)).otherwise(x)), "\n")


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered pattern rewrites."""
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def merge_features(features: Column, more: Column) -> Column:
    """+=: of maps, with the later values; sorted 'k=v' pairs."""
    return features_text(F.map_concat(F.map_filter(features, lambda k, _: ~F.array_contains(F.map_keys(more), k)), more))


def drop_features(features: Column, keys: list[str]) -> Column:
    """-=: '_' if nothing is left."""
    return features_text(F.map_filter(features, lambda k, _: ~k.isin(keys)))


def union_features(features: Column, more: Column) -> Column:
    """,=: comma lists of a key are merged, distinct and sorted."""
    both = F.map_zip_with(features, more, lambda k, a, b: F.array_join(F.array_sort(F.array_distinct(F.split(F.concat_ws(",", a, b), ","))), ","))
    return features_text(both)


def features_text(features: Column) -> Column:
    pairs = F.array_sort(F.transform(F.map_entries(features), lambda e: F.struct(F.lower(e["key"]).alias("l"), F.concat(e["key"], F.lit("="), e["value"]).alias("t"))))
    return F.when(F.size(pairs) > 0, F.array_join(F.transform(pairs, lambda p: p["t"]), "|")).otherwise("_")


def encode_capitals(text: Column, mark: str = "~") -> Column:
    """Capitals as the small letter with a mark behind it, so that case survives steps that know small letters only. A mark of the text's own is doubled."""
    t = F.regexp_replace(text, mark, mark + mark)
    letters = F.split(t, "")
    return F.array_join(F.transform(letters, lambda c: F.when((F.lower(c) != c) & (F.length(F.lower(c)) == 1), F.concat(F.lower(c), F.lit(mark))).otherwise(c)), "")


def decode_capitals(text: Column, mark: str = "~") -> Column:
    """The reverse of encode_capitals for letters that have one capital."""
    # A letter with an odd number of marks behind it was a capital; the other marks are pairs.
    parts = F.regexp_extract_all(text, F.lit(rf"(?s)[^{mark}]{mark}(?=(?:{mark}{mark})*(?:[^{mark}]|$))|{mark}{mark}|."), F.lit(0))
    one = lambda p: F.when(p == mark + mark, F.lit(mark)).when((F.length(p) == 2) & F.endswith(p, F.lit(mark)), F.upper(F.substring(p, 1, 1))).otherwise(p)
    return F.array_join(F.transform(parts, one), "")


def number_lines(text: Column, element: str = "lb") -> Column:
    """Each line with its number in a tag before it; lines of tags alone stay as they are and are not counted."""
    lines = F.split(text, "\n")
    plain = F.transform(lines, lambda x: F.when(x.rlike(r"^(\s*<[^>]*>\s*)+$"), 0).otherwise(1))
    place = lambda i: F.aggregate(F.slice(plain, 1, i + 1), F.lit(0), lambda a, x: a + x).cast("string")
    return F.array_join(F.transform(lines, lambda x, i: F.when(F.get(plain, i) == 0, x).otherwise(F.concat(F.lit(f'<{element} n="'), place(i), F.lit('"/>'), x))), "\n")
