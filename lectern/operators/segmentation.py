"""Segmentation by ordered grammar rules, and alignment of segmentations to surface forms."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import STRIP_SEGMENT, clean_group
from lectern.operators.binding import detokenize, merge_flags, merged_groups
from lectern.operators.normalization import normalize_groups
from lectern.operators.sgml import plain_groups


@dataclass(frozen=True)
class Grammar:
    """Categories: ordered lists of forms. Rules: sequences of category names; '=x' is the form x itself; a trailing '?' makes an element optional."""

    categories: dict[str, list[str]]
    rules: list[list[str]]
    _expanded: list[tuple[int, list[str]]] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        out = []
        for n, rule in enumerate(self.rules):
            options = [[]]
            for e in rule:
                options = [o + x for o in options for x in ([[e[:-1]], []] if e.endswith("?") else [[e]])]
            out += [(n, o) for o in options if o]
        object.__setattr__(self, "_expanded", out)

    def segment(self, word: str) -> tuple[int, list[str]] | None:
        """The first rule that covers the word, with its pieces; of several ways, that with the forms listed first."""
        for n, rule in self._expanded:
            dead: set[tuple[int, int]] = set()

            def match(k: int, at: int, rule=rule, dead=dead) -> list[str] | None:
                if k == len(rule):
                    return [] if at == len(word) else None
                if (k, at) in dead:
                    return None
                for form in [rule[k][1:]] if rule[k].startswith("=") else self.categories[rule[k]]:
                    if form and word.startswith(form, at) and (rest := match(k + 1, at + len(form))) is not None:
                        return [form, *rest]
                dead.add((k, at))
                return None

            if (pieces := match(0, 0)) is not None:
                return n, pieces
        return None


def grammar_segment(words: DataFrame, grammar: Grammar, col: str) -> DataFrame:
    """Adds seg ('a|b', null if no rule cuts the word) and rule. Only distinct words go through Python."""
    g = words.sparkSession.sparkContext.broadcast(grammar)

    def run(frames):
        for f in frames:
            found = [g.value.segment(w) if w else None for w in f[col]]
            f["seg"] = ["|".join(x[1]) if x and len(x[1]) > 1 else None for x in found]
            f["rule"] = [x[0] if x and len(x[1]) > 1 else None for x in found]
            f["rule"] = f["rule"].astype("Int32")
            yield f

    kind = words.schema[col].dataType.simpleString()
    types = words.select(col).distinct().mapInPandas(run, f"`{col}` {kind}, seg string, rule int")
    return words.join(types, col, "left")


def align(surface: str, segmented: str, equal: tuple[tuple[str, str], ...] = ()) -> str:
    """segmented's boundaries put into surface, by least edits; '' if they differ in more than half of their letters.

    A letter that only surface has goes behind the boundary. equal: pairs of spellings that count as the
    same, such as a ligature and its letters. Removing the
    boundaries from the result always gives surface.
    """
    plain, cuts = "", []
    for c in segmented:
        if c in "|-":
            cuts.append((len(plain), c))
        else:
            plain += c
    loose, back = surface, list(range(len(surface) + 1))
    for a, b in equal:
        while (i := loose.find(a)) >= 0 and a not in b:
            loose, back = loose[:i] + b + loose[i + len(a) :], back[:i] + [back[i]] * len(b) + back[i + len(a) :]
        plain_cut = plain
        while (i := plain_cut.find(a)) >= 0 and a not in b:
            plain_cut = plain_cut[:i] + b + plain_cut[i + len(a) :]
            cuts = [(p if p <= i else p + len(b) - len(a), c) for p, c in cuts]
        plain = plain_cut
    n, m = len(loose), len(plain)
    cost = [[max(i, j) if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (loose[i - 1] != plain[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    if cost[n][m] > max(n, m) / 2:
        return ""
    at, i, j = {}, n, m
    while i or j:
        at[j] = i
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (loose[i - 1] != plain[j - 1]):
            i, j = i - 1, j - 1
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
        else:
            j -= 1
    at.setdefault(0, 0)
    out, last = "", 0
    for p, c in cuts:
        place = back[at[p]]
        out, last = out + surface[last:place] + c, place
    return out + surface[last:]


def align_column(surface: str, segmented: str, equal: tuple[tuple[str, str], ...] = ()):
    """align, over Arrow batches; null where one of the two is null."""
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else align(x, y, equal) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.string())

    return F.arrow_udf(run, "string")(surface, segmented)


def merge_groups(groups: list[str], bound: dict[str, float], aggressive: dict[str, float] | None = None, level: int = 1, punctuation: str = ".,:;·") -> list[str]:
    """Groups joined to what follows if the table holds them bound with p >= 0.5; a merged group is tried again. Level 2 adds the aggressive table."""
    table = {k for k, p in {**(aggressive or {} if level > 1 else {}), **bound}.items() if p >= 0.5}
    out: dict[int, str] = {}
    for number, g in zip(merge_flags(groups, table, set(punctuation)), groups, strict=True):
        out[number] = out.get(number, "") + g
    return list(out.values())


def attached(dirty: str, segmented: str, strip: str, separators: str = "|-") -> str:
    """The boundaries of the segmentation of a cleaned form, put into the form before cleaning; cleaned-off characters go with what stands before them."""
    before: dict[int, str] = {}
    n = 0
    for c in segmented:
        if c in separators:
            before[n] = before.get(n, "") + c
        else:
            n += 1
    out, n = "", 0
    for c in dirty:
        if c not in strip:
            out, n = out + before.get(n, ""), n + 1
        out += c
    return out


def attach(dirty: Column, segmented: Column, strip: str, separators: str = "|-") -> Column:
    """attached, over Arrow batches; null where one of the two is null."""
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else attached(x, y, strip, separators) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.string())

    return F.arrow_udf(run, "string")(dirty, segmented)


def context_overrides(groups: DataFrame, rules: list[tuple[str, str, list[str], str]], literal: dict[str, str], substrings: list[tuple[str, str]], key: str = "doc_id", by: str = "i", col: str = "seg", separator: str = "|") -> DataFrame:
    """groups with col after overrides. rules: (segmentation, 'prev' or 'next', units, other segmentation): if the last unit before, or the first one after, is one of the units. Then whole segmentations, then parts of them."""
    w = Window.partitionBy(key).orderBy(by)
    last = F.lag(F.element_at(F.split(col, "[" + separator + "]"), -1)).over(w)
    first = F.lead(F.split(col, "[" + separator + "]")[0]).over(w)
    out = groups.withColumn("__prev", last).withColumn("__next", first)
    seg = F.col(col)
    for have, side, units, new in rules:
        seg = F.when((F.col(col) == have) & F.coalesce(F.col(f"__{side}").isin(units), F.lit(False)), new).otherwise(seg)
    if literal:
        seg = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in literal.items() for x in kv]), seg), seg)
    for find, by_ in substrings:
        seg = F.replace(seg, F.lit(find), F.lit(by_))
    return out.withColumn(col, seg).drop("__prev", "__next")


def corrected_units(groups: DataFrame, corrections: DataFrame, key: str = "doc_id", by: str = "i", col: str = "orig_group") -> DataFrame:
    """key, by, unit_idx, orig, norm, tag, lemma, lang of groups that corrections name (orig_group with its units parted by '|', norms, tags, lemmas, langs likewise; the native language is null)."""
    c = corrections.select(F.replace("orig_group", F.lit("|"), F.lit("")).alias("__k"), F.split("orig_group", "[|]").alias("origs"), *[F.split(n, "[|]").alias(n) for n in ("norms", "tags", "lemmas", "langs")])
    hit = groups.join(c, F.col(col) == F.col("__k"))
    z = hit.select(key, by, F.posexplode(F.arrays_zip("origs", "norms", "tags", "lemmas", "langs")).alias("unit_idx", "z"))
    return z.select(key, by, "unit_idx", F.col("z.origs").alias("orig"), F.col("z.norms").alias("norm"), F.col("z.tags").alias("tag"), F.col("z.lemmas").alias("lemma"), F.when(F.col("z.langs") != "Coptic", F.col("z.langs")).alias("lang"))


def lines_as_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, grp, norm: each line that isn't empty is a group of one unit."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    return docs.select(key, F.posexplode(lines).alias("grp", "norm"))


def compound_morphs(words: DataFrame, nouns: DataFrame, verbs: DataFrame, col: str = "word", least: int = 3) -> DataFrame:
    """words with morphs: 'verb-noun' where a verb of least letters or more and a noun make the word, the shortest such verb; else the word."""
    types = words.select(col).where(F.col(col).isNotNull()).distinct()
    cuts = types.select(col, F.explode(F.when(F.length(col) > least, F.sequence(F.lit(least), F.length(col) - 1)).otherwise(F.array().cast("array<int>"))).alias("n"))
    cuts = cuts.select(col, "n", F.substring(col, F.lit(1), F.col("n")).alias("__v"), F.substring(col, F.col("n") + 1, F.length(col)).alias("__n"))
    hit = cuts.join(verbs.select(F.col("form").alias("__v")).distinct(), "__v", "left_semi").join(nouns.select(F.col("form").alias("__n")).distinct(), "__n", "left_semi")
    best = hit.groupBy(col).agg(F.min_by(F.concat_ws("-", "__v", "__n"), "n").alias("__m"))
    return words.join(best, col, "left").withColumn("morphs", F.coalesce("__m", col)).drop("__m")


def stacked(words: DataFrame, col: str, table: DataFrame, grammar: Grammar, alternatives: DataFrame | None = None, classifier: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The cascade over distinct words: table, then grammar for those it lacks, then, for what is still whole or ambiguous, a classifier, held to the listed alternatives; adds seg (the word itself if nothing cuts it).

    table: norm, seg. alternatives: norm, alts. classifier: from a column of words to words with seg.
    """
    types = words.select(col).where(F.col(col).isNotNull()).distinct()
    hits = types.join(table.groupBy(F.col("norm").alias(col)).agg(F.max("seg").alias("__table")), col, "left")
    open_types = hits.where(F.col("__table").isNull() & (F.length(col) > 1)).select(col)
    ruled = grammar_segment(open_types, grammar, col).select(col, F.col("seg").alias("__rule"))
    found = hits.join(ruled, col, "left").withColumn("seg", F.coalesce("__table", "__rule", F.col(col)))
    if alternatives is not None:
        found = found.join(alternatives.select(F.col("norm").alias(col), "alts"), col, "left")
    else:
        found = found.withColumn("alts", F.lit(None).cast("array<string>"))
    if classifier is not None:
        asked = found.where((F.col("alts").isNotNull() | (F.col("seg") == F.col(col))) & (F.length(col) > 1)).select(col)
        found = found.join(classifier(asked).select(col, F.col("seg").alias("__model")), col, "left").withColumn("seg", F.coalesce("__model", "seg"))
    found = found.withColumn("seg", F.when(F.col("alts").isNull() | F.array_contains("alts", F.col("seg")), F.col("seg")).otherwise(F.col("alts")[0]))
    return words.join(found.select(col, "seg"), col, "left")


@dataclass(frozen=True)
class Stack:
    """Tables and rules of a whole analysis. All but the segmentation table and the grammar may be left out."""

    seg_table: DataFrame
    grammar: Grammar
    norm_table: DataFrame | None = None
    alternatives: DataFrame | None = None
    detok_table: DataFrame | None = None
    detok_level: int = 0
    morphs: Callable[[Column], Column] | None = None
    context_rules: tuple = ()
    literal: dict[str, str] = field(default_factory=dict)
    substrings: tuple = ()
    classifier: Callable[[DataFrame], DataFrame] | None = None
    strip: str = STRIP_SEGMENT


def analyze(docs: DataFrame, stack: Stack, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, i, dirty, norm, seg (of norm), surface_seg: groups of plain texts, merged, normalized, segmented, corrected by their neighbours, and aligned to what was written."""
    groups = docs.select(key, F.posexplode(plain_groups(F.coalesce(text, F.lit("")))).alias("i", "dirty"))
    if stack.detok_level and stack.detok_table is not None:
        clean = groups.withColumn("tok", clean_group(F.col("dirty")))
        numbered = detokenize(clean, stack.detok_table, stack.detok_level, key).select(key, "i", "grp")
        groups = merged_groups(groups.join(numbered, [key, "i"]), key, "i", "dirty").select(key, F.col("grp").alias("i"), F.col("form").alias("dirty"))
    groups = groups.withColumn("clean", clean_group(F.col("dirty")))
    groups = normalize_groups(groups, "clean", stack.norm_table) if stack.norm_table is not None else groups.withColumn("norm", F.col("clean"))
    out = stacked(groups, "norm", stack.seg_table, stack.grammar, stack.alternatives, stack.classifier)
    if stack.morphs is not None:
        out = out.withColumn("seg", F.array_join(F.transform(F.split("seg", "[|]"), stack.morphs), "|"))
    out = context_overrides(out, list(stack.context_rules), stack.literal, list(stack.substrings), key)
    forms = out.select("dirty", "clean", "seg").distinct()
    forms = forms.withColumn("surface_seg", attach(F.col("dirty"), align_column("clean", "seg"), stack.strip))
    return out.join(forms, ["dirty", "clean", "seg"], "left").select(key, "i", "dirty", "norm", "seg", "surface_seg")


def piped(groups: DataFrame, key: str = "doc_id", by: str = "i", col: str = "seg") -> DataFrame:
    """key, text: groups joined by '_', with their units parted by '|' and morphs by '-'."""
    listed = F.array_sort(F.collect_list(F.struct(by, col)))
    return groups.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: x[col]), "_").alias("text"))
