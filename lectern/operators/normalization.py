"""Normal forms of groups: tables of attested forms, a transducer of lexicon categories, ordered rewrites; and how lexicons are derived.

All work is on distinct forms; what comes out is joined back.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import clean_norm, rewrite
from lectern.operators.lexicon import majority

# Letters between and behind which punctuation is no part of a word, and groups that are never normalized.
LETTERS = "ⲁⲃⲅⲇⲉⲍⲏⲑⲓⲕⲗⲙⲛⲥⲟⲡⲝⲣⲧⲩⲱⲯϭϣϩϥϯ"
FORBIDDEN = ["ⲉⲓⲁⲕⲱⲃ", "ⲉⲝⲉⲥⲧⲓ", "ⲉⲧⲛⲁⲛⲁⲩ", "ⲛⲙⲙⲉ", "ⲁⲩⲃⲱⲕ", "ⲙⲙⲉ", "ϫⲟⲕϥ"]
# Marks that go before a form is looked up a second time, and the order of known rewrites of whole words and endings.
MARKS = "|[]̂`̣᷍"
REWRITES = [
    ("(^|_)ⲓⲏⲗ($|_)", "$1ⲓⲥⲣⲁⲏⲗ$2"), ("(^|_)ⲓⲏ?ⲥ($|_)", "$1ⲓⲏⲥⲟⲩⲥ$2"), ("(^|_)ϫⲟⲓⲥ($|_)", "$1ϫⲟⲉⲓⲥ$2"), ("ⲭⲣ?ⲥ($|_)", "ⲭⲣⲓⲥⲧⲟⲥ$1"), ("ⲡⲛⲓⲕⲟ([ⲛⲥ]($|_))", "ⲡⲛⲉⲩⲙⲁⲧⲓⲕⲟ$1"),
    ("(^|_)ϯⲟⲩⲇⲁⲓⲁ($|_)", "$1ⲧⲓⲟⲩⲇⲁⲓⲁ$2"), ("(^|_)ⲡⲛⲁ($|_)", "$1ⲡⲛⲉⲩⲙⲁ$2"), ("(^|_)ⲃⲁⲍⲁⲛⲓⲍⲉ($|_)", "$1ⲃⲁⲥⲁⲛⲓⲍⲉ$2"), ("(^|_)ⲃⲁⲍⲁⲛⲟⲥ($|_)", "$1ⲃⲁⲥⲁⲛⲟⲥ$2"),
    ("(^|_)ϩⲓⲗⲏⲙ($|_)", "$1ϩⲓⲉⲣⲟⲩⲥⲁⲗⲏⲙ$2"), ("(^|_)ⲥ[ⳁⲣ]ⲟⲥ($|_)", "$1ⲥⲧⲁⲩⲣⲟⲥ$2"), ("(^|_)ⲕⲗⲏⲣⲟⲛⲟⲙⲓ($|_)", "$1ⲕⲗⲏⲣⲟⲛⲟⲙⲉⲓ$2"), ("(^|_)ⲓⲱⲧ($|_)", "$1ⲉⲓⲱⲧ$2"),
    ("(^|_)ⲓⲟⲧⲉ($|_)", "$1ⲉⲓⲟⲧⲉ$2"), ("(^|_)ϩⲣⲁⲉⲓ($|_)", "$1ϩⲣⲁⲓ$2"), ("(^|_)ⲡⲏⲟⲩⲉ($|_)", "$1ⲡⲏⲩⲉ$2"), ("(^|_)ϩⲃⲏⲟⲩⲉ($|_)", "$1ϩⲃⲏⲩⲉ$2"), ("(^|_)ⲓⲉⲣⲟⲥⲟⲗⲩⲙⲁ($|_)", "$1ϩⲓⲉⲣⲟⲩⲥⲁⲗⲏⲙ$2"),
    ("ⲑⲓⲗⲏⲙ($|_)", "ⲧϩⲓⲉⲣⲟⲩⲥⲁⲗⲏⲙ$1"), ("ⲙⲟⲛⲟⲭⲟⲥ($|_)", "ⲙⲟⲛⲁⲭⲟⲥ$1"), ("(^|_)ⲡⲓⲑⲉ($|_)", "$1ⲡⲉⲓⲑⲉ$2"), ("(^|_)ⲡⲣⲟⲥⲕⲁⲣⲧⲉⲣⲓ($|_)", "$1ⲡⲣⲟⲥⲕⲁⲣⲧⲉⲣⲓⲁ$2"),
    ("(^|[_ ]|ϫⲉ)ⲙⲡⲁⲧⲉ([ⲕϥⲥⲛ][^_ ]*)($|_)", "$1ⲙⲡⲁⲧ$2$3"), ("(^|[_ ]|ϫⲉ)ⲙⲡⲁϯ([^_ ]+)($|_)", "$1ⲙⲡⲁⲧⲓ$2$3"), ("ⲉⲑⲟⲟⲩ($|_)", "ⲉⲧϩⲟⲟⲩ$1"),
]


def without_inner_punctuation(form: Column, letters: str = LETTERS) -> Column:
    """Points and squares between letters, and squares behind one, go."""
    # Twice, as neighbours share a letter.
    between = lambda c: F.regexp_replace(c, f"([{letters}])[·.□]([{letters}])", "$1$2")
    return F.regexp_replace(between(between(form)), f"([{letters}])□+", "$1")


class CategoryTransducer:
    """Original forms to normal ones: categories of pairs, and the sequences of categories that make a group."""

    def __init__(self, lexicon: list[tuple[str, str, str]], sequences: list[str], pairwise: bool = False):
        """lexicon: (category, original, normal). sequences: 'a+b+c'. pairwise: any chain of neighbours that some sequence has, as continuation classes allow."""
        self.forms: dict[str, dict[str, list[str]]] = {}
        for category, orig, norm in lexicon:
            own = self.forms.setdefault(category, {}).setdefault(orig, [])
            if norm not in own:
                own.append(norm)
        self.lengths = {c: sorted({len(f) for f in forms}, reverse=True) for c, forms in self.forms.items()}
        self.next: dict[object, list[tuple[str, object]]] = {}
        self.final: set = set()
        # Longer sequences first, as theirs come first among equals.
        for parts in sorted((s.split("+") for s in dict.fromkeys(sequences)), key=lambda p: -len(p)):
            state: object = ()
            for category in parts:
                to: object = (category,) if pairwise else (*state, category)
                if (category, to) not in self.next.setdefault(state, []):
                    self.next[state].append((category, to))
                state = to
            self.final.add(state)

    def analyses(self, word: str) -> list[str]:
        """All normal forms of the word, each once, in the order of sequences and lexicon."""
        known: dict[tuple, list[str]] = {}

        def rest(state, at: int) -> list[str]:
            key = state, at
            if key not in known:
                known[key] = [""] if at == len(word) and state in self.final else []
                out = list(known[key])
                for category, to in self.next.get(state, []):
                    for n in self.lengths.get(category, []):
                        for norm in self.forms[category].get(word[at : at + n], []) if n and at + n <= len(word) else []:
                            out += [norm + tail for tail in rest(to, at + n)]
                known[key] = list(dict.fromkeys(out))
            return known[key]

        return rest((), 0) if word else []

    def normalize(self, word: str, unknown: str | None = None) -> str:
        """The word itself if that is one of its analyses, else the longest analysis (of equals the first), else unknown (default: the word)."""
        found = self.analyses(word)
        if not found:
            return word if unknown is None else unknown
        return word if word in found else max(found, key=len)


def parse_category_grammar(text: str) -> list[str]:
    """Sequences 'a+b+c', one a line; '#' begins comments."""
    return [line.strip() for line in text.splitlines() if line.strip() and not line.startswith("#")]


def parse_category_lexicon(text: str) -> tuple[list[tuple[str, str, str]], list[str]]:
    """(category, original, normal) rows, and the lines that are left out: those with patterns or blanks in them."""
    kept, left = [], []
    for line in text.splitlines():
        columns = line.split("\t")
        if len(columns) != 3 or "(" in line or "." in line or " " in columns[1] + columns[2]:
            left += [line] if line.strip() else []
        else:
            kept.append(tuple(columns))
    return kept, left


def without_context(form: Column) -> Column:
    """Forms without their parenthesised contexts."""
    return F.regexp_replace(form, r"\([^()]*\)", "")


def transduce(words: DataFrame, col: str, transducer: CategoryTransducer, out: str, unknown: str | None = None) -> DataFrame:
    """Distinct words (null: none) with their normal form."""
    t = words.sparkSession.sparkContext.broadcast(transducer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = [t.value.normalize(w, unknown) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(norms, pa.string())], [col, out])

    return words.select(col).where(F.col(col).isNotNull()).distinct().mapInArrow(run, f"`{col}` string, `{out}` string")


def normalize_groups(
    groups: DataFrame, col: str, table: DataFrame, forbidden: list[str] = FORBIDDEN, rewrites: list[tuple[str, str]] = REWRITES, transducer: CategoryTransducer | None = None, letters: str = LETTERS,
) -> DataFrame:
    """groups with norm.

    The cleaned form, if it is forbidden to change it; else what table (orig, norm; rows are votes, the first of
    equals by line wins) says of it; else, without marks and inner punctuation, what the table says of that, or
    the transducer, and the rewrites in order. Null stays null.
    """
    votes = majority(table.select(clean_norm(F.col("orig")).alias("orig"), clean_norm(F.col("norm")).alias("norm"), "line"), "orig", "norm", "line").select("orig", "norm")
    types = groups.select(col).where(F.col(col).isNotNull()).distinct().withColumn("__clean", clean_norm(F.col(col)))
    types = types.withColumn("__bare", without_inner_punctuation(F.translate(F.replace("__clean", F.lit("⳯"), F.lit("ⲛ")), MARKS, ""), letters))
    for key, name in (("__clean", "__hit"), ("__bare", "__second")):
        types = types.join(votes.select(F.col("orig").alias(key), F.col("norm").alias(name)), key, "left")
    if transducer:
        types = types.join(transduce(types.where("__hit IS NULL AND __second IS NULL"), "__bare", transducer, "__third"), "__bare", "left")
    else:
        types = types.withColumn("__third", F.lit(None).cast("string"))
    rest = rewrite(F.coalesce("__second", "__third", "__bare"), rewrites)
    norm = F.when(F.col("__clean").isin(forbidden), F.col("__clean")).otherwise(F.coalesce("__hit", rest))
    return groups.join(types.select(col, norm.alias("norm")), col, "left")


# Lexicon derivation. A class is a table of form, norm.


def as_class(words: DataFrame, col: str) -> DataFrame:
    return words.select(F.col(col).alias("form"), F.col(col).alias("norm")).where("form IS NOT NULL").distinct()


def without(rows: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows whose form no other class has."""
    return reduce(lambda left, o: left.join(o.select("form").distinct(), "form", "left_anti"), others, rows)


def with_variants(into: DataFrame, source: DataFrame, find: str, by: str, *exclude: DataFrame) -> DataFrame:
    """into and the forms of source that the replacement changes, unless another class has the new form; forms that are there keep their norm."""
    new = source.select(F.regexp_replace("form", find, by).alias("form"), "norm", F.col("form").alias("__old")).where("form != __old").drop("__old")
    new = without(new.groupBy("form").agg(F.min("norm").alias("norm")), into, *exclude)
    return into.unionByName(new)


def loan_genders(nouns: DataFrame, feminine_endings: tuple[str, ...] = ("ⲁ", "ⲏ", "ⲥⲓⲥ")) -> DataFrame:
    """Adds gender: of loans (loan) f by their ending, of all others m, unless known_f says so; native verbs have none (null)."""
    ending = reduce(lambda a, b: a | b, [F.endswith("form", F.lit(e)) for e in feminine_endings])
    return nouns.withColumn("gender", F.when(F.col("known_f"), "f").when(F.col("loan"), F.when(ending, "f").otherwise("m")).when(~F.col("verb"), "m"))


def derived_nouns(verbs: DataFrame, prefix: str, loans: DataFrame, norm_prefix: str | None = None) -> DataFrame:
    """prefix + each native verb that doesn't begin with it."""
    own = without(verbs, loans).where(~F.startswith("form", F.lit(prefix)))
    return own.select(F.concat(F.lit(prefix), "form").alias("form"), F.concat(F.lit(norm_prefix or prefix), "norm").alias("norm"))


def without_initial(rows: DataFrame, letter: str) -> DataFrame:
    """Rows whose form begins with the letter, without it."""
    return rows.where(F.startswith("form", F.lit(letter))).select(F.expr("substring(form, 2)").alias("form"), "norm")


def promoted(rows: DataFrame, attested: DataFrame, skip: list[tuple[str, str]] = (), forbidden: list[str] = (), initial: str = "ϩ") -> DataFrame:
    """rows and the attested pairs (orig, norm) whose norm the class has and whose orig it lacks; not pairs to skip, nor those whose norm alone begins with initial."""
    pairs = attested.where(~(F.startswith("norm", F.lit(initial)) & ~F.startswith("orig", F.lit(initial)))).where(~F.col("norm").isin(list(forbidden)) if forbidden else F.lit(True))
    for orig, norm in skip:
        pairs = pairs.where(~((F.col("orig") == orig) & (F.col("norm") == norm)))
    hit = pairs.join(rows.select(F.col("form").alias("norm")).distinct(), "norm", "left_semi").groupBy(F.col("orig").alias("form")).agg(F.max("norm").alias("norm"))
    return rows.unionByName(without(hit, rows))


def initial_class(rows: DataFrame, pattern: str) -> DataFrame:
    """Rows whose form begins as the pattern says: clusters, labials, single letters."""
    return rows.where(F.col("form").rlike(f"^(?:{pattern})"))


def lexicon_rows(classes: dict[str, DataFrame], never: list[str] = ()) -> DataFrame:
    """category, orig, norm of all classes, without forms that have blanks or hyphens or are never to be normalized."""
    parts = [rows.select(F.lit(name).alias("category"), F.col("form").alias("orig"), "norm") for name, rows in classes.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.where(~F.concat("orig", "norm").rlike("[ -]") & (~F.col("orig").isin(list(never)) if never else F.lit(True)))
