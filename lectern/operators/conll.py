"""Tokens of trees as CoNLL: numbering, text, comments, coarse tags, entity brackets, columns put in by place.

Token tables have a key, sent (from 0), id (from 1 in the sentence), form, lemma, cpos, pos, morph, head (0: root), func, deps, misc; super-tokens have upto.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Coarse tags of fine ones, and those that depend on the function.
COARSE_TAGS = {
    "AAOR": "AUX", "ACAUS": "VERB", "ACOND": "SCONJ", "ACONJ": "AUX", "ADV": "ADV", "AFUTCONJ": "AUX", "AJUS": "AUX", "ALIM": "SCONJ", "ANEGAOR": "AUX", "ANEGJUS": "AUX", "ANEGOPT": "AUX", "ANEGPST": "AUX", "ANY": "AUX", "AOPT": "AUX",
    "APREC": "SCONJ", "APST": "AUX", "ART": "DET", "CCIRC": "SCONJ", "CFOC": "PART", "CONJ": "CCONJ", "COP": "PRON", "CPRET": "AUX", "CREL": "SCONJ", "EXIST": "VERB", "FM": "X", "FUT": "AUX", "FW": "X", "IMOD": "ADV", "N": "NOUN", "NEG": "ADV",
    "NPROP": "PROPN", "NUM": "NUM", "PDEM": "DET", "PINT": "PRON", "PPERI": "PRON", "PPERO": "PRON", "PPERS": "PRON", "PPOS": "DET", "PREP": "ADP", "PTC": "PART", "PUNCT": "PUNCT", "UNKNOWN": "X", "V": "VERB", "VBD": "VERB", "VIMP": "VERB", "VSTAT": "VERB",
}
TAGS_BY_FUNCTION = {("CONJ", "mark"): "SCONJ", ("N", "amod"): "ADJ", ("PREP", "mark"): "PART", ("PINT", "advmod"): "ADV"}
# Codes of the languages that words come from.
LANGUAGE_CODES = {"Hebrew": "he", "Greek": "grc", "Latin": "la", "Egyptian": "egy", "Akkadian": "akk", "Aramaic": "arc", "Arabic": "ara", "Persian": "peo"}
COLUMNS = {10: ["id", "form", "lemma", "cpos", "pos", "morph", "head", "func", "deps", "misc"], 8: ["id", "form", "lemma", "cpos", "pos", "morph", "head", "func"]}


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def coarse_tag(tag: Column, function: Column) -> Column:
    """Coarse tag of a fine tag: some depend on the function; aux is AUX whatever the tag; tags that end in a pronoun are PRON; '_' stays."""
    by_function = _map({f"{t} {f}": v for (t, f), v in TAGS_BY_FUNCTION.items()})
    fused = tag.endswith("_PPERS") | tag.endswith("_PPERO")
    plain = F.when(fused, "PRON").when(tag == "_", "_").otherwise(F.coalesce(F.try_element_at(_map(COARSE_TAGS), tag), F.lit("")))
    special = F.try_element_at(by_function, F.concat_ws(" ", tag, function))
    return F.when(function == "aux", "AUX").otherwise(F.coalesce(special, plain))


def language_code(name: Column) -> Column:
    """Code of a language; an unknown name is an error, null stays null."""
    return F.when(name.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(F.try_element_at(_map(LANGUAGE_CODES), name), F.raise_error(F.concat(F.lit("unknown language: "), name))))


def sentence_label(number: Column) -> Column:
    """s0001, ...: at least four digits."""
    return F.format_string("s%04d", number)


def keep_features(features: Column, names: list[str]) -> Column:
    """Of 'k=v|k=v', the pairs of the names; '_' if none is left."""
    own = F.filter(F.split(F.coalesce(features, F.lit("_")), r"\|"), lambda x: F.substring_index(x, "=", 1).isin(names) & x.contains("="))
    return F.when(F.size(own) > 0, F.array_join(own, "|")).otherwise("_")


def number_tokens(units: DataFrame, ends: Column, key: str = "doc_id", by: str = "i") -> DataFrame:
    """Adds sent (from 0), id (from 1 in each sentence) and tok_id (from 1 in the text); ends: whether a unit ends its sentence."""
    w = Window.partitionBy(key).orderBy(by)
    before = F.coalesce(F.sum(ends.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    u = units.withColumn("sent", before)
    return u.withColumn("id", F.row_number().over(Window.partitionBy(key, "sent").orderBy(by))).withColumn("tok_id", F.row_number().over(w))


def sentence_arrays(texts: DataFrame, ends: Callable[[Column], Column], key: str = "doc_id", also: list[str] = ()) -> DataFrame:
    """key, the columns of also, s: the sentences of each text as an array of struct<start, words, places>."""
    t, own = _cut_into_sentences(texts, ends)
    return t.select(key, *also, own.alias("s"))


def _cut_into_sentences(texts: DataFrame, ends: Callable[[Column], Column]) -> tuple[DataFrame, Column]:
    """texts with what the array of sentences is made of, and that array.

    It has to be exploded as an expression: of a column Spark infers a filter, which it pushes below and there cuts the text anew for each sentence.
    """
    at = F.filter(F.transform("words", lambda w, i: F.when(ends(w), i + 1)), lambda x: x.isNotNull())
    t = texts.withColumn("__at", at).withColumn("__n", F.size("words"))
    start = F.filter(F.concat(F.array(F.lit(0)), "__at"), lambda s: s < F.col("__n"))  # only behind the last end there may be no word
    upto = lambda k: F.coalesce(F.get("__at", k), F.col("__n"))
    part = lambda s, k: F.struct(s.alias("start"), F.slice("words", s + 1, upto(k) - s).alias("words"), F.slice("places", s + 1, upto(k) - s).alias("places"))
    return t, F.transform(start, part)


def sentences(texts: DataFrame, ends: Callable[[Column], Column], key: str = "doc_id") -> DataFrame:
    """key, sent (from 0), start (words before it), words, places: the sentences of texts (key, words, places), none of them empty; ends: whether a word ends its sentence.

    What number_tokens says of units as rows, without windows over them.
    """
    t, own = _cut_into_sentences(texts, ends)
    cut = t.select(key, F.posexplode(own).alias("sent", "s"))
    return cut.select(key, F.col("sent").cast("long").alias("sent"), "s.start", "s.words", "s.places")


def sentence_tokens(cut: DataFrame, key: str = "doc_id", name: str = "tok") -> DataFrame:
    """key, sent, id, tok_id and the word, from sentences: one row a token."""
    t = cut.select(key, "sent", "start", F.posexplode("words").alias("id", name))
    return t.select(key, "sent", (F.col("id") + 1).alias("id"), (F.col("start") + F.col("id") + 1).alias("tok_id"), name)


def global_heads(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds tok_id if it is not there, head_tok (place of the head in the text, 0 for roots), new_sent; 'ROOT' becomes 'root'."""
    w = Window.partitionBy(key).orderBy("sent", "id")
    t = tokens if "tok_id" in tokens.columns else tokens.withColumn("tok_id", F.row_number().over(w))
    head = F.when(F.col("head") > 0, F.col("tok_id") - F.col("id") + F.col("head")).otherwise(0)
    return t.withColumn("head_tok", head).withColumn("new_sent", F.col("id") == 1).withColumn("func", F.when(F.col("func") == "ROOT", "root").otherwise(F.col("func")))


def _ordered(df: DataFrame, keys: list[str], order: list[str], value: Column, separator: str, name: str) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct(*order, value.alias("__v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["__v"]), separator).alias(name))


def token_lines(tokens: DataFrame, columns: int = 10) -> DataFrame:
    """Adds line: a token's fields parted by tabs; super-tokens have a range as id and no head; missing and empty fields are '_'."""
    def field(c: str) -> Column:
        v = F.col(c).cast("string") if c in tokens.columns else F.lit(None).cast("string")
        if c == "id" and "upto" in tokens.columns:
            v = F.when(F.col("upto").isNull(), v).otherwise(F.concat_ws("-", "id", "upto"))
        return F.when(F.coalesce(v, F.lit("")) == "", "_").otherwise(v)

    return tokens.withColumn("line", F.concat_ws("\t", *[field(c) for c in COLUMNS[columns]]))


def _token_order(tokens: DataFrame) -> list:
    return ["id", F.col("upto").isNull().alias("__word")] if "upto" in tokens.columns else ["id"]


def sentence_blocks(tokens: DataFrame, key: str = "doc_id", columns: int = 10) -> DataFrame:
    """key, sent, block: the lines of each sentence."""
    return _ordered(token_lines(tokens, columns), [key, "sent"], _token_order(tokens), F.col("line"), "\n", "block")


def surface_text(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, sent, text: forms with a blank behind each but where SpaceAfter=No; a super-token stands for its tokens, and glues as it says."""
    glued = F.coalesce(F.col("misc").contains("SpaceAfter=No"), F.lit(False))
    t = tokens.withColumn("__glued", glued)
    if "upto" not in tokens.columns:
        t = t.withColumn("upto", F.lit(None).cast("int"))
    # The range that a token lies in, if any, is that of the last super-token before it.
    w = Window.partitionBy(key, "sent").orderBy("id", F.col("upto").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("__end", F.last("upto", True).over(w)).withColumn("__super_glued", F.last(F.when(F.col("upto").isNotNull(), F.col("__glued")), True).over(w))
    inside = F.col("upto").isNull() & F.coalesce(F.col("id") <= F.col("__end"), F.lit(False))
    # A range's form comes from its super-token, the blank from its last token and the super-token together.
    blank = F.when(F.col("upto").isNotNull(), "").when(inside & (F.col("id") < F.col("__end")), "").when(F.col("__glued") | (inside & F.col("__super_glued")), "").otherwise(" ")
    piece = F.concat(F.when(inside, "").otherwise(F.col("form")), blank)
    return _ordered(t, [key, "sent"], ["id", F.col("upto").isNull().alias("__word")], piece, "", "text")


def surface_of(forms: Column, glued: Column, ranges: list[tuple[int, int]]) -> Column:
    """surface_text of one sentence of words alone, as arrays of forms and of whether each is glued to the next; ranges: of ids, from 1, that are super-tokens (not glued) of their forms, where the sentence is that long."""
    inside = lambda i: F.lit(False) if not ranges else functools.reduce(operator.or_, [(i + 1 >= a) & (i + 1 < b) & (F.size(forms) >= b) for a, b in ranges])
    return F.array_join(F.transform(forms, lambda f, i: F.when(inside(i) | F.get(glued, i), f).otherwise(F.concat(f, F.lit(" ")))), "")


def comment_lines(meta: Column) -> Column:
    """'# k = v' lines of a map: newdoc id, global.*, meta::*, sent_id, all others by name, text last."""
    # Made of the map's entries once: a map looked up by each of its keys would be made again for each.
    rank = lambda k: F.when(k == "newdoc id", 0).when(k.startswith("global."), 1).when(k.startswith("meta::"), 2).when(k == "sent_id", 3).when(k == "text", 5).otherwise(4)
    entries = F.array_sort(F.transform(F.map_entries(meta), lambda e: F.struct(rank(e["key"]).alias("r"), e["key"].alias("k"), F.trim(e["value"]).alias("v"))))
    line = lambda e: F.when(e["v"] == "", F.concat(F.lit("# "), F.trim(e["k"]))).otherwise(F.concat(F.lit("# "), F.trim(e["k"]), F.lit(" = "), e["v"]))
    return F.array_join(F.transform(entries, line), "\n")


def document_text(sentences: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text: sentences (sent, block, meta) with their comments, a blank line behind each."""
    block = F.concat(F.when(F.size("meta") > 0, F.concat(comment_lines(F.col("meta")), F.lit("\n"))).otherwise(""), F.col("block"), F.lit("\n\n"))
    return _ordered(sentences, [key], ["sent"], block, "", "text")


def latest_blocks(sentences: DataFrame, key: str = "doc_id") -> DataFrame:
    """form_text, block: of sentences (key, sent, form_text, block) with equal texts the last counts."""
    return sentences.groupBy("form_text").agg(F.max_by("block", F.struct(key, "sent")).alias("block"))


def sentence_map(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """form_text of each sentence with its stripped rows: features, enhanced edges and misc blank, coarse tag as the fine one. Of equal texts the last sentence counts."""
    bare = tokens.withColumn("cpos", F.col("pos")).withColumn("morph", F.lit("_")).withColumn("deps", F.lit("_")).withColumn("misc", F.lit("_"))
    s = sentence_blocks(bare, key).join(_ordered(tokens, [key, "sent"], ["id"], F.col("form"), " ", "form_text"), [key, "sent"])
    return latest_blocks(s, key)


def replace_trees(sentences: DataFrame, gold: DataFrame) -> DataFrame:
    """sentences: form_text, block. Blocks of gold (form_text, block) take the place of those with the same text; adds from_gold."""
    g = gold.select("form_text", F.col("block").alias("__gold"))
    out = sentences.join(g, "form_text", "left")
    return out.withColumn("from_gold", F.col("__gold").isNotNull()).withColumn("block", F.coalesce("__gold", "block")).drop("__gold")


def token_count_mismatches(parsed: DataFrame, tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_parsed, n_tokens, message: documents whose parse has another number of tokens than the text."""
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    both = count(parsed, "n_parsed").join(count(tokens, "n_tokens"), key, "full_outer").na.fill(0, ["n_parsed", "n_tokens"])
    message = F.format_string("parse has %d tokens, text has %d", "n_parsed", "n_tokens")
    return both.where("n_parsed != n_tokens").withColumn("message", message)


def inject_by_place(target: DataFrame, source: DataFrame, column: str, key: str = "doc_id", order: tuple[str, ...] = ("sent", "id")) -> DataFrame:
    """The column of target taken from source's rows, one by one in order; super-tokens of target (upto) are passed over."""
    w = Window.partitionBy(key).orderBy(*order)
    s = source.withColumn("__n", F.row_number().over(w)).select(key, "__n", F.col(column).alias("__new"))
    word = F.col("upto").isNull() if "upto" in target.columns else F.lit(True)
    ordered = Window.partitionBy(key).orderBy(*order, word).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = target.withColumn("__n", F.when(word, F.sum(word.cast("int")).over(ordered)))
    return t.join(s, [key, "__n"], "left").withColumn(column, F.coalesce("__new", column)).drop("__n", "__new")


def inject_by_order(target: Column, source: Column, *names: str) -> Column:
    """inject_by_place within one text: target and source are arrays of structs in order; gives target's words (super-tokens, with upto, are passed over and left out) with the named fields of source's, where it has them."""
    words = F.filter(target, lambda t: t["upto"].isNull())
    put = lambda t, s: functools.reduce(lambda x, n: x.withField(n, F.coalesce(s[n], t[n])), names, t)
    # A source that is longer than the words has nothing to go to.
    return F.filter(F.zip_with(words, source, put), lambda t: t["id"].isNotNull())


def ordered_edges(deps: Column) -> Column:
    """Enhanced edges 'head:label|...' by head; of those to one head the longest label stays (of equals the later by name); '_' for none."""
    parts = F.filter(F.split(F.coalesce(deps, F.lit("_")), r"\|"), lambda p: p.contains(":"))
    edges = F.transform(parts, lambda p: F.struct(F.substring_index(p, ":", 1).cast("double").alias("h"), F.length(p).alias("n"), p.alias("p")))
    # An array of one binds the sorted edges, which each of them looks at.
    text = lambda o: F.when(F.size(o) > 0, F.array_join(F.transform(F.filter(o, lambda e, i: (i == F.size(o) - 1) | (F.get(o, i + 1)["h"] != e["h"])), lambda e: e["p"]), "|")).otherwise("_")
    return F.transform(F.array(F.array_sort(edges)), text)[0]


def entity_brackets(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, tok, entity: what the tokens (from 1 in the text) show of spans (key, st, en, etype): '(type', 'type)', '(type)', the longest opener first, the closer of the span opened last first."""
    length = F.col("en") - F.col("st")
    part = lambda tok, k, o, *t: F.struct(F.col(tok).alias("tok"), F.struct(F.lit(k).alias("k"), o.cast("int").alias("o"), F.concat(*t).alias("t")).alias("x"))
    both = F.array(part("st", 1, -length, F.lit("("), "etype"), part("en", 3, length, "etype", F.lit(")")))
    parts = spans.where("st <= en").select(key, F.explode(F.when(length == 0, F.array(part("st", 2, F.lit(0), F.lit("("), "etype", F.lit(")")))).otherwise(both)).alias("y")).select(key, "y.tok", "y.x")
    return parts.groupBy(key, "tok").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("entity"))


def entities_of_brackets(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, st, en, etype of tokens (key, tok, entity): brackets of one type are paired by their depth. What has no partner is left out."""
    pieces = F.regexp_extract_all("entity", F.lit(r"\([^()]+\)|\([^()]+|[^()]+\)"), F.lit(0))
    e = tokens.select(key, "tok", F.posexplode(pieces).alias("k", "p")).withColumn("etype", F.translate("p", "()", ""))
    # A bracket that opens and closes changes no depth, and is a pair of its own.
    e = e.withColumn("up", F.when(~F.col("p").startswith("("), -1).when(F.col("p").endswith(")"), 0).otherwise(1))
    w = Window.partitionBy(key, "etype").orderBy("tok", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("depth", F.sum("up").over(w) + F.when(F.col("up") == -1, 1).otherwise(0))
    e = e.withColumn("nth", F.row_number().over(Window.partitionBy(key, "etype", "depth", "up").orderBy("tok", "k")))
    own = lambda *ups: F.max(F.when(F.col("up").isin(*ups), F.col("tok")))
    pairs = e.groupBy(key, "etype", "depth", "nth", (F.col("up") == 0).alias("alone")).agg(own(0, 1).alias("st"), own(0, -1).alias("en"))
    return pairs.where("st <= en").select(key, "st", "en", "etype")


def entity_properties(spans: DataFrame, tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """spans with text (lemmas), rawtext (forms), length, head: the first token governed from outside. tokens: key, tok, form, lemma, head_tok."""
    inside = spans.withColumn("tok", F.explode(F.sequence("st", "en"))).join(tokens, [key, "tok"])
    outside = ~F.col("head_tok").between(F.col("st"), F.col("en"))
    listed = F.array_sort(F.collect_list(F.struct("tok", "form", "lemma")))
    out = inside.groupBy(key, "st", "en", "etype").agg(listed.alias("l"), F.min(F.when(outside, F.col("tok"))).alias("head"))
    joined = lambda f: F.array_join(F.transform("l", lambda x: x[f]), " ")
    return out.select(key, "st", "en", "etype", joined("lemma").alias("text"), joined("form").alias("rawtext"), F.size("l").alias("length"), F.coalesce("head", "st").alias("head"))


def document_names(text: Column) -> Column:
    """Names that '# newdoc id = ...' lines give."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^# ?newdoc id ?= ?(.+)$"), F.lit(1)), lambda x: F.trim(x))


def universal_rows(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """tokens with pos, func, morphs ('a-b'), orig, lang and entity as Universal Dependencies rows: cpos from pos and func; misc = sorted Entity, Morphs, Orig, OrigLang and SpaceAfter where they say something.

    Groups (column grp) of several tokens get a super-token row before their first.
    """
    pairs = F.array_compact(F.array(
        F.when(F.col("entity").isNotNull(), F.concat(F.lit("Entity="), "entity")),
        F.when(F.col("morphs").contains("-"), F.concat(F.lit("Morphs="), "morphs")),
        F.when(F.col("orig") != F.col("form"), F.concat(F.lit("Orig="), "orig")),
        F.when(F.col("lang").isNotNull(), F.concat(F.lit("OrigLang="), language_code(F.col("lang")))),
    ))
    t = tokens.withColumn("cpos", coarse_tag(F.col("pos"), F.col("func"))).withColumn("misc", F.when(F.size(pairs) > 0, F.array_join(F.array_sort(pairs), "|")).otherwise("_"))
    t = t.select(key, "sent", "id", F.lit(None).cast("int").alias("upto"), "form", "lemma", "cpos", "pos", "head", "func", "misc", "grp")
    fused = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "form"))), lambda x: x["form"]), "")
    blank = [F.lit("_").alias(c) for c in ("lemma", "cpos", "pos")]
    s = t.groupBy(key, "sent", "grp").agg(F.min("id").alias("id"), F.max("id").alias("upto"), fused.alias("form")).where("upto > id")
    s = s.select(key, "sent", "id", "upto", "form", *blank, F.lit(None).cast("int").alias("head"), F.lit("_").alias("func"), F.lit("_").alias("misc"), "grp")
    return t.unionByName(s).drop("grp")
