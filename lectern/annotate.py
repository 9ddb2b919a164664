"""The whole annotation of documents in one call: options say what is wanted, tables and annotators how it is made."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import insert_paragraphs, space_punctuation
from lectern.operators import conll as C
from lectern.operators import entities as N
from lectern.operators import lexicon as L
from lectern.operators import sgml as G
from lectern.operators import trees as Y
from lectern.operators.models import Registry, chain_parser
from lectern.operators.segmentation import Stack, analyze, lines_as_units, piped
from lectern.plans.durable import checkpointed
from lectern.sources import formats as S

OUTMODES = ("pipes", "sgml", "conllu")


@dataclass(frozen=True)
class Options:
    """What an annotation is to have. Names of annotators are those of the registry."""

    outmode: str = "sgml"
    tag: bool = False
    lemma: bool = False
    etym: bool = False
    multiword: bool = False
    sent: bool = True
    parse: bool = False
    recognize_entities: bool = False
    identities: bool = False
    old_testament: bool = False
    space: bool = False
    para: bool = False
    from_pipes: bool = False
    no_tok: bool = False
    merge_parse: bool = False
    pos_spans: bool = False
    meta: bool = False
    processing_meta: bool = False
    tagger: str = "lexicon"
    parser: str = "chain"

    def implied(self) -> Options:
        """With what the chosen options need: identities need entities, these a parse, this tags; a parse that is merged keeps tags as spans and what is segmented already."""
        if self.outmode not in OUTMODES:
            raise ValueError(f"unknown outmode {self.outmode!r}; there are {OUTMODES}")
        o = replace(self, recognize_entities=self.recognize_entities or self.identities)
        o = replace(o, parse=o.parse or o.recognize_entities or o.merge_parse, pos_spans=o.pos_spans or o.merge_parse)
        return replace(o, tag=o.tag or o.parse or o.lemma or o.etym, from_pipes=o.from_pipes or o.merge_parse)


def options_from(parameters: dict[str, str]) -> Options:
    """Options of a form or query string: names as in Options, flags as 1, true, on or yes. Unknown names are errors."""
    known = {f.name: f for f in fields(Options)}
    if unknown := sorted(set(parameters) - set(known)):
        raise ValueError(f"unknown options: {unknown}")
    flag = lambda v: str(v).lower() in ("1", "true", "on", "yes")
    return Options(**{k: v if known[k].type == "str" else flag(v) for k, v in parameters.items()}).implied()


@dataclass(frozen=True)
class Tables:
    """Lexicons; what is not given is not done."""

    stack: Stack | None = None
    lemmas: DataFrame | None = None
    tag_fixes: DataFrame | None = None
    origins: DataFrame | None = None
    phrases: DataFrame | None = None
    gazetteer: DataFrame | None = None
    identities: DataFrame | None = None
    overrides: DataFrame | None = None
    tree_rules: list[Y.Rule] = field(default_factory=list)


def _units(docs: DataFrame, o: Options, t: Tables) -> DataFrame:
    """doc_id, grp, unit_idx, norm, morphs, orig."""
    if o.from_pipes:
        u = S.parse_piped(docs)
        return u.select("doc_id", "grp", "unit_idx", "norm", F.array_join("morphs", "-").alias("morphs"), F.col("norm").alias("orig"))
    if o.no_tok:
        u = lines_as_units(docs)
        return u.select("doc_id", "grp", F.lit(0).alias("unit_idx"), "norm", F.col("norm").alias("morphs"), F.col("norm").alias("orig"))
    if t.stack is None:
        raise ValueError("segmentation needs a stack of tables")
    text = F.coalesce("text", F.lit(""))
    if o.space:
        text = space_punctuation(text)
    if o.para:
        text = insert_paragraphs(text, "<trans", '<p p="p"/>')
    g = analyze(docs.select("doc_id", text.alias("text")), t.stack)
    pieces = F.arrays_zip(F.split("seg", "[|]").alias("m"), F.split("surface_seg", "[|]").alias("o"))
    u = g.select("doc_id", F.col("i").alias("grp"), F.posexplode(pieces).alias("unit_idx", "z"))
    return u.select("doc_id", "grp", "unit_idx", F.replace("z.m", F.lit("-"), F.lit("")).alias("norm"), F.col("z.m").alias("morphs"), F.coalesce("z.o", "z.m").alias("orig"))


def annotate_units(docs: DataFrame, options: Options, tables: Tables, registry: Registry | None = None) -> DataFrame:
    """One row a unit of docs (doc_id, text): doc_id, grp, unit_idx, tok_id, sent, id, norm, morphs, orig, and what the options ask for: tag, lemma, lang, head, func, morph, misc."""
    o, registry = options.implied(), registry or Registry().add(chain_parser())
    u = _units(docs, o, tables)
    u = u.withColumn("__at", F.struct("grp", "unit_idx"))
    if o.tag:
        u = registry.get("tagger", o.tagger).run(u.withColumn("word", F.col("norm")))
        if tables.tag_fixes is not None:
            u = L.fix_tags(u, tables.tag_fixes).drop("tag").withColumnRenamed("new_tag", "tag")
        if o.lemma and tables.lemmas is not None:
            u = L.lemmatize(u, tables.lemmas)
            u = u.withColumn("lemma", F.when(F.col("lemma") == "UNKNOWN", F.col("norm")).otherwise(F.col("lemma")))
        if o.etym and tables.origins is not None:
            u = L.origin(u, tables.origins).withColumnRenamed("origin", "lang")
        u = u.drop("word")
    ends = (F.col("tag") == "PUNCT") | F.endswith("norm", F.lit(".")) if o.tag else F.endswith("norm", F.lit("."))
    u = C.number_tokens(u, ends if o.sent else F.lit(False), "doc_id", "__at").drop("__at")
    if o.parse:
        u = registry.get("parser", o.parser).run(u)
        if tables.tree_rules:
            t = u.select("doc_id", "sent", "id", F.col("norm").alias("form"), (F.col("lemma") if "lemma" in u.columns else F.col("norm")).alias("lemma"), F.col("tag").alias("pos"), C.coarse_tag(F.col("tag"), F.col("func")).alias("cpos"), F.lit("_").alias("morph"), "head", "func", F.lit("_").alias("misc"))
            done = Y.without_super_tokens(Y.rewrite_trees(t, tables.tree_rules, ["doc_id", "sent"])).select("doc_id", "sent", "id", "head", "func", "morph", "misc", F.col("pos").alias("tag"))
            u = u.drop("head", "func", "tag").join(done, ["doc_id", "sent", "id"])
    return u


def entity_spans(units: DataFrame, options: Options, tables: Tables) -> DataFrame:
    """doc_id, st, en, etype, head_tok, link of the entities that the gazetteer finds in units with a parse."""
    t = C.global_heads(units.drop("tok_id")).select("doc_id", F.col("tok_id").alias("tok"), F.col("norm").alias("form"), F.col("tag").alias("pos"), "func", F.col("head_tok"))
    spans = N.entity_heads(N.gazetteer_entities(t, tables.gazetteer), t)
    if not options.identities or tables.identities is None:
        return spans.withColumn("link", F.lit(None).cast("string"))
    words = t.select("doc_id", F.col("tok").alias("head_tok"), F.col("form").alias("head"), F.col("pos").alias("head_pos"))
    inside = spans.join(t.select("doc_id", "tok", "form"), "doc_id").where("tok BETWEEN st AND en")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tok", "form"))), lambda x: x["form"]), " ")
    m = inside.groupBy("doc_id", "st", "en", "etype", "head_tok").agg(listed.alias("text")).join(words, ["doc_id", "head_tok"])
    m = m.withColumn("id", F.struct("doc_id", "st", "en", "etype")).withColumn("place", F.col("doc_id").cast("string"))
    overrides = tables.overrides if tables.overrides is not None else units.sparkSession.createDataFrame([], "doc_key string, text string, etype string, link string, line int")
    linked = N.link_identities(m, N.usable_links(tables.identities, options.old_testament), overrides)
    return linked.select("doc_id", "st", "en", "etype", "head_tok", "link")


def _sgml(units: DataFrame, o: Options, spans: DataFrame | None, multiword: DataFrame | None) -> DataFrame:
    names = [n for n in ("pos", "lemma", "lang", "func", "head") if n in units.columns or n == "pos" and "tag" in units.columns]
    value = {n: F.col("tag" if n == "pos" else n) for n in names}
    if "head" in value:
        value["head"] = F.when(F.col("head") > 0, F.concat(F.lit("#u"), F.col("tok_id") - F.col("id") + F.col("head")))
    pairs = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in {"xml:id": F.concat(F.lit("u"), "tok_id"), "norm": F.col("norm"), "orig": F.col("orig"), **value}.items()]), lambda p: p["value"].isNotNull())
    none, no_text = F.lit(None).cast("map<string,string>"), F.lit(None).cast("string")
    line = lambda n, kind, tag, attrs=none, text=no_text: F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), F.lit(tag).alias("tag"), attrs.alias("attrs"), text.alias("text"))
    own = units.select("doc_id", "grp", "unit_idx", F.explode(F.array(line(1, "open", "norm", F.map_from_entries(pairs)), line(2, "token", None, none, F.col("orig")), line(3, "close", "norm"))).alias("l"))
    groups = units.groupBy("doc_id", "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_idx", "norm"))), lambda x: x["norm"]), "").alias("g"), F.max("unit_idx").alias("last"))
    head = groups.select("doc_id", "grp", F.lit(-1).alias("unit_idx"), line(0, "open", "norm_group", F.create_map(F.lit("norm_group"), F.col("g"))).alias("l"))
    tail = groups.select("doc_id", "grp", (F.col("last") + 1).alias("unit_idx"), line(4, "close", "norm_group").alias("l"))
    lines = own.unionByName(head).unionByName(tail)
    e = lines.withColumn("line_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("grp", "unit_idx", "l.n")) - 1).select("doc_id", "line_no", "l.kind", "l.tag", "l.attrs", "l.text")
    for s in (multiword, spans):
        if s is not None:
            e = G.wrap_spans(e, s, "norm")
    if o.meta or o.processing_meta:
        facts = G.processing_metadata(parsing="automatic" if o.parse else None, entities="automatic" if o.recognize_entities else None) if o.processing_meta else F.create_map().cast("map<string,string>")
        e = G.with_metadata(e, facts)
    return G.event_text(e)


def annotate(docs: DataFrame, options: Options, tables: Tables, registry: Registry | None = None) -> DataFrame:
    """doc_id, text: every document of docs (doc_id, text) in the wanted form. Documents without a unit are left out."""
    o = options.implied()
    u = checkpointed(annotate_units(docs, o, tables, registry))  # it is used several times
    if o.outmode == "pipes":
        g = u.groupBy("doc_id", "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_idx", "morphs"))), lambda x: x["morphs"]), "|").alias("seg"))
        return piped(g, "doc_id", "grp")
    spans = checkpointed(entity_spans(u, o, tables)) if o.recognize_entities and tables.gazetteer is not None else None
    if o.outmode == "conllu":
        t = u.select("doc_id", "sent", "id", "tok_id", F.col("norm").alias("form"), *[F.col(a).alias(b) for a, b in (("lemma", "lemma"), ("tag", "pos"), ("head", "head"), ("func", "func"), ("morph", "morph")) if a in u.columns])
        if "pos" in t.columns:
            t = t.withColumn("cpos", C.coarse_tag(F.col("pos"), F.col("func") if "func" in t.columns else F.lit("")))
        if spans is not None:
            brackets = C.entity_brackets(spans).select("doc_id", F.col("tok").alias("tok_id"), F.concat(F.lit("Entity="), "entity").alias("misc"))
            t = t.join(brackets, ["doc_id", "tok_id"], "left")
        text = C._ordered(t, ["doc_id", "sent"], ["id"], F.col("form"), " ", "text")
        meta = F.create_map(F.lit("sent_id"), F.concat_ws("-", "doc_id", C.sentence_label(F.col("sent") + 1)), F.lit("text"), F.col("text"))
        return C.document_text(C.sentence_blocks(t).join(text, ["doc_id", "sent"]).withColumn("meta", meta))
    multiword = None
    if o.multiword and tables.phrases is not None:
        found = L.greedy_spans(L.phrase_candidates(u.withColumn("w", F.col("norm")), tables.phrases, "doc_id", "tok_id", "w"), "doc_id")
        multiword = found.select("doc_id", "st", "en", F.lit("multiword").alias("tag"), F.create_map(F.lit("multiword"), F.col("phrase")).alias("attrs"))
    tags = None
    if spans is not None:
        attrs = F.map_filter(F.create_map(F.lit("entity"), F.col("etype"), F.lit("head_tok"), F.concat(F.lit("#u"), "head_tok"), F.lit("identity"), F.col("link")), lambda _, v: v.isNotNull())
        tags = spans.select("doc_id", "st", "en", F.lit("entity").alias("tag"), attrs.alias("attrs"))
    return _sgml(u, o, tags, multiword)


def write_documents(annotated: DataFrame, folder: str) -> None:
    """A folder for each document, with its text."""
    annotated.select("doc_id", "text").write.partitionBy("doc_id").mode("overwrite").text(folder)
