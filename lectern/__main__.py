"""python -m lectern: annotates text files. Tables are tab-separated files in a folder, named by their kind."""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import fields

from lectern.annotate import OUTMODES, Options, Tables, annotate
from lectern.operators.models import Registry, chain_parser, lexicon_tagger
from lectern.operators.segmentation import Grammar, Stack
from lectern.operators.trees import parse_rules
from lectern.sources.formats import read_lexicon
from lectern.sources.profile import output_path


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="lectern", description=__doc__)
    p.add_argument("files", help="text files: a path or a pattern")
    p.add_argument("--tables", required=True, help="folder with segmentation.tab, lemma.tab, origin.tab, phrases.tab, tag_fix.tab, tagger.tab, rules.ini as far as there are")
    p.add_argument("--dirout", help="folder for the results; without it they are printed")
    p.add_argument("--outmode", choices=OUTMODES, default="sgml")
    for f in fields(Options):
        if f.type == "bool":
            p.add_argument(f"--{f.name}", action=argparse.BooleanOptionalAction, default=f.default)
        elif f.name != "outmode":
            p.add_argument(f"--{f.name}", default=f.default)
    return p.parse_args(argv)


def read_tables(spark, folder: str) -> tuple[Tables, Registry]:
    """Tables and annotators of the files in a folder."""
    have = lambda kind: os.path.exists(f"{folder}/{kind}.tab")
    read = lambda kind: read_lexicon(spark, f"{folder}/{kind}.tab", kind) if have(kind) else None
    seg = read("segmentation")
    seg = seg if seg is not None else spark.createDataFrame([], "norm string, seg string")
    rules = parse_rules(open(f"{folder}/rules.ini", encoding="utf8").read()) if os.path.exists(f"{folder}/rules.ini") else []
    registry = Registry().add(chain_parser())
    if have("tagger"):
        registry.add(lexicon_tagger(read_lexicon(spark, f"{folder}/tagger.tab", "tagger")))
    else:
        registry.add(lexicon_tagger(spark.createDataFrame([], "word string, tag string, freq long")))
    return Tables(Stack(seg, Grammar({}, [])), read("lemma"), read("tag_fix"), read("origin"), read("phrases"), tree_rules=rules), registry


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from lectern.sources.formats import read_documents

    a = arguments(argv)
    spark = SparkSession.builder.appName("lectern").getOrCreate()
    tables, registry = read_tables(spark, a.tables)
    options = Options(**{f.name: getattr(a, f.name) for f in fields(Options)})
    done = annotate(read_documents(spark, a.files), options, tables, registry)
    if a.dirout is None:
        for r in done.orderBy("doc_id").toLocalIterator():
            print(r.text)
        return 0
    for r in done.toLocalIterator():  # one document at a time
        path = output_path(r.doc_id, {"conllu": "conllu", "pipes": "txt"}.get(options.outmode, "tt"), a.dirout, many=True)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf8") as f:
            f.write(r.text)
    return 0


if __name__ == "__main__":
    sys.exit(main())
