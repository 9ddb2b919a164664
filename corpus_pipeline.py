"""From raw documents to token files: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.decontamination import without_contaminated
from lectern.llm.ngram_join import one_of_each_class
from lectern.llm.source_mixing import mixed_documents
from lectern.llm.token_store import stored_documents
from lectern.llm.toxicity import train_toxicity, without_toxic
from lectern.plans.durable import new_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; labels teach the model.

    Each row is judged by its own text: null and empty texts score as such, long ones whole, rows that repeat
    a document alike. Null ids are never labelled. An empty table stays empty; all columns go through.
    """
    return without_toxic(docs, *train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join: that of the least id, null ids last.

    Repeated and null ids lose no text. Null and empty texts are one class. Long texts are compared whole. Of
    rows equal in all columns one stays. An empty table stays empty; all columns go through.
    """
    return one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text, whatever its id: null and empty texts hold nothing, long ones are
    searched whole. Items without id or text are ignored. An empty table stays empty; all columns go through.
    """
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    Documents without words (null, empty) have no size and go. Null sources are one source, the last. Rows
    that repeat an id share its hash. An empty table stays empty; all columns go through.
    """
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's documents: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts give the end id alone; null ids come first; repeated rows are documents of their
    own. Other columns are not stored. An empty table gives an empty store and no rows.
    """
    return stored_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("token_output", token_output),
]

#: The toxicity model and the near-duplicate join have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = new_folder(spark, f"stage-{name}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
