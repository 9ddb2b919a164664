"""Streams of documents through the stages that need no other document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import clean_group, word_array


def document_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """New text files of a folder, each a document."""
    s = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path, wholetext=True)
    return s.select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))


def stream_units(docs: DataFrame) -> DataFrame:
    """Cleaned words of streamed documents: doc_id, i, tok, clean."""
    u = docs.select("doc_id", F.posexplode(word_array(F.col("text"))).alias("i", "tok"))
    return u.withColumn("clean", clean_group(F.col("tok")))
