"""Reading of files and the interface of sources."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceExtractor(Protocol):
    """Turns raw files into documents and seed records."""

    def extract(self, spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
        """(doc_id, file_name, text) and seed records with all 23 fields."""
        ...


def read_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(file_name, path, text) of all files below a folder, one row each; order does not matter."""
    reader = spark.read.option("recursiveFileLookup", "true").option("wholetext", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.text(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, file_name, text) of the ``.txt`` files; the id is the file's stem."""
    files = read_files(spark, path, ".txt")
    return files.select(F.regexp_replace("file_name", r"\.txt$", "").alias("doc_id"), "file_name", "text")
