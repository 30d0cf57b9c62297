"""Writers. Tables are Parquet; text formats are for reports and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metadata import new_only, to_json


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A fresh table; fails if the path exists, so inputs are never overwritten."""
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_new(batch: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table does not hold; the table may be absent."""
    spark = batch.sparkSession
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import AnalysisException

    try:
        existing = spark.read.parquet(path)
    except (AnalysisException, Py4JJavaError):
        batch.dropDuplicates([key]).write.mode("append").parquet(path)
        return
    new_only(batch.dropDuplicates([key]), existing, key).write.mode("append").parquet(path)


def write_lines(df: DataFrame, path: str, columns: list[str] | None = None, header: str | None = None) -> None:
    """Rows as tab-separated text, sorted as they come, with an optional header line in each file."""
    names = columns or df.columns
    rows = df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]).alias("value"))
    if header is None:
        rows.write.text(path)
    else:
        df.select(*names).write.option("sep", "\t").option("header", "true").option("quote", "").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; fields are quoted where they must be and quotes doubled."""
    df.write.option("header", "true").option("quote", '"').option("escape", '"').csv(path)


def write_records(records: DataFrame, path: str) -> None:
    """Metadata records as JSON lines."""
    records.select(to_json().alias("value")).write.text(path)


def write_texts(docs: DataFrame, path: str, text: str = "text") -> None:
    """Documents as a table, one row each."""
    write_table(docs, path)
