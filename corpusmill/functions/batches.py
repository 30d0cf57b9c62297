"""Steps that workers do on Arrow batches, where column expressions would be slow or move rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows of a batch: both sides hold one whole, with all its texts.
ROWS_AT_ONCE = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def mapped(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """Rows of ``schema`` for those of ``df``, batch by batch. ``make`` runs once per task; no rows move."""
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= ROWS_AT_ONCE:
        spark.conf.set(BATCH_ROWS, str(ROWS_AT_ONCE))

    def run(batches: Iterable[pa.RecordBatch]):
        work = make()
        for batch in batches:
            yield work(batch)

    return df.mapInArrow(run, schema)
