"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F


#: Rows whose values a worker holds as Python objects at a time, and rows of a batch that Spark sends it.
ROWS_AT_ONCE = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Lets Spark delete the files of a query's shuffles as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Keys that hold more than one in so many rows are frequent: there are fewer than so many of them.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark so that any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Spark send workers a bounded number of rows at a time; both sides hold a batch whole, with all its texts."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= ROWS_AT_ONCE:
        spark.conf.set(BATCH_ROWS, str(ROWS_AT_ONCE))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    The cluster names it in ``spark.checkpoint.dir``. Where that is absent, a
    temporary folder serves a session that runs on one machine, as in tests; on a
    cluster other machines would not see it, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str, *by: str) -> None:
    """Add the rows of ``df`` to a table, partitioned by some columns; shuffle files of the write go with its end."""
    spark = df.sparkSession
    small_batches(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path, mode="append")
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder, partitioned by some columns, and read it back.

    Cuts the lineage in a way that survives the loss of executors, and lets
    several later steps read one result without computing it again. Shuffle files
    of the write go with its end.
    """
    path = new_path(df.sparkSession, name)
    store(df, path, *by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame, parts: list[str] | None = None) -> None:
    """Delete tables that ``materialize`` or ``store`` wrote and nothing reads any more, or only some partitions of them."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {re.sub("(/[^/=]+=[^/]*)*/[^/]*$", "", f) for f in df.inputFiles()}:
            for name in [folder] if parts is None else [f"{folder}/{p}" for p in parts]:
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(conf).delete(path, True)


def join_keyed(rows: DataFrame, keyed: DataFrame, on: str, n: str, how: str = "inner") -> DataFrame:
    """Join ``keyed``, which has each key once and in ``n`` how many rows hold it, to ``rows``; ``n`` is dropped.

    Frequent keys, of which there are fewer than ``HOT_SHARE``, are joined by
    broadcast, so their rows meet in no task; the others by a shuffle. ``how`` is
    inner or left. Both tables are read twice and should be materialized.
    """
    total = keyed.agg(F.sum(n)).head()[0] or 0
    often = F.col(n) * HOT_SHARE > total
    hot = F.broadcast(keyed.where(often).drop(n))
    rest = rows.join(hot.select(on), on, "left_anti")
    return rows.join(hot, on).unionByName(rest.join(keyed.where(~often).drop(n), on, how))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_column_schema(df: DataFrame, **added: T.DataType) -> T.StructType:
    """The schema of ``df`` with columns added; one of the same name (in any case) is replaced."""
    lower = {k.lower() for k in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in lower]
    return T.StructType(kept + [T.StructField(k, v) for k, v in added.items()])


def add_columns(
    df: DataFrame,
    make: Callable[[], Callable[[list], dict[str, list | pa.Array]]],
    source: str,
    **added: T.DataType,
) -> DataFrame:
    """Add columns computed batch by batch from the column ``source``.

    ``make`` runs once per task and returns a function from a list of values to
    the new columns; if that has a method ``close``, it is called at the end of
    the task. No rows move; a lost task is computed again from its input.
    """
    small_batches(df.sparkSession)
    schema = with_column_schema(df, **added)
    kept = [f.name for f in schema.fields if f.name not in added]
    arrow = {f.name: _arrow(f.dataType) for f in schema.fields if f.name in added}

    def run(batches: Iterable[pa.RecordBatch]):
        work = make()
        try:
            for whole in batches:
                for start in range(0, len(whole), ROWS_AT_ONCE):
                    batch = whole.slice(start, ROWS_AT_ONCE)
                    new = work(batch.column(source).to_pylist())
                    cols = [batch.column(k) for k in kept]
                    cols += [v if isinstance(v := new[k], pa.Array) else pa.array(v, arrow[k]) for k in arrow]
                    yield pa.RecordBatch.from_arrays(cols, names=[*kept, *arrow])
        finally:
            getattr(work, "close", lambda: None)()

    return df.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def null_safe_text(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))
