"""Writers: partitioned, clustered, appended and overwritten parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS_PER_FILE = 20_000_000


def _file_system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system; nothing below the path is listed."""
    files, there = _file_system(spark, path)
    return files.exists(there)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library has written; absent is fine."""
    files, there = _file_system(spark, path)
    files.delete(there, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is at ``path``: a writer's mark or a partition folder, found without reading any data."""
    files, there = _file_system(spark, path)
    if not files.exists(there):
        return False
    return any(
        name == "_SUCCESS" or "=" in name or name.endswith(".parquet")
        for name in (status.getPath().getName() for status in files.listStatus(there))
    )


def with_event_date(df: DataFrame, instant: str, name: str = "event_date") -> DataFrame:
    """Add the day column that tables are partitioned by."""
    return df.withColumn(name, F.to_date(instant))


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    order_by: Sequence[str] = (),
    replace_all: bool = False,
    gathered: bool = False,
) -> None:
    """Write by partition, each sorted by ``order_by``.

    Only the partitions present in ``df`` are replaced, unless ``replace_all``.
    Rows are gathered by partition; adaptive execution splits a partition that
    is too big for one task, so that a busy day becomes several files. ``gathered=True`` says that
    ``df`` reads files that were written this way: its rows stay in their tasks.
    """
    laid_out = df if gathered else df.hint("rebalance", *partition_by)
    if order_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *order_by)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str]) -> None:
    """Range-partition and sort by ``cluster_by``, so file statistics can skip on them.

    A hash of the row breaks ties in the ranges, so that rows of one busy key can go to several tasks.
    """
    plain = [c for c, kind in df.dtypes if "map<" not in kind]
    (
        df.repartitionByRange(*cluster_by, F.xxhash64(*plain))
        .sortWithinPartitions(*cluster_by)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .parquet(path)
    )


def overwrite_table(df: DataFrame, path: str) -> None:
    """Full refresh of an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> DataFrame:
    """The table at ``path``; an empty one with ``schema`` is created where none exists."""
    if not table_exists(spark, path):
        empty = spark.createDataFrame([], schema)
        empty.write.mode("append").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def append_hour(df: DataFrame, path: str, slot: dict[str, int], idempotent: bool = True) -> None:
    """Store one loaded hour. Loading an hour again replaces it, or with ``idempotent=False`` appends.

    The slot must name the year: without it the same hour of two years would be one partition, and the
    second load would replace the first.
    """
    if not any("year" in name for name in slot):
        raise ValueError(f"the slot needs a year: {sorted(slot)}")
    tagged = df.withColumns({name: F.lit(value) for name, value in slot.items()})
    if idempotent:
        writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = tagged.write.mode("append")
    writer.partitionBy(*slot).parquet(path)
