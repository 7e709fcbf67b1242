"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracklake.session import scratch_dir

BATCH_BYTES = "4m"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: a short lineage that outlives lost executors.

    ``options`` are those of Spark's writer.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, limit: str = BATCH_BYTES) -> None:
    """Python workers get, and hold, rows of at most ``limit`` at once, however long their texts (from one row on)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)


def by_sorting(df: DataFrame) -> DataFrame:
    """A side of a join that is shuffled and sorted, never broadcast, with the other side.

    Spark sizes what Python or an explode makes like what went in, and a stored table by its compressed files. So it may broadcast a
    table of GBs that it takes for one of less than ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return df.hint("merge")


def process_cache(key: str, make: Callable[[], object]) -> object:
    """One object per Python worker process, kept across its tasks (functions travel by value, modules do not)."""
    holder = sys.modules.setdefault("_tracklake_process_cache", types.ModuleType("_tracklake_process_cache"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


def fresh(names: Iterable[str], wanted: str) -> str:
    """A column name near ``wanted`` that clashes with none of ``names`` (Spark compares without case)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def drop_named(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns an operator is about to add, so that its own always win over clashing extras."""
    clash = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in clash])


def text_key(column: str) -> Column:
    """A 128-bit key of a text: copies of a text share whatever is decided about it; NULL is its own key."""
    return F.md5(F.coalesce(F.concat(F.lit("t"), F.col(f"`{column}`")), F.lit("")))


def extended(schema: StructType, ddl: str) -> StructType:
    """A schema with further columns, all nullable."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])
