"""The hourly load: hours of the event lake into a raw table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import load_tolerant
from ..schemas import RAW
from ..sinks import ensure_table, path_exists, write_partitioned

# Partition columns of a raw table, and the lake's folders they come from.
LOADED = {"load_year": "year", "load_month": "month", "load_day": "day", "load_hour": "hour"}


def raw_schema(event: str) -> T.StructType:
    slots = [T.StructField(name, T.IntegerType()) for name in LOADED]
    return T.StructType([*RAW[event].fields, *slots])


def slot_folder(root: str, slot: datetime, names: Sequence[str] = ("year", "month", "day", "hour")) -> str:
    values = (slot.year, slot.month, slot.day, slot.hour)
    return "/".join([root.rstrip("/"), *(f"{n}={v}" for n, v in zip(names, values, strict=True))])


def load_hours(
    spark: SparkSession, lake_root: str, event: str, slots: Iterable[datetime], table: str
) -> list[datetime]:
    """Load hours of an event directory into the raw table; the hours that were there.

    Only the folders of the hours asked for are listed. An absent or empty hour loads nothing. Every declared column is
    produced whatever the files hold. Loading an hour again replaces it and no other: the year is part of the
    slot. One job loads all the hours.
    """
    folders = {s: slot_folder(lake_root, s) for s in slots}
    there = [s for s in sorted(folders) if path_exists(spark, folders[s])]
    schema = raw_schema(event)
    ensure_table(spark, table, schema, list(LOADED))
    if not there:
        return []
    rows = spark.read.option("basePath", lake_root).option("mergeSchema", "true").parquet(*[folders[s] for s in there])
    slot = {name: F.col(source).cast("int") for name, source in LOADED.items()}
    wide = T.StructType([*RAW[event].fields, *[T.StructField(name, T.LongType()) for name in LOADED]])
    loaded = load_tolerant(rows.withColumns(slot), wide).withColumns({name: F.col(name).cast("int") for name in LOADED})
    # Gathered by hour; adaptive execution splits an hour that is too big for one task.
    write_partitioned(loaded, table, list(LOADED))
    return there


def load_hour(spark: SparkSession, lake_root: str, event: str, slot: datetime, table: str) -> bool:
    """Load one hour; False where there is nothing to load."""
    return bool(load_hours(spark, lake_root, event, [slot], table))


def raw_table(spark: SparkSession, table: str, event: str) -> DataFrame:
    return spark.read.schema(raw_schema(event)).parquet(table)
