"""The arrival ledger: which hours were loaded when, so that increments follow arrival and not the time of events.

Every load appends one line per hour to the event's ledger: a load id, the hour, its rows, the first and last event time. A consumer
takes the hours whose lines it has not settled yet, and only their folders are listed and read. An hour that arrives days late is
a line like any other; it is told apart by its times, without a scan of any data. Loads may run side by side, as
lines are told apart by their ids and not by an order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.incremental import LATENESS
from ..sinks import path_exists
from .load import LOADED, load_hours, raw_schema, slot_folder

LINES = "load STRING, loaded_at TIMESTAMP, slot TIMESTAMP_NTZ, rows BIGINT, first_ms BIGINT, last_ms BIGINT"
SETTLED = "load STRING, slot TIMESTAMP_NTZ"


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def ledger(spark: SparkSession, path: str, event: str) -> DataFrame:
    """All lines of an event; empty before its first load."""
    return _lines(spark, f"{path}/{event}", LINES)


def _hours(spark: SparkSession, table: str, event: str, slots: Iterable[datetime]) -> DataFrame:
    """Rows of the raw table for these hours; no other folder is listed."""
    folders = [slot_folder(table, slot, list(LOADED)) for slot in sorted(set(slots))]
    there = [f for f in folders if path_exists(spark, f)]
    schema = raw_schema(event)
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*there)


def load_and_record(
    spark: SparkSession, lake_root: str, event: str, slots: Iterable[datetime], table: str, path: str
) -> list[datetime]:
    """:func:`load_hours`, then a line per hour that was there; the hours.

    The lines are appended after the rows: a load that is cut off between the two is loaded again, which replaces its hours.
    """
    loaded = load_hours(spark, lake_root, event, slots, table)
    if loaded:
        at = F.nullif("ts", F.lit(0))
        lines = _hours(spark, table, event, loaded).groupBy(*LOADED).agg(
            F.count("*").alias("rows"), F.min(at).alias("first_ms"), F.max(at).alias("last_ms")
        )
        slot = F.make_timestamp_ntz(*[F.col(c) for c in LOADED], F.lit(0), F.lit(0))
        lines.select(
            F.lit(uuid.uuid4().hex).alias("load"), F.current_timestamp().alias("loaded_at"), slot.alias("slot"), "rows", "first_ms", "last_ms"
        ).coalesce(1).write.mode("append").parquet(f"{path}/{event}")
    return loaded


def unsettled(spark: SparkSession, path: str, event: str, consumer: str) -> DataFrame:
    """Lines of the ledger that ``consumer`` has not settled."""
    settled = _lines(spark, f"{path}/_settled/{consumer}/{event}", SETTLED)
    return ledger(spark, path, event).join(settled, ["load", "slot"], "left_anti")


def arrived(spark: SparkSession, table: str, event: str, lines: DataFrame) -> DataFrame:
    """The rows of the hours in ``lines``; one line per loaded hour comes to the driver, to name the folders."""
    return _hours(spark, table, event, [r["slot"] for r in lines.select("slot").distinct().collect()]).drop(*LOADED)


def settle(path: str, event: str, consumer: str, lines: DataFrame) -> None:
    """Note that ``consumer`` is done with these lines. Lines that were loaded since are not among them."""
    lines.select("load", "slot").coalesce(1).write.mode("append").parquet(f"{path}/_settled/{consumer}/{event}")


def late_hours(lines: DataFrame, lateness: timedelta = LATENESS) -> DataFrame:
    """Lines whose events end more than ``lateness`` before the newest event of all earlier loads.

    Reads the ledger alone. A cut by event time would have lost these hours.
    """
    loads = lines.groupBy("load").agg(F.min("loaded_at").alias("_at"), F.max("last_ms").alias("_newest"))
    before = Window.orderBy("_at", "load").rowsBetween(Window.unboundedPreceding, -1)  # one row per load
    known = loads.select("load", F.max("_newest").over(before).alias("_known"))
    allowed = int(lateness.total_seconds() * 1000)
    return lines.join(known, "load").where(F.col("last_ms") < F.col("_known") - allowed).drop("_known")
