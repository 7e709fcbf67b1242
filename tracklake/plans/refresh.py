"""Models as stored tables: full refresh, increments and merges.

Builds in dependency order; those that do not read each other run side by side. Staging
and the two merged facts are upserted; everything else is rebuilt and overwritten.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import plausible_millis
from ..operators import high_water_mark, late_rows, merge_by_key
from ..operators.incremental import LATENESS
from ..operators.joins import join_null_safe
from ..session import side_by_side
from ..sinks import overwrite_table, table_exists, write_clustered, write_partitioned
from . import staging
from .models import DIMENSIONS, FACTS, MARTS, MODELS, STAGING, Models

USER_BUCKETS = 64


@dataclass(frozen=True)
class Layout:
    """How a model is stored. ``day_of`` names the time (or date) its day partition is cut from."""

    day_of: str | None = None
    cluster_by: tuple[str, ...] = ()
    merge_on: tuple[str, ...] = ()


# Partition, cluster and merge columns of the stored models.
LAYOUTS = {
    "stg_listen_events": Layout("event_datetime", merge_on=tuple(staging.LISTEN_KEY)),
    "stg_page_view_events": Layout("event_datetime"),
    "stg_status_change_events": Layout("event_datetime", merge_on=tuple(staging.STATUS_KEY)),
    "stg_users": Layout(merge_on=tuple(staging.USER_KEY)),
    "dim_users": Layout(cluster_by=("user_id", "level")),
    "fact_listen_events": Layout(
        "event_datetime", ("pk_user", "pk_song", "pk_location"), merge_on=("listen_event_key",)
    ),
    "fact_session_events": Layout("session_start_datetime", ("pk_user", "pk_location", "pk_entry_page")),
    "fact_status_change_events": Layout(
        "event_datetime", ("pk_user", "prev_level", "next_level"), merge_on=("status_change_event_key",)
    ),
    "mart_daily_trending_songs": Layout(cluster_by=("activity_date", "artist")),
    "mart_fact_song_daily_performance": Layout("activity_date", ("artist", "song")),
    "mart_user_behavior_daily": Layout(cluster_by=("user_id", "activity_date")),
    "mart_user_listening_stats": Layout(cluster_by=("user_id", "activity_date")),
    "mart_session_quality_analysis": Layout(cluster_by=("user_id", "session_start_datetime")),
    "mart_user_subscription_journey": Layout(cluster_by=("user_id", "registration_datetime")),
    "mart_fact_user_daily_activity": Layout("activity_date", ("user_id", "subscription_segment")),
}

INCREMENTAL = {
    "stg_listen_events": ("listen_events", staging.stg_listen_events),
    "stg_status_change_events": ("status_change_events", staging.stg_status_change_events),
    "stg_users": ("user_info", staging.stg_users),
}

# The staging table each merged fact takes its events from.
FACT_EVENTS = {
    "fact_listen_events": "stg_listen_events",
    "fact_status_change_events": "stg_status_change_events",
}

# Staged with one row per merge key, so a merge need not count them again.
UNIQUE = ("stg_listen_events", "stg_status_change_events")

# Marts that read other marts. No model reads another one of its own wave or of a later one.
LAST_MARTS = ("mart_fact_song_daily_performance", "mart_fact_user_daily_activity")
WAVES = (STAGING, DIMENSIONS, (*FACTS, *(m for m in MARTS if m not in LAST_MARTS)), LAST_MARTS)

EVENT_DATE, USER_BUCKET = "event_date", "user_bucket"

# How far past the load's own time an event may be dated before its clock is taken to be wrong.
CLOCK_ALLOWANCE = timedelta(days=1)


class Tables(Mapping):
    """The stored models below ``root``, without their partition helper columns.

    A table is listed once and read again only after ``forget``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def forget(self, name: str) -> None:
        self._open.pop(name, None)

    def stored(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(self.path(name))
        return self._open[name]

    def __contains__(self, name) -> bool:
        return name in self._open or table_exists(self.spark, self.path(name))

    def __getitem__(self, name: str) -> DataFrame:
        return self.stored(name).drop(EVENT_DATE, USER_BUCKET)

    def set_aside(self, name: str) -> DataFrame:
        """``reason`` and ``row`` (JSON) of what the last increment of a staging table left out or doubts."""
        return self.spark.read.schema("reason STRING, row STRING").parquet(self.path(f"_set_aside/{name}"))

    def set_aside_counts(self, name: str) -> dict[str, int]:
        return {r["reason"]: r["count"] for r in self.set_aside(name).groupBy("reason").count().collect()}

    def __iter__(self):
        return (name for name in MODELS if name in self)

    def __len__(self) -> int:
        return sum(1 for _ in self)


def placed(df: DataFrame, layout: Layout) -> tuple[DataFrame, str | None]:
    """The frame with its partition column, which always follows from the key."""
    if layout.day_of == "activity_date":
        return df, "activity_date"
    if layout.day_of:
        return df.withColumn(EVENT_DATE, F.to_date(layout.day_of)), EVENT_DATE
    if layout.merge_on:
        bucket = F.pmod(F.hash(*layout.merge_on), F.lit(USER_BUCKETS))
        return df.withColumn(USER_BUCKET, bucket), USER_BUCKET
    return df, None


def _mark(tables: Tables, name: str, not_after: datetime):
    partition = EVENT_DATE if LAYOUTS[name].day_of else None
    return high_water_mark(tables.stored(name), partition=partition, not_after=not_after)


def _set_aside(tables: Tables, name: str, raw: DataFrame, mark, lateness: timedelta, not_after: datetime) -> None:
    """Write down what an increment leaves out or doubts.

    ``late``: staged rows older than the lateness allows whose key the table does not hold, so they are lost unless a full
    refresh follows. ``future``: raw rows dated after ``not_after``; they are stored but do not move the mark.
    ``untimed``: raw rows without a usable time; they are stored too.
    """
    _, build = INCREMENTAL[name]
    keys = list(LAYOUTS[name].merge_on)
    stale = build(late_rows(raw, mark, "ts", lateness), None, lateness)
    lost = join_null_safe(stale, tables[name].select(*keys), keys, "left_anti")
    limit = F.unix_millis(F.lit(not_after).cast("timestamp"))
    ts = F.col("ts")
    reason = F.when(ts.isNull() | (ts == 0) | ~plausible_millis(ts), "untimed").when(ts > limit, "future")
    doubtful = raw.withColumn("_reason", reason).where("_reason IS NOT NULL")
    rows = lost.select(F.lit("late").alias("reason"), F.to_json(F.struct("*")).alias("row")).unionByName(
        doubtful.select(F.col("_reason").alias("reason"), F.to_json(F.struct(*raw.columns)).alias("row"))
    )
    overwrite_table(rows, tables.path(f"_set_aside/{name}"))


def store(tables: Tables, name: str, df: DataFrame, merge: bool = False) -> None:
    """Write one model in its layout; ``merge`` upserts where the layout has a key."""
    layout = LAYOUTS.get(name, Layout())
    laid_out, partition = placed(df, layout)
    if merge and layout.merge_on:
        merge_by_key(tables.path(name), laid_out, list(layout.merge_on), partition, layout.cluster_by, unique=name in UNIQUE)
    elif partition:
        write_partitioned(laid_out, tables.path(name), [partition], layout.cluster_by, replace_all=True)
    elif layout.cluster_by:
        write_clustered(laid_out, tables.path(name), layout.cluster_by)
    else:
        overwrite_table(laid_out, tables.path(name))
    tables.forget(name)


def refresh(
    spark: SparkSession,
    root: str,
    raw: Mapping[str, DataFrame],
    full_refresh: bool = False,
    lateness: timedelta = LATENESS,
    names: Iterable[str] = MODELS,
    facts_from: date | None = None,
    now: datetime | None = None,
    clock_allowance: timedelta = CLOCK_ALLOWANCE,
) -> Tables:
    """Bring the tables below ``root`` up to date with ``raw``.

    An incremental staging model reads what is newer than its table less the
    lateness. Models not named are read where stored, else computed where needed.

    The merged facts are rebuilt from all staged events, as songs may appear
    later than their plays. ``facts_from`` limits that to events since a day:
    earlier days are then neither read nor rewritten, so their songs and users stay as they were.

    Events dated later than ``now`` (the current time by default) plus ``clock_allowance`` are stored but do not
    move the mark of the next increment. What an increment leaves out or doubts is written to a side table
    (``Tables.set_aside``); ``raw`` should then hold what has arrived since, not all history.
    """
    not_after = (now or datetime.now(timezone.utc)) + clock_allowance
    tables = Tables(spark, root)
    wanted = set(names)

    def build_one(name: str) -> None:
        exists = name in tables and not full_refresh
        if exists and name in INCREMENTAL:
            source, build = INCREMENTAL[name]
            mark = _mark(tables, name, not_after)
            _set_aside(tables, name, raw[source], mark, lateness, not_after)
            updates = build(raw[source], mark, lateness)
            if name == "stg_users":
                updates = staging.keep_first_emission(tables[name], updates)
        else:
            # Models built earlier are read as tables, this one is computed.
            inputs = tables
            if exists and facts_from and name in FACT_EVENTS:
                events = FACT_EVENTS[name]
                recent = tables.stored(events).where(F.col(EVENT_DATE) >= F.lit(facts_from)).drop(EVENT_DATE)
                inputs = ChainMap({events: recent}, tables)
            updates = getattr(Models(raw, inputs), name)
        store(tables, name, updates, merge=exists)

    for wave in WAVES:
        side_by_side(spark, [partial(build_one, name) for name in wave if name in wanted])
    return tables
