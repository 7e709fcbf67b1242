"""Change-driven upkeep: what has arrived decides which users are versioned anew and which days of the facts are rebuilt.

Every step compares the new state of a table with the stored one and hands on the keys that differ:

1. staging: arrived rows, whatever their event time, are merged by key; only rows that differ from the stored ones count;
2. ``dim_users``: the versions of users with a changed profile or a changed level are computed anew and spliced into the stored
   ones. Users, their level changes and their versions are stored in buckets of the user id, and only the buckets of affected users are read;
3. the feeds: songs and places that differ from the stored dimension;
4. facts: the days of changed events, of plays of changed songs, of events at changed places, and of events within the
   validity of changed user versions are rebuilt; no other day is written.

Keys are written to a journal before the table that they come from changes, and the journal goes when the facts are done: an upkeep that is cut
off is made good by the next one. Running the same arrivals again changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import match_artist, match_title
from ..operators import keep_first, merge_by_key
from ..operators.incremental import only_partitions_of, replace_keys
from ..operators.joins import join_null_safe
from ..operators.scd2 import UNKNOWN_USER
from ..session import scratch_dir, side_by_side
from ..sinks import delete_path, path_exists, write_partitioned
from . import core, staging
from .arrivals import arrived, settle, unsettled
from .refresh import EVENT_DATE, INCREMENTAL, LAYOUTS, UNIQUE, USER_BUCKET, USER_BUCKETS, Tables, placed, store

FACTS = {"fact_listen_events": "stg_listen_events", "fact_status_change_events": "stg_status_change_events"}
CHANGES, CHANGE = "_by_user/status_changes", "event_datetime TIMESTAMP, user_id BIGINT, prev_level STRING"
DIM_ORDER = LAYOUTS["dim_users"].cluster_by


class Journal:
    """Keys whose consequences are still to be written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/_journal"
        self._one_writer = Lock()  # two jobs that append to one folder would clear each other's temporary files

    def note(self, name: str, keys: DataFrame) -> None:
        """Written whether there are keys or not: to ask first would compute them twice."""
        with self._one_writer:
            keys.write.mode("append").parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame | None:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        noted = self.spark.read.parquet(path)
        return None if noted.isEmpty() else noted.distinct()

    def clear(self) -> None:
        delete_path(self.spark, self.root)


def user_bucket(column: str = "user_id") -> Column:
    return F.pmod(F.hash(column), F.lit(USER_BUCKETS))


def _once(df: DataFrame, label: str) -> DataFrame:
    """Computed once, beside the tables: it is read for the comparison and for the merge."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def differing(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``old`` does not hold in all columns (NULL equals NULL)."""
    return join_null_safe(new, old.select(*new.columns), new.columns, "left_anti")


def either_way(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows that only one of two states of a table holds, once each (NULL equals NULL); one shuffle of both."""
    side = F.col("_side")
    both = new.withColumn("_side", F.lit(0)).unionByName(old.select(*new.columns).withColumn("_side", F.lit(1)))
    sides = both.groupBy(*new.columns).agg(F.min(side).alias("_first"), F.max(side).alias("_last"))
    return sides.where("_first = _last").drop("_first", "_last")


def _combined(name: str, known: DataFrame, updates: DataFrame) -> DataFrame:
    """``updates`` as they stand after they have met the stored rows of their keys, whichever came first."""
    if name == "stg_users":
        return staging.keep_first_emission(known, updates)
    if name == "stg_listen_events":
        keys = staging.LISTEN_KEY
        met = join_null_safe(known, updates.select(*keys), keys, "left_semi").select(*updates.columns)
        return keep_first(met.unionByName(updates), keys, [F.col("level").asc_nulls_last()])
    return updates


def _stage(tables: Tables, journal: Journal, name: str, raw: DataFrame) -> None:
    """Merge the arrived rows of one source; its changed days and users go to the journal."""
    layout = LAYOUTS[name]
    updates, partition = placed(INCREMENTAL[name][1](raw), layout)
    updates = _once(updates, "arrived")
    if name in tables:
        known = only_partitions_of(tables.stored(name), updates, partition)
        updates = _once(differing(_combined(name, known, updates.drop(partition)), known.drop(partition)), "changed")
        updates, _ = placed(updates, layout)
    if updates.isEmpty():
        return
    if name in FACTS.values():
        journal.note(f"days/{name}", updates.select(EVENT_DATE).distinct())
    if name != "stg_listen_events":
        journal.note("users", updates.select("user_id").distinct())
    if name == "stg_status_change_events":
        by_user = updates.select(*staging.STATUS_KEY).withColumn(USER_BUCKET, user_bucket())
        merge_by_key(tables.path(CHANGES), by_user, staging.STATUS_KEY, USER_BUCKET, stored=True, unique=True)
        tables.forget(CHANGES)
    merge_by_key(
        tables.path(name), updates, list(layout.merge_on), partition, layout.cluster_by, stored=True, unique=name in UNIQUE
    )
    tables.forget(name)


def _with_unknown(ids: DataFrame) -> DataFrame:
    """People without an id share a version, be their id NULL or 0: one of the two affects the other."""
    unknown = F.coalesce("user_id", F.lit(UNKNOWN_USER)) == UNKNOWN_USER
    kind = dict(ids.dtypes)["user_id"]
    both = F.array(F.lit(None).cast(kind), F.lit(UNKNOWN_USER).cast(kind))
    return ids.select(F.explode(F.when(unknown, both).otherwise(F.array("user_id"))).alias("user_id")).distinct()


def affected_versions(tables: Tables, ids: DataFrame) -> DataFrame:
    """All versions of the users ``ids``, computed anew from the buckets they are in."""
    buckets = [r[0] for r in ids.select(user_bucket().alias("b")).distinct().collect()]  # at most USER_BUCKETS
    mine = F.col(USER_BUCKET).isin(buckets)

    def of(df: DataFrame) -> DataFrame:
        return join_null_safe(df.where(mine).drop(USER_BUCKET), ids, ["user_id"], "left_semi")

    none = tables.spark.createDataFrame([], f"{CHANGE}, {USER_BUCKET} INT")
    return core.dim_users(of(tables.stored("stg_users")), of(tables.stored(CHANGES) if CHANGES in tables else none))


def _version_users(tables: Tables, journal: Journal) -> None:
    """Splice the versions of the users in the journal into ``dim_users``; spans that changed go to the journal."""
    noted = journal.read("users")
    if noted is None:
        return
    if CHANGES not in tables and "stg_status_change_events" in tables:  # another job has built the tables
        rows = tables["stg_status_change_events"].select(*staging.STATUS_KEY).withColumn(USER_BUCKET, user_bucket())
        write_partitioned(rows, tables.path(CHANGES), [USER_BUCKET], replace_all=True)
    if "stg_users" not in tables:
        return
    stored = "dim_users" in tables and USER_BUCKET in tables.stored("dim_users").columns
    ids = _once(_with_unknown(noted if stored else tables["stg_users"].select("user_id").distinct()), "users")
    fresh = _once(affected_versions(tables, ids), "versions")
    bucketed = fresh.withColumn(USER_BUCKET, user_bucket())
    if not stored:
        write_partitioned(bucketed, tables.path("dim_users"), [USER_BUCKET], DIM_ORDER, replace_all=True)
    else:
        old = only_partitions_of(tables.stored("dim_users"), ids.withColumn(USER_BUCKET, user_bucket()), USER_BUCKET)
        old = join_null_safe(old.drop(USER_BUCKET), ids, ["user_id"], "left_semi")
        span = ["user_id", "pk_user", "row_effective_datetime", "row_expiry_datetime"]
        journal.note("spans", either_way(fresh.select(*span), old.select(*span)))
        replace_keys(tables.path("dim_users"), bucketed, ids.withColumn(USER_BUCKET, user_bucket()), ["user_id"], USER_BUCKET, DIM_ORDER)
    tables.forget("dim_users")


def _feed(tables: Tables, journal: Journal, name: str, fresh: DataFrame, key: list[Column]) -> None:
    """Store a dimension that comes from a feed; the match keys of rows that differ from the stored ones go to the journal."""
    fresh = _once(fresh, "feed")
    if name in tables:
        changed = either_way(fresh, tables[name])
        if changed.isEmpty():
            return
        journal.note(name, changed.select(*key).distinct())
    store(tables, name, fresh)


def _days_to_rebuild(tables: Tables, journal: Journal, fact: str) -> set:
    """Days whose rows of ``fact`` may differ now. The events are read in their key columns alone."""
    name = FACTS[fact]
    events = tables.stored(name)
    found = [d for d in [journal.read(f"days/{name}")] if d is not None]
    spans = journal.read("spans")
    if spans is not None:
        changed = spans.select("user_id", F.col("row_effective_datetime").alias("_from"), F.col("row_expiry_datetime").alias("_to"))
        first, last = changed.agg(F.min(F.to_date("_from")), F.max(F.to_date("_to"))).first()
        near = events.where(F.col(EVENT_DATE).between(F.lit(first), F.lit(last))).select("user_id", "event_datetime", EVENT_DATE)
        at = F.col("event_datetime")
        found.append(near.join(changed, "user_id").where((at >= F.col("_from")) & (at < F.col("_to"))).select(EVENT_DATE))
    if fact == "fact_listen_events":
        for dimension, forms in {
            "dim_songs": [match_title(F.col("song")).alias("title_form"), match_artist(F.col("artist")).alias("artist_form")],
            "dim_locations": [F.col("city"), F.col("state"), F.col("postal_code")],
        }.items():
            keys = journal.read(dimension)
            if keys is not None:
                found.append(events.select(*forms, EVENT_DATE).join(keys, keys.columns, "left_semi").select(EVENT_DATE))
    days: set = set()
    for frame in found:
        days |= {r[0] for r in frame.distinct().collect()}  # one value per day
    return days


def _rebuild(tables: Tables, fact: str, days: set) -> None:
    """Write the given days of a fact from their staged events; other days are neither read nor written."""
    on = F.col(EVENT_DATE).isin([d for d in days if d is not None])
    events = tables.stored(FACTS[fact]).where(on | F.col(EVENT_DATE).isNull() if None in days else on).drop(EVENT_DATE)
    if fact == "fact_listen_events":
        rows = core.fact_listen_events(events, tables["dim_songs"], tables["dim_users"], tables["dim_locations"])
    else:
        rows = core.fact_status_change_events(events, tables["dim_users"])
    day_rows, partition = placed(rows, LAYOUTS[fact])
    write_partitioned(day_rows, tables.path(fact), [partition], LAYOUTS[fact].cluster_by)
    tables.forget(fact)


def advance(
    spark: SparkSession,
    root: str,
    new: Mapping[str, DataFrame],
    songs: DataFrame | None = None,
    locations: DataFrame | None = None,
) -> Tables:
    """Bring the maintained tables below ``root`` up to date with what has arrived.

    ``new`` holds rows of ``listen_events``, ``status_change_events`` and ``user_info`` that arrived since the last call, of any event time
    and in any order; sources without arrivals may be absent, and rows that were seen before do no harm. ``songs`` and ``locations`` are
    the whole feeds as they are now (``None``: unchanged). The first call builds the tables. Facts are kept where
    the tables they need exist.
    """
    tables, journal = Tables(spark, root), Journal(spark, root)
    arrivals = {name: new[source] for name, (source, _) in INCREMENTAL.items() if source in new}
    side_by_side(spark, [partial(_stage, tables, journal, name, raw) for name, raw in arrivals.items()])
    steps = [partial(_version_users, tables, journal)]
    if songs is not None:
        forms = [match_title(F.col("title")).alias("title_form"), match_artist(F.col("artist")).alias("artist_form")]
        steps.append(partial(_feed, tables, journal, "dim_songs", core.dim_songs(songs), forms))
    if locations is not None:
        place = [F.col(there).alias(here) for here, there in core.LOCATION_MATCH.items()]
        steps.append(partial(_feed, tables, journal, "dim_locations", core.dim_locations(locations), place))
    side_by_side(spark, steps)
    needs = {"fact_listen_events": ("dim_songs", "dim_users", "dim_locations"), "fact_status_change_events": ("dim_users",)}

    def bring_up(fact: str) -> None:
        first = fact not in tables
        days = {r[0] for r in tables.stored(FACTS[fact]).select(EVENT_DATE).distinct().collect()} if first else _days_to_rebuild(tables, journal, fact)
        if days:
            _rebuild(tables, fact, days)

    side_by_side(
        spark, [partial(bring_up, f) for f, name in FACTS.items() if name in tables and all(n in tables for n in needs[f])]
    )
    journal.clear()
    return tables


def advance_from_ledger(
    spark: SparkSession,
    root: str,
    raw_tables: Mapping[str, str],
    ledger_path: str,
    songs: DataFrame | None = None,
    locations: DataFrame | None = None,
    consumer: str = "models",
) -> Tables:
    """:func:`advance` by the hours that were loaded since this consumer's last call; ``raw_tables`` maps events to raw tables.

    Lines are settled at the end, so hours are taken again if the upkeep is cut off.
    """
    lines = {event: _once(unsettled(spark, ledger_path, event, consumer), "lines") for event in raw_tables}
    new = {event: arrived(spark, raw_tables[event], event, found) for event, found in lines.items() if not found.isEmpty()}
    tables = advance(spark, root, new, songs, locations)
    for event in new:
        settle(ledger_path, event, consumer, lines[event])
    return tables
