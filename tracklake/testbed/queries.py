"""The registered queries: every operator and model over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..operators import (
    asof_join,
    check_report,
    dense_rank_within,
    field_or_null,
    final_changes,
    high_water_mark,
    interval_join,
    keep_first,
    late_rows,
    load_tolerant,
    lookup_join,
    merge_by_key,
    merge_rows,
    single_value,
    since,
    sync_schema,
    user_history,
    violations,
)
from ..operators.quality import Check
from ..plans import core, marts, staging
from ..plans.advance import advance, advance_from_ledger
from ..plans.arrivals import late_hours, ledger, load_and_record
from ..plans.checks import CHECKS
from ..plans.models import MODELS, Models
from ..plans.load import load_hour, load_hours, raw_table
from ..plans.refresh import Tables, refresh
from ..schemas import LOCATIONS_FEED, RAW, SONGS_FEED, WIRE
from ..session import scratch_dir, side_by_side
from ..settings import IngestSettings
from ..sinks import append_hour, compact, read_compacted, with_event_date, write_clustered, write_interleaved, write_partitioned
from ..sources import (
    csv_with_header,
    delimited_feed,
    drop_view,
    file_stream,
    json_archive,
    parquet_glob,
    register_view,
    seed,
    snake_case_columns,
)
from ..streaming import (
    decode_events,
    decoded_with_context,
    dedup_sink,
    dedup_stream,
    keep_running,
    rejected,
    start_archive,
    start_topic,
    topic_writers,
)
from ..streaming.lateness import split_sink, with_lateness
from .shapes import Shapes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The day the increments of the incremental queries are cut at.
CUT = datetime(2024, 1, 16)
CUT_MILLIS = 1_705_363_200_000


def plain_times(df: DataFrame) -> DataFrame:
    """UTC times without a zone, as the SQL side has them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(function: Callable[[Shapes], DataFrame]) -> Callable[[Shapes], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: plain_times(function(Shapes(spark, sf_dir)))
    return function


def models(s: Shapes) -> Models:
    return Models(s)


def with_tables(s: Shapes, *names: str) -> Models:
    """Models over some that were written to the shared scratch folder first.

    What several branches of a query read is computed once, as in a warehouse
    where staging and dimensions are tables.
    """
    return Models(s, refresh(s.spark, scratch_dir(s.spark, "tables"), s, full_refresh=True, names=names))


# --- models ---------------------------------------------------------------

# Query name: the model, and the models it reads that are tables by then.
MODEL_QUERIES = {
    "stg_listen": ("stg_listen_events",),
    "stg_page_view": ("stg_page_view_events",),
    "stg_status": ("stg_status_change_events",),
    "stg_users": ("stg_users",),
    "dim_users": ("dim_users",),
    "dim_songs": ("dim_songs",),
    "dim_locations": ("dim_locations",),
    "dim_pages": ("dim_pages",),
    "fact_listen": ("fact_listen_events", "stg_listen_events", "dim_users"),
    "fact_session": ("fact_session_events", "dim_users"),
    "fact_status_change": ("fact_status_change_events", "dim_users"),
    "daily_trending": ("mart_daily_trending_songs",),
    "song_daily_performance": ("mart_fact_song_daily_performance",),
    "user_behavior_daily": ("mart_user_behavior_daily",),
    "user_listening_stats": ("mart_user_listening_stats",),
    "session_quality": ("mart_session_quality_analysis",),
    "subscription_journey": ("mart_user_subscription_journey",),
    "user_daily_activity": ("mart_fact_user_daily_activity",),
}


def model_query(model: str, *tables: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = Shapes(spark, sf_dir)
        return plain_times((with_tables(s, *tables) if tables else models(s))[model])

    return run


QUERIES.update({name: model_query(*spec) for name, spec in MODEL_QUERIES.items()})


# --- tolerant load --------------------------------------------------------


def unruly(df: DataFrame) -> DataFrame:
    """The same rows as a careless producer would store them: text times, gaps, a missing column."""
    item = F.col("itemInSession")
    iso = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd HH:mm:ss.SSS")
    ts = F.when(item % 50 == 7, "soon").when(item % 3 == 0, iso).otherwise(F.col("ts").cast("string"))
    return df.withColumns(
        {
            "ts": ts,
            "zip": F.when(item % 4 == 1, "1.5").otherwise(F.col("zip").cast("string")),
            "sessionId": F.when(item % 6 != 0, F.col("sessionId")),
            "level": F.when(item % 7 != 0, F.col("level")),
        }
    ).drop("lat")


@query
def load_listen_events(s: Shapes) -> DataFrame:
    source = unruly(s["listen_events"]).withColumn(
        "duration", F.when(F.col("itemInSession") % 5 != 0, F.col("duration"))
    )
    return load_tolerant(source, RAW["listen_events"])


@query
def load_page_view_events(s: Shapes) -> DataFrame:
    return load_tolerant(unruly(s["page_view_events"]), RAW["page_view_events"])


@query
def load_auth_events(s: Shapes) -> DataFrame:
    item = F.col("itemInSession")
    success = F.when(item % 8 == 0, "yes").when(F.col("success"), "TRUE").otherwise("false")
    return load_tolerant(unruly(s["auth_events"]).withColumn("success", success), RAW["auth_events"])


@query
def load_session_start_end_events(s: Shapes) -> DataFrame:
    return load_tolerant(s["session_start_end_events"], RAW["session_start_end_events"])


@query
def load_status_change_events(s: Shapes) -> DataFrame:
    return load_tolerant(s["status_change_events"], RAW["status_change_events"])


@query
def load_user_info(s: Shapes) -> DataFrame:
    return load_tolerant(s["user_info"], RAW["user_info"])


@query
def polymorphic_ts(s: Shapes) -> DataFrame:
    """Order dates as numbers, text numbers, text times, times and nonsense; all to epoch milliseconds."""
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    texts = (
        F.when(F.col("o_orderkey") % 3 == 0, millis.cast("string"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.col("o_orderstatus"))
    )
    rows = s.table("orders").select(
        "o_orderkey", texts.alias("text"), millis.alias("number"), F.col("o_orderdate").alias("time")
    )
    reads = {f.name: fn.to_epoch_millis(F.col(f.name), f.dataType) for f in rows.schema.fields}
    return rows.select(
        "o_orderkey", *[F.coalesce(reads[c], F.lit(0)).alias(f"from_{c}") for c in ("text", "number", "time")]
    )


@query
def missing_field(s: Shapes) -> DataFrame:
    """A column read by name whether the source has it or not."""
    orders = s.table("orders")
    present, _ = field_or_null(orders, "o_orderpriority")
    absent, _ = field_or_null(orders, "o_comment")
    return orders.select("o_orderkey", present.alias("priority"), F.coalesce(absent, F.lit("NA")).alias("note"))


# --- column functions -----------------------------------------------------


@query
def surrogate_key(s: Shapes) -> DataFrame:
    rows = s["ev"].select("event_id", "at", "user_id", "value", F.when(F.col("k") > 9, F.col("k")).alias("k"))
    return rows.select("event_id", fn.surrogate_key(rows, ["at", "user_id", "value", "k"]).alias("row_key"))


@query
def normalize_title(s: Shapes) -> DataFrame:
    """Whole document texts, in four languages."""
    return s.table("documents").select("doc_id", fn.normalize_title(F.col("text")).alias("normalized"))


@query
def match_forms(s: Shapes) -> DataFrame:
    return (
        s["listen_events"]
        .select("song", "artist", fn.match_title(F.col("song")).alias("title_form"), fn.match_artist(F.col("artist")).alias("artist_form"))
        .distinct()
    )


@query
def page_category(s: Shapes) -> DataFrame:
    return (
        s["page_view_events"]
        .groupBy(F.col("page"), fn.page_category(F.col("page")).alias("category"))
        .agg(F.count(F.lit(1)).alias("views"))
    )


@query
def standardise_postal(s: Shapes) -> DataFrame:
    """Order keys as postal codes: short, five-digit and longer ones, and lower-case foreign ones."""
    country = F.when(F.col("o_orderkey") % 3 == 0, "ca").otherwise("US")
    code = F.when(country == "ca", F.concat(F.lit("ab"), F.col("o_orderkey"))).otherwise(
        (F.col("o_orderkey") * 37).cast("string")
    )
    return s.table("orders").select("o_orderkey", fn.standard_postal(code, country).alias("postal"))


@query
def trim_quotes(s: Shapes) -> DataFrame:
    return s["page_view_events"].groupBy(fn.strip_quotes(F.col("userAgent")).alias("user_agent")).agg(
        F.count(F.lit(1)).alias("views")
    )


@query
def ts_parts(s: Shapes) -> DataFrame:
    return fn.time_parts(s["ev"].select("event_id", "at"), "at").drop("at")


@query
def hour_bucket(s: Shapes) -> DataFrame:
    at = fn.millis_to_timestamp(F.col("ms"))
    return s["ev"].groupBy(fn.hour_bucket(at).alias("bucket")).agg(F.count(F.lit(1)).alias("events"))


@query
def time_differences(s: Shapes) -> DataFrame:
    """Elapsed minutes and days against second boundaries, from order to shipment."""
    lines = s.table("lineitem").join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start, end = F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        fn.elapsed("MINUTE", start, end).alias("minutes"),
        fn.elapsed("DAY", start, end).alias("days"),
        fn.second_boundaries(start, end).alias("seconds"),
    )


@query
def guarded_numbers(s: Shapes) -> DataFrame:
    """Rounding, guarded ratios and shares with zero denominators."""
    e = s["ev"]
    return e.select(
        "event_id",
        fn.round_half_up(F.col("value") / 7, 2).alias("rounded"),
        fn.ratio_or_zero(F.col("user_id"), F.col("k")).alias("ratio"),
        fn.safe_share(F.col("user_id"), F.col("k")).alias("share"),
        F.nullif(F.col("k"), F.lit(0)).alias("k_or_null"),
    )


@query
def exact_sums(s: Shapes) -> DataFrame:
    return s["ev"].groupBy("user_id").agg(fn.exact_sum(F.col("value")).alias("total"))


@query
def level_flip(s: Shapes) -> DataFrame:
    status = models(s)["stg_status_change_events"]
    return status.groupBy("prev_level", fn.flipped_level(F.col("prev_level")).alias("next_level")).agg(
        F.count(F.lit(1)).alias("changes")
    )


@query
def string_decode(s: Shapes) -> DataFrame:
    """Whole document texts read in the wrong encoding, some letters as octal escapes, and back."""
    misread = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    safe = F.replace(misread, F.lit("\\"), F.lit("\\134"))
    escaped = F.replace(safe, F.decode(F.encode(F.lit("é"), "UTF-8"), "ISO-8859-1"), F.lit("\\303\\251"))
    return s.table("documents").select("doc_id", fn.repair_text(escaped).alias("repaired"))


# --- dedup, grouping, windows ---------------------------------------------


@query
def dedup_row_number(s: Shapes) -> DataFrame:
    """The latest line of every order, by ship date, then line number."""
    return keep_first(
        s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"),
        ["l_orderkey"],
        [F.col("l_shipdate").desc_nulls_last(), F.col("l_linenumber").asc(), F.col("l_partkey").asc()],
    )


@query
def dedup_status(s: Shapes) -> DataFrame:
    return models(s)["stg_status_change_events"].groupBy("prev_level").agg(F.count(F.lit(1)).alias("changes"))


@query
def users_collapse(s: Shapes) -> DataFrame:
    """Re-emitted user records, with a level column in the source."""
    source = s["user_info"].withColumn("level", F.when(F.col("userId") % 2 == 0, "paid"))
    return staging.stg_users(source)


@query
def distinct_dims(s: Shapes) -> DataFrame:
    m = models(s)
    return (
        m["dim_songs"].select(F.lit("songs").alias("dim"), F.col("pk_song").alias("pk"))
        .unionByName(m["dim_pages"].select(F.lit("pages").alias("dim"), F.col("pk_page").alias("pk")))
        .unionByName(m["dim_locations"].select(F.lit("locations").alias("dim"), F.col("pk_location").alias("pk")))
        .groupBy("dim").agg(F.count(F.lit(1)).alias("members"), F.count_distinct("pk").alias("keys"))
    )


@query
def latest_per_user(s: Shapes) -> DataFrame:
    return final_changes(models(s)["stg_status_change_events"])


@query
def union_all_history(s: Shapes) -> DataFrame:
    m = models(s)
    return user_history(m["stg_users"], m["stg_status_change_events"])


@query
def rank_within_day(s: Shapes) -> DataFrame:
    """Dense rank of line counts per ship date."""
    daily = s.table("lineitem").groupBy(F.to_date("l_shipdate").alias("day"), "l_partkey").agg(
        F.count(F.lit(1)).alias("lines")
    )
    ranked = dense_rank_within(daily, ["day"], "lines", "place")
    return ranked.withColumn("place", F.col("place").cast("bigint"))


@query
def first_upgrade(s: Shapes) -> DataFrame:
    status = models(s)["stg_status_change_events"]
    return status.where(F.lower("prev_level") == "free").groupBy("user_id").agg(
        F.min("event_datetime").alias("first_upgrade")
    )


@query
def session_facts(s: Shapes) -> DataFrame:
    return core.session_facts(models(s)["stg_page_view_events"])


@query
def session_first_page(s: Shapes) -> DataFrame:
    facts = core.session_facts(models(s)["stg_page_view_events"])
    return facts.groupBy("first_page").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("num_pages_visited").alias("pages")
    )


@query
def session_quality_tuned(s: Shapes) -> DataFrame:
    """The session tiers with other thresholds."""
    tuned = marts.mart_session_quality_analysis(models(s)["stg_page_view_events"], 600, 60, 3)
    return tuned.groupBy("session_quality_tier", "user_engagement_level").agg(F.count(F.lit(1)).alias("sessions"))


# --- joins ----------------------------------------------------------------


@query
def asof_listen(s: Shapes) -> DataFrame:
    m = with_tables(s, "stg_listen_events", "dim_users")
    rows = core.user_at(m["stg_listen_events"], m["dim_users"], "event_datetime")
    return rows.select("event_datetime", "user_id", "song", "pk_user")


@query
def asof_session(s: Shapes) -> DataFrame:
    m = with_tables(s, "stg_page_view_events", "dim_users")
    rows = core.user_at(core.session_facts(m["stg_page_view_events"]), m["dim_users"], "session_start_datetime")
    return rows.select("session_id", "level", "postal_code", "session_start_datetime", "pk_user")


@query
def asof_status(s: Shapes) -> DataFrame:
    """With every key treated as one of very many versions."""
    m = with_tables(s, "stg_status_change_events", "dim_users")
    rows = asof_join(
        m["stg_status_change_events"],
        m["dim_users"],
        key="user_id",
        time="event_datetime",
        start="row_effective_datetime",
        end="row_expiry_datetime",
        take=["pk_user", "level"],
        max_versions=0,
        slot_seconds=3600,
    )
    return rows.drop("bucket_ingestion_datetime")


@query
def interval_listen(s: Shapes) -> DataFrame:
    """The plain interval join; it must agree with the linear one."""
    m = models(s)
    rows = interval_join(
        m["stg_listen_events"],
        m["dim_users"].select("pk_user", "user_id", "row_effective_datetime", "row_expiry_datetime").distinct(),
        key="user_id",
        time="event_datetime",
        start="row_effective_datetime",
        end="row_expiry_datetime",
        take=["pk_user"],
    )
    return rows.select("event_datetime", "user_id", "song", "pk_user")


@query
def tolerance_match_best(s: Shapes) -> DataFrame:
    m = models(s)
    keys = ["event_datetime", "user_id", "song", "artist", "duration"]
    return core.match_songs(m["stg_listen_events"], m["dim_songs"]).select(*keys, "pk_song")


@query
def location_join(s: Shapes) -> DataFrame:
    m = models(s)
    rows = lookup_join(m["stg_listen_events"], m["dim_locations"], core.LOCATION_MATCH, "pk_location")
    return rows.select("event_datetime", "user_id", "song", "pk_location")


# --- increments, merge, sinks ---------------------------------------------


@query
def incremental_since(s: Shapes) -> DataFrame:
    """Raw rows an increment reads after the events before the cut were staged."""
    raw = s["status_change_events"]
    mark = high_water_mark(staging.stg_status_change_events(raw.where(F.col("ts") < CUT_MILLIS)))
    return since(raw, mark).select("ts", "userId", "level")


@query
def rows_too_late(s: Shapes) -> DataFrame:
    raw = s["status_change_events"]
    mark = high_water_mark(staging.stg_status_change_events(raw))
    return late_rows(raw, mark, lateness=timedelta(hours=6)).agg(F.count(F.lit(1)).alias("late"))


@query
def value_from_query(s: Shapes) -> DataFrame:
    """A scalar fetched first and used as a constant in the main query."""
    newest = single_value(s["ev"], "max(at)")
    return s["ev"].where(F.col("at") >= F.lit(newest) - F.expr("INTERVAL 1 DAY")).select("event_id", "user_id")


@query
def merge_by_key_listens(s: Shapes) -> DataFrame:
    """First half stored, then the rest with another level, merged; the last step twice."""
    path = scratch_dir(s.spark, "merge")
    raw = s["listen_events"]
    first = with_event_date(staging.stg_listen_events(raw.where(F.col("ts") < CUT_MILLIS)), "event_datetime")
    merge_by_key(path, first, staging.LISTEN_KEY, "event_date")
    mark = high_water_mark(s.spark.read.parquet(path), partition="event_date")
    newer = staging.stg_listen_events(raw, mark).withColumn("level", F.lit("merged"))
    for _ in range(2):
        merge_by_key(path, with_event_date(newer, "event_datetime"), staging.LISTEN_KEY, "event_date")
    return s.spark.read.parquet(path).drop("event_date")


@query
def merge_users(s: Shapes) -> DataFrame:
    """Users of the first half, then an increment that re-emits some of them."""
    raw = s["user_info"]
    known = staging.stg_users(raw.where(F.col("ts") < CUT_MILLIS))
    return staging.merged_users(known, staging.stg_users(raw, high_water_mark(known)))


@query
def schema_sync(s: Shapes) -> DataFrame:
    """Old suppliers under a new layout: one column added, one removed, every third key updated."""
    suppliers = s.table("supplier")
    old = suppliers.select("s_suppkey", "s_name", "s_acctbal")
    new = suppliers.where("s_suppkey % 3 = 0").select(
        "s_suppkey", F.upper("s_name").alias("s_name"), F.col("s_nationkey").alias("nation")
    )
    return merge_rows(sync_schema(old, new), new, ["s_suppkey"])


@query
def raw_hour_append(s: Shapes) -> DataFrame:
    """Every hour of status changes through the lake layout into the raw table, the first one twice."""
    spark, root, table, event = s.spark, scratch_dir(s.spark, "lake"), scratch_dir(s.spark, "raw"), "status_change_events"
    lake = fn.time_parts(s["status_change_events"].withColumn("ts", F.timestamp_millis("ts")), "ts")
    write_partitioned(lake, root, ["year", "month", "day", "hour"])
    hours = [r[0] for r in lake.select(F.date_trunc("HOUR", "ts").cast("timestamp_ntz")).distinct().collect()]
    load_hours(spark, root, event, hours, table)
    load_hour(spark, root, event, min(hours), table)
    loaded = raw_table(spark, table, event)
    return loaded.select("ts", "userId", "level", "sessionId", "load_year", "load_month", "load_day", "load_hour")


@query
def partitioned_clustered_write(s: Shapes) -> DataFrame:
    """A day-partitioned and a clustered table, read back in full."""
    spark, by_day, by_user = s.spark, scratch_dir(s.spark, "days"), scratch_dir(s.spark, "users")
    listens = with_event_date(models(s)["stg_listen_events"], "event_datetime")
    write_partitioned(listens, by_day, ["event_date"], ["user_id"])
    write_clustered(listens, by_user, ["user_id", "event_datetime"])
    columns = ["event_date", "event_datetime", "user_id", "song", "artist", "duration"]
    days, users = (spark.read.parquet(p).select(*columns) for p in (by_day, by_user))
    return days.withColumn("part", F.lit("day")).unionByName(users.withColumn("part", F.lit("users")))


@query
def interleaved_write(s: Shapes) -> DataFrame:
    """Staged plays laid out by three columns at once, read back in full."""
    path = scratch_dir(s.spark, "interleaved")
    columns = ["event_datetime", "user_id", "song", "artist", "duration"]
    listens = models(s)["stg_listen_events"].select(*columns)
    write_interleaved(listens, path, ["user_id", "song", "event_datetime"])
    return s.spark.read.parquet(path).select(*columns)


# --- increments of stored tables ------------------------------------------


class Arrived(dict):
    """The raw tables with some of their rows held back."""

    def __init__(self, s: Shapes, keep: Column) -> None:
        events = ("listen_events", "page_view_events", "status_change_events", "user_info")
        super().__init__({n: s[n].where(keep) for n in events} | {n: s[n] for n in ("songs", "locations")})


def in_two_steps(s: Shapes, *names: str) -> Tables:
    """Tables built from the first half, then brought up to date with all events."""
    root = scratch_dir(s.spark, "steps")
    refresh(s.spark, root, Arrived(s, F.col("ts") < CUT_MILLIS), names=names)
    return refresh(s.spark, root, s, names=names)


STAGED = ("stg_listen_events", "stg_status_change_events", "stg_users", "dim_users")


@query
def refresh_users(s: Shapes) -> DataFrame:
    return in_two_steps(s, "stg_users")["stg_users"]


@query
def refresh_fact_listen(s: Shapes) -> DataFrame:
    return in_two_steps(s, *STAGED, "fact_listen_events")["fact_listen_events"]


@query
def refresh_fact_status(s: Shapes) -> DataFrame:
    return in_two_steps(s, *STAGED[1:], "fact_status_change_events")["fact_status_change_events"]


HELD_BACK = "ts < 1705000000000 AND itemInSession % 5 = 0"


@query
def refresh_reports_late_rows(s: Shapes) -> DataFrame:
    """Listens that arrive days late: each is in the side table, by its key."""
    root, names = scratch_dir(s.spark, "late"), ("stg_listen_events",)
    listens = s["listen_events"]
    refresh(s.spark, root, {"listen_events": listens.where(f"ts < {CUT_MILLIS} AND NOT ({HELD_BACK})")}, names=names)
    tables = refresh(s.spark, root, {"listen_events": listens}, names=names)
    row = F.from_json("row", tables["stg_listen_events"].schema)
    lost = tables.set_aside("stg_listen_events").select("reason", row.alias("r"))
    return lost.select("reason", "r.event_datetime", "r.user_id", "r.song", "r.artist")


@query
def refresh_future_event(s: Shapes) -> DataFrame:
    """Listens dated 80 years ahead are stored, reported, and do not end the increments."""
    root, names, ahead = scratch_dir(s.spark, "future"), ("stg_listen_events",), 80 * 365 * 86_400_000
    listens = s["listen_events"]
    early = listens.where(f"ts < {CUT_MILLIS}")
    wrong = early.where("userId % 50 = 0").withColumn("ts", F.col("ts") + F.lit(ahead))
    refresh(s.spark, root, {"listen_events": early.unionByName(wrong)}, names=names)
    tables = refresh(s.spark, root, {"listen_events": listens.unionByName(wrong)}, names=names)
    stored = tables["stg_listen_events"].select("event_datetime", "user_id", "song", F.lit("stored").alias("part"))
    row = F.from_json("row", "ts BIGINT, userId BIGINT, song STRING")
    told = tables.set_aside("stg_listen_events").where("reason = 'future'").select(row.alias("r"))
    return stored.unionByName(
        told.select(fn.millis_to_timestamp(F.col("r.ts")).alias("event_datetime"), F.col("r.userId").alias("user_id"),
                    F.col("r.song").alias("song"), F.lit("future").alias("part"))
    )


@query
def dim_users_unknown(s: Shapes) -> DataFrame:
    """Every fifth person and their changes without an id: one version for them all."""
    m = models(s)
    nobody = F.when(F.col("user_id") % 5 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("bigint")
    users = m["stg_users"].withColumn("user_id", nobody)
    return core.dim_users(users, m["stg_status_change_events"].withColumn("user_id", nobody)).drop("pk_user")


@query
def tolerance_match_not_finite(s: Shapes) -> DataFrame:
    """Durations that are infinite or no number match nothing; all others as before."""
    listens = models(s)["stg_listen_events"].select("event_datetime", "user_id", "song", "artist", "duration")
    odd = F.col("user_id") % 10
    strange = F.when(odd == 3, float("inf")).when(odd == 5, float("nan")).when(odd == 7, float("-inf"))
    songs = models(s)["dim_songs"]
    songs = songs.unionByName(songs.withColumn("duration", F.lit(float("inf"))))
    matched = core.match_songs(listens.withColumn("duration", F.coalesce(strange, "duration")), songs)
    return matched.select("event_datetime", "user_id", "song", "artist", F.col("pk_song").isNotNull().alias("matched"))


# --- upkeep by arrival ----------------------------------------------------

LATE_HOURS = "day(ts) < 10 AND hour(ts) % 6 = 2"


@query
def dim_users_incremental(s: Shapes) -> DataFrame:
    """Versions spliced user by user over three arrivals: the first half, the second, and what was held back of both."""
    root, held = scratch_dir(s.spark, "upkeep"), F.col("userId") % 5 == 0
    early = F.col("ts") < CUT_MILLIS
    late = held & (F.col("ts") % 3 == 0)
    for part in (early & ~late, ~early & ~late, late):
        arrivals = {n: s[n].where(part) for n in ("status_change_events", "user_info")}
        tables = advance(s.spark, root, arrivals)
    return tables["dim_users"]


@query
def fact_listen_changes(s: Shapes) -> DataFrame:
    """Plays that arrive days late, users that are known later than their plays, and a third of the songs later still."""
    root, early = scratch_dir(s.spark, "upkeep"), F.col("ts") < CUT_MILLIS
    late = F.expr(HELD_BACK)
    songs, some = s["songs"], s["songs"].where("track_id % 3 <> 0")
    changes, users, plays = s["status_change_events"], s["user_info"], s["listen_events"]
    advance(s.spark, root, {"listen_events": plays.where(early & ~late), "user_info": users.where(early)}, some, s["locations"])
    advance(s.spark, root, {"listen_events": plays.where(~early | late), "status_change_events": changes, "user_info": users})
    return advance(s.spark, root, {}, songs, s["locations"])["fact_listen_events"]


@query
def fact_status_changes(s: Shapes) -> DataFrame:
    """Level changes rebuilt for the days that late changes and users touch."""
    root = scratch_dir(s.spark, "upkeep")
    changes, users = s["status_change_events"], s["user_info"]
    for part in ("userId % 4 <> 0", "userId % 4 = 0 AND ts % 2 = 0", "userId % 4 = 0"):
        tables = advance(s.spark, root, {"status_change_events": changes.where(part), "user_info": users.where(part)})
    return tables["fact_status_change_events"]


@query
def arrival_ledger(s: Shapes) -> DataFrame:
    """Hours of a lake loaded in two turns, some of the first days last: staged by arrival, and told late by the ledger alone."""
    spark, event = s.spark, "status_change_events"
    root, table, book, lake_root = (scratch_dir(spark, n) for n in ("upkeep", "raw", "ledger", "lake"))
    lake = fn.time_parts(s[event].withColumn("ts", F.timestamp_millis("ts")), "ts")
    write_partitioned(lake, lake_root, ["year", "month", "day", "hour"])
    hours = lake.select(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("slot"), F.expr(LATE_HOURS).alias("late")).distinct().collect()
    for late in (False, True):
        load_and_record(spark, lake_root, event, [r["slot"] for r in hours if r["late"] == late], table, book)
        tables = advance_from_ledger(spark, root, {event: table}, book)
    staged = tables["stg_status_change_events"].select(
        F.lit("staged").alias("part"), "event_datetime", "user_id", "prev_level", F.lit(1).cast("bigint").alias("rows")
    )
    told = late_hours(ledger(spark, book, event))
    return staged.unionByName(
        told.select(F.lit("late").alias("part"), F.col("slot").cast("timestamp").alias("event_datetime"), "rows"),
        allowMissingColumns=True,
    )


@query
def compacted_sink(s: Shapes) -> DataFrame:
    """Level changes in small files by day: three batches, a compaction of the closed days, a late batch, another compaction."""
    spark, sink, target = s.spark, scratch_dir(s.spark, "sink"), scratch_dir(s.spark, "compacted")
    changes = fn.time_parts(s["status_change_events"].withColumn("ts", F.timestamp_millis("ts")), "ts")
    changes = changes.select("ts", "userId", "level", "year", "month", "day")
    closed = datetime(2024, 1, 16)
    for batch in range(4):
        part = changes.where(F.pmod("userId", F.lit(4)) == batch)
        part.repartition(2, "userId").write.mode("append").partitionBy("year", "month", "day").parquet(sink)
        if batch >= 2:
            compact(spark, sink, target, closed)
    return read_compacted(spark, sink, target)


@query
def raw_hour_insert(s: Shapes) -> DataFrame:
    """The plain append of an hourly insert: an hour loaded twice is there twice."""
    spark, path = s.spark, scratch_dir(s.spark, "insert")
    changes = load_tolerant(s["status_change_events"], RAW["status_change_events"])
    day = changes.where(f"ts >= {CUT_MILLIS} AND ts < {CUT_MILLIS + 4 * 3_600_000}")
    for hour in (0, 1, 2, 3, 3):
        start = CUT_MILLIS + hour * 3_600_000
        slot = {"load_year": 2024, "load_month": 1, "load_day": 16, "load_hour": hour}
        append_hour(day.where(f"ts >= {start} AND ts < {start + 3_600_000}"), path, slot, idempotent=False)
    return raw_table(spark, path, "status_change_events").select("ts", "userId", "level", "load_hour")


# --- sources --------------------------------------------------------------


@query
def songs_feed(s: Shapes) -> DataFrame:
    """The song table as gzipped tab-separated text without a header, and back."""
    path = scratch_dir(s.spark, "songs")
    columns = ["track_id", "artist", "title", "duration", F.lit(0).alias("listen_count"), "genre"]
    s["songs"].select(*columns).write.option("sep", "\t").option("compression", "gzip").csv(path)
    return delimited_feed(s.spark, path, SONGS_FEED)


@query
def locations_feed(s: Shapes) -> DataFrame:
    """Where each customer lives, in the layout of the locations feed."""
    path = scratch_dir(s.spark, "locations")
    filler = [F.lit(None).cast("string").alias(c) for c in LOCATIONS_FEED.schema.names[6:]]
    person = F.col("person").cast("string").alias("county")
    s["people"].select(F.lit("US"), "zip", "city", "state", "state", person, *filler).toDF(
        *LOCATIONS_FEED.schema.names
    ).write.option("sep", "\t").csv(path)
    return delimited_feed(s.spark, path, LOCATIONS_FEED)


@query
def csv_skips_malformed(s: Shapes) -> DataFrame:
    """Customers as CSV lines, every seventh with a field too many: those are left out."""
    path = scratch_dir(s.spark, "customers") + ".csv"
    segment = F.when(F.col("c_custkey") % 7 == 0, "BUILDING,extra").otherwise(F.col("c_mktsegment"))
    line = F.concat_ws(",", "c_custkey", "c_name", segment)
    # A tab as separator keeps the commas inside the one column unquoted.
    s.table("customer").select(line.alias("custkey,name,segment")).write.option("sep", "\t").csv(path, header=True)
    return csv_with_header(s.spark, path, "custkey BIGINT, name STRING, segment STRING")


@query
def seed_csv(s: Shapes) -> DataFrame:
    """Customer codes and names as CSV with a header; all columns come back as text."""
    path = scratch_dir(s.spark, "seed")
    s.table("customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name")).write.option(
        "header", True
    ).csv(path)
    return seed(s.spark, path)


@query
def parquet_views(s: Shapes) -> DataFrame:
    """A replaceable view over a parquet glob, with column names put in snake case."""
    columns = {"c_custkey": "Customer Key", "c_name": "Customer/Name"}
    path = scratch_dir(s.spark, "glob")
    s.table("customer").withColumnsRenamed(columns).select(*columns.values()).write.parquet(path)
    view = register_view(snake_case_columns(parquet_glob(s.spark, f"{path}/*.parquet")), "customers_ext")
    rows = view.select("customer_key", "customer_name")
    drop_view(s.spark, "customers_ext")
    return rows


# --- data checks ----------------------------------------------------------


@query
def dq_unique(s: Shapes) -> DataFrame:
    return violations(Check("dim_songs", "unique", ("pk_song",)), models(s))


@query
def dq_not_null(s: Shapes) -> DataFrame:
    m = with_tables(s, "stg_listen_events", "dim_users")
    return violations(Check("fact_listen_events", "not_null", ("pk_song",)), m)


@query
def dq_accepted_values(s: Shapes) -> DataFrame:
    pages = tuple(fn.labels.PAGE_CATEGORY)
    return violations(Check("stg_page_view_events", "accepted_values", ("page",), values=pages), models(s))


@query
def dq_relationships(s: Shapes) -> DataFrame:
    check = Check("stg_listen_events", "relationships", ("song",), parent="dim_songs", parent_column="title")
    return violations(check, models(s))


@query
def dq_range(s: Shapes) -> DataFrame:
    check = Check("stg_listen_events", "accepted_range", ("duration",), low=901, high=908.5, inclusive=False)
    return violations(check, models(s)).select("event_datetime", "user_id", "song", "duration")


@query
def dq_unique_combo(s: Shapes) -> DataFrame:
    columns = ("event_datetime", "user_id", "session_id", "item_in_session")
    return violations(Check("stg_page_view_events", "unique_combination", columns), models(s))


@query
def dq_report(s: Shapes) -> DataFrame:
    """All declared checks of all models, over their tables."""
    return check_report(CHECKS, with_tables(s, *MODELS))


# --- streaming ------------------------------------------------------------


def messages(s: Shapes) -> DataFrame:
    """Listens as JSON lines, some titles escaped or quoted, and a line of nonsense per purchase."""
    plain = F.col("song").rlike("^[A-Za-z ]+$") & (F.col("song") != "NA")
    item = F.col("itemInSession")
    song = (
        F.when(plain & (item % 4 == 1), F.concat("song", F.lit("\\303\\251")))
        .when(plain & (item % 4 == 2), F.concat(F.lit('"'), "song", F.lit('"')))
        .otherwise(F.col("song"))
    )
    rows = s["listen_events"].withColumn("song", song)
    good = rows.select(F.to_json(F.struct(*WIRE["listen_events"].names)).alias("value"))
    purchases = s["ev"].where("event_type = 'purchase'")
    bad = purchases.select(
        F.when(F.col("k") % 2 == 0, F.concat(F.lit("not json "), "event_id"))
        .otherwise(F.concat(F.lit('{"userId":'), "event_id", F.lit("}")))
        .alias("value")
    )
    return good.unionByName(bad)


def message_files(s: Shapes, topic: str = "listen_events") -> str:
    root = scratch_dir(s.spark, "messages")
    messages(s).write.text(f"{root}/{topic}")
    return root


def run_ingest(s: Shapes) -> IngestSettings:
    settings = IngestSettings(
        lake_root=scratch_dir(s.spark, "ingest"),
        checkpoint_root=scratch_dir(s.spark, "ingest-state"),
        source="files",
        files_root=message_files(s),
        run_once=True,
    )
    for started in start_topic(s.spark, settings, "listen_events"):
        started.awaitTermination()
    return settings


@query
def stream_decode(s: Shapes) -> DataFrame:
    """Ingest of a topic into the lake; what the hour folders then hold."""
    settings = run_ingest(s)
    return s.spark.read.parquet(settings.sink_path("listen_events")).select(
        "ts", "userId", "song", "artist", "duration", "city", "zip", "level"
    )


@query
def stream_partition_sink(s: Shapes) -> DataFrame:
    settings = run_ingest(s)
    hours = s.spark.read.parquet(settings.sink_path("listen_events"))
    return hours.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("events"))


@query
def stream_dead_letter(s: Shapes) -> DataFrame:
    settings = run_ingest(s)
    letters = s.spark.read.schema("value STRING, topic STRING, reason STRING").json(
        f"{settings.sink_path('dead_letters')}/listen_events"
    )
    return letters.select("value", "topic", "reason")


@query
def batch_decode(s: Shapes) -> DataFrame:
    """The decoder on a batch of messages, unreadable ones kept as rows of NULLs."""
    received = messages(s).select(
        F.col("value").cast("binary").alias("value"), F.lit("listen_events").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
    )
    rows = decode_events(received, "listen_events", keep_unreadable=True)
    letters = rejected(decoded_with_context(received, "listen_events"))
    return (
        rows.groupBy(F.col("ts").isNull().alias("unreadable")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("path", F.lit("rows"))
        .unionByName(letters.agg(F.count(F.lit(1)).alias("n")).select(F.lit(True).alias("unreadable"), "n", F.lit("letters").alias("path")))
    )


@query
def stream_archive(s: Shapes) -> DataFrame:
    """Raw messages archived as gzipped lines by the hour of their event, read back as JSON."""
    root = message_files(s)
    path, checkpoint = scratch_dir(s.spark, "archive"), scratch_dir(s.spark, "archive-state")
    at = F.timestamp_millis(F.coalesce(F.get_json_object(F.col("value").cast("string"), "$.ts").try_cast("bigint"), F.lit(0)))
    source = file_stream(s.spark, f"{root}/listen_events", "listen_events")
    start_archive(source, path, checkpoint, run_once=True, at=at).awaitTermination()
    rows = json_archive(s.spark, f"{path}/topic=listen_events", WIRE["listen_events"])
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("messages"), F.count("ts").alias("events"))


@query
def stream_replay(s: Shapes) -> DataFrame:
    """The archive replayed from an hour on, in batches of bounded size, through the ingest."""
    path, checkpoint = scratch_dir(s.spark, "archive"), scratch_dir(s.spark, "archive-state")
    ms = F.coalesce(F.get_json_object(F.col("value").cast("string"), "$.ts").try_cast("bigint"), F.lit(0))
    at = F.date_trunc("DAY", F.timestamp_millis(ms))  # a flush a day, not an hour
    sent = file_stream(s.spark, f"{message_files(s)}/listen_events", "listen_events")
    start_archive(sent, path, checkpoint, run_once=True, at=at).awaitTermination()
    settings = IngestSettings(
        lake_root=scratch_dir(s.spark, "replay"), checkpoint_root=scratch_dir(s.spark, "replay-state"), source="archive",
        files_root=path, starting_offsets=CUT.strftime("%Y-%m-%dT%H"), max_files_per_trigger=12, run_once=True, run_id="second",
    )
    for started in start_topic(s.spark, settings, "listen_events"):
        started.awaitTermination()
    return s.spark.read.parquet(settings.sink_path("listen_events")).select("ts", "userId", "song", "artist")


@query
def stream_all_topics(s: Shapes) -> DataFrame:
    """Every topic at once under supervision: events stored by topic and day."""
    root = scratch_dir(s.spark, "messages")

    def send(topic: str) -> None:
        names = [n for n in WIRE[topic].names if n in s[topic].columns]
        s[topic].select(F.to_json(F.struct(*names)).alias("value")).write.text(f"{root}/{topic}")

    side_by_side(s.spark, [partial(send, topic) for topic in WIRE])
    settings = IngestSettings(
        lake_root=scratch_dir(s.spark, "ingest"), checkpoint_root=scratch_dir(s.spark, "ingest-state"), source="files",
        files_root=root, run_once=True,
    )
    writers: dict = {}
    for topic in WIRE:
        writers |= topic_writers(s.spark, settings, topic)
    keep_running(s.spark, writers, poll=0.1)
    stored = None
    for topic in WIRE:
        events = s.spark.read.parquet(settings.sink_path(topic)).groupBy(F.to_date("ts").alias("day"))
        counted = events.agg(F.count(F.lit(1)).alias("events")).withColumn("topic", F.lit(topic))
        stored = counted if stored is None else stored.unionByName(counted)
    return stored


@query
def decode_bad_times(s: Shapes) -> DataFrame:
    """Messages whose time is no time: dead letters, while the decoder goes on."""
    bad = F.element_at(
        F.array(*[F.lit(v) for v in ("99999999999999999", "9223372036854775807", "253402300800000", "-62135596800001")]),
        (F.col("event_id") % 4 + 1).cast("int"),
    )
    value = F.concat(F.lit('{"ts":'), bad, F.lit(',"userId":'), "event_id", F.lit("}"))
    fields = F.concat(F.lit('{"ts":'), F.col("ms"), F.lit(',"userId":"x'), "event_id", F.lit('"}'))
    sent = s["ev"].select(F.explode(F.array(value, fields)).alias("value"))
    received = sent.select(
        F.col("value").cast("binary").alias("value"), F.lit("user_info").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    letters = rejected(decoded_with_context(received, "user_info")).select("value", "reason")
    kept = decode_events(received, "user_info").select(F.unix_millis("ts").cast("string").alias("value"), F.lit("stored").alias("reason"))
    return letters.unionByName(kept)


@query
def stream_dedup_watermark(s: Shapes) -> DataFrame:
    """Repeats dropped in the stream, over several batches that each span the month."""
    root = scratch_dir(s.spark, "messages")
    messages(s).repartition(4, F.xxhash64("value", F.monotonically_increasing_id())).write.text(f"{root}/listen_events")
    path, checkpoint = scratch_dir(s.spark, "dedup"), scratch_dir(s.spark, "dedup-state")
    events = decode_events(file_stream(s.spark, f"{root}/listen_events", "listen_events", 1), "listen_events")
    keys = ["ts", "userId", "song", "artist"]
    dedup_sink(events.select(*keys), path, checkpoint, keys, "ts").trigger(availableNow=True).start().awaitTermination()
    return s.spark.read.parquet(path).select(*keys)


@query
def stream_late_rows(s: Shapes) -> DataFrame:
    """Plays in three batches with a restart before each, the last one held back: once each if on time for their user, else put aside."""
    spark, keys = s.spark, ["ts", "userId", "song", "artist"]
    root, path, late_path, state = (scratch_dir(spark, n) for n in ("plays", "on-time", "late", "late-state"))
    plays, early, late = s["listen_events"].select(*keys, "itemInSession"), F.col("ts") < CUT_MILLIS, F.expr(HELD_BACK)
    schema = s["listen_events"].select(*keys).schema
    for part in (early & ~late, ~early & ~late, late):  # a batch each: a start takes all files that are new
        plays.where(part).select(*keys).write.mode("append").parquet(root)
        stream = spark.readStream.schema(schema).parquet(root)
        judged = with_lateness(stream, ["userId"], keys)
        split_sink(judged, path, late_path, state).trigger(availableNow=True).start().awaitTermination()
    sides = {"on time": path, "late": late_path}
    on_time, put_aside = (spark.read.parquet(p).select(*keys, F.lit(n).alias("side")) for n, p in sides.items())
    return on_time.unionByName(put_aside)


@query
def stream_dedup_native(s: Shapes) -> DataFrame:
    """Repeats of one batch dropped within the watermark, by Spark's own state."""
    spark, keys = s.spark, ["ts", "userId", "song", "artist"]
    root, path, state = (scratch_dir(spark, n) for n in ("plays", "native", "native-state"))
    s["listen_events"].select(*keys).write.parquet(root)  # without a bound on its files a batch takes them all
    stream = spark.readStream.schema(s["listen_events"].select(*keys).schema).parquet(root)
    events = dedup_stream(stream.withColumn("ts", F.timestamp_millis("ts")), keys, "ts")
    events.writeStream.option("checkpointLocation", state).format("parquet").option("path", path).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(path).select(*keys)


def topic_query(topic: str) -> None:
    def run(s: Shapes) -> DataFrame:
        """Every field of a topic through the ingest, in several batches."""
        root = scratch_dir(s.spark, "messages")
        names = WIRE[topic].names
        sent = s[topic].select(F.to_json(F.struct(*names)).alias("value")) if set(names) <= set(s[topic].columns) else (
            s[topic].select(F.to_json(F.struct(*[n for n in names if n in s[topic].columns])).alias("value"))
        )
        sent.repartition(24).write.text(f"{root}/{topic}")
        settings = IngestSettings(
            lake_root=scratch_dir(s.spark, "ingest"), checkpoint_root=scratch_dir(s.spark, "ingest-state"), source="files",
            files_root=root, run_once=True, max_files_per_trigger=8,
        )
        for started in start_topic(s.spark, settings, topic):
            started.awaitTermination()
        return s.spark.read.parquet(settings.sink_path(topic)).select(*names)

    run.__name__ = f"stream_decode_{topic}"
    query(run)


for _topic in WIRE:
    if _topic != "listen_events":
        topic_query(_topic)
