"""Staging: raw event tables with typed times, clean text and one row per event."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hour_bucket, millis_to_timestamp, normalize_title, round_half_up, strip_quotes
from ..operators import drop_repeats, field_or_null, keep_first, merge_rows, since
from ..operators.incremental import LATENESS

LISTEN_KEY = ["event_datetime", "user_id", "postal_code", "city", "state", "song", "artist", "duration"]
STATUS_KEY = ["event_datetime", "user_id", "prev_level"]
USER_KEY = ["user_id"]


def _times(millis: str = "ts") -> list:
    instant = millis_to_timestamp(F.col(millis))
    return [instant.alias("event_datetime"), hour_bucket(instant).alias("bucket_ingestion_datetime")]


def _place() -> list:
    return [
        F.col("zip").cast("string").alias("postal_code"),
        F.coalesce("city", F.lit("NO CITY")).alias("city"),
        F.coalesce("state", F.lit("NO STATE")).alias("state"),
    ]


def stg_listen_events(raw: DataFrame, mark: datetime | None = None, lateness: timedelta = LATENESS) -> DataFrame:
    """Listens newer than ``mark`` (all on a first run), one per key; of several levels the smallest."""
    rows = since(raw, mark, "ts", lateness).select(
        *_times(),
        F.col("userId").alias("user_id"),
        *_place(),
        "level",
        normalize_title(F.col("song")).alias("song"),
        "artist",
        round_half_up(F.col("duration"), 2).alias("duration"),
    )
    return keep_first(rows, LISTEN_KEY, [F.col("level").asc_nulls_last()])


def stg_page_view_events(raw: DataFrame) -> DataFrame:
    """Page views of logged-in users. ``ad_revenue`` may be absent from the source."""
    revenue, _ = field_or_null(raw, "ad_revenue")
    return raw.where(F.col("auth") == "Logged In").select(
        *_times(),
        F.col("userId").alias("user_id"),
        *_place(),
        "level",
        F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
        "page",
        strip_quotes(F.col("userAgent")).alias("user_agent"),
        F.coalesce(revenue.try_cast("double"), F.lit(0.0)).alias("ad_revenue"),
    )


def stg_status_change_events(
    raw: DataFrame, mark: datetime | None = None, lateness: timedelta = LATENESS
) -> DataFrame:
    """Level changes, one per time, user and previous level."""
    rows = since(raw, mark, "ts", lateness).select(
        *_times(), F.col("userId").alias("user_id"), F.lower("level").alias("prev_level")
    )
    return drop_repeats(rows, STATUS_KEY)


def stg_users(raw: DataFrame, mark: datetime | None = None, lateness: timedelta = LATENESS) -> DataFrame:
    """First emission of each user record; the source repeats records."""
    level, _ = field_or_null(raw, "level")
    grouped = (
        since(raw, mark, "ts", lateness)
        .select(
            "ts",
            F.col("userId").alias("user_id"),
            F.col("firstName").alias("first_name"),
            F.col("lastName").alias("last_name"),
            "gender",
            F.coalesce(level, F.lit("free")).alias("level"),
            "registration",
        )
        .groupBy("user_id", "first_name", "last_name", "gender", "level", "registration")
        .agg(F.min("ts").alias("ts"))
    )
    return grouped.select(
        *_times(),
        "user_id",
        "first_name",
        "last_name",
        "gender",
        "level",
        millis_to_timestamp(F.col("registration")).alias("registration_datetime"),
    )


def keep_first_emission(known: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates of known users, with the earlier of the two first emissions.

    An increment only sees new rows; without this a re-emitted user would move
    to a later start and lose the changes in between.
    """
    old = known.select(
        F.col("user_id").alias("_id"),
        F.col("event_datetime").alias("_first"),
        F.col("bucket_ingestion_datetime").alias("_bucket"),
    )
    joined = updates.join(old, updates["user_id"].eqNullSafe(old["_id"]), "left")
    return joined.withColumns(
        {
            "event_datetime": F.least("event_datetime", "_first"),
            "bucket_ingestion_datetime": F.least("bucket_ingestion_datetime", "_bucket"),
        }
    ).drop("_id", "_first", "_bucket")


def merged_users(known: DataFrame, updates: DataFrame) -> DataFrame:
    """The users table after an increment."""
    return merge_rows(known, keep_first_emission(known, updates), USER_KEY)
