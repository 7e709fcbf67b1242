"""Daily marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    days_segment,
    elapsed,
    engagement_label,
    exact_sum,
    ratio_or_zero,
    round_half_up,
    safe_share,
    session_tier,
    surrogate_key,
)
from ..operators import dense_rank_within, keep_first

TOP_SONGS = 10


def _day() -> Column:
    return F.to_date("event_datetime").alias("activity_date")


def mart_daily_trending_songs(listens: DataFrame) -> DataFrame:
    """Plays and listeners per day, song and artist, ranked by plays within the day.

    Plays are counted per listener first. That shuffle takes the weight off hot
    songs, and the rows and their ranks are both made from it.
    """
    per_listener = (
        listens.where(F.col("song") != "NA")
        .groupBy(_day(), "song", "artist", "user_id")
        .agg(F.count(F.lit(1)).alias("_plays"))
    )
    daily = per_listener.groupBy("activity_date", "song", "artist").agg(
        F.sum("_plays").alias("play_count"), F.count("user_id").alias("unique_listeners")
    )
    ranked = dense_rank_within(daily, ["activity_date"], "play_count", "rank")
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def mart_fact_song_daily_performance(trending: DataFrame, top: int = TOP_SONGS) -> DataFrame:
    """Trending songs with the day's totals and each song's share of its plays."""
    totals = trending.groupBy("activity_date").agg(
        F.sum("play_count").alias("total_daily_plays"),
        F.sum("unique_listeners").alias("total_daily_unique_listeners"),
    )
    rows = trending.join(totals, "activity_date", "left")
    return rows.select(
        surrogate_key(rows, ["activity_date", "song", "artist"]).alias("song_daily_fact_key"),
        "activity_date",
        "song",
        "artist",
        "play_count",
        "unique_listeners",
        F.col("rank").alias("daily_rank"),
        "total_daily_plays",
        "total_daily_unique_listeners",
        safe_share(F.col("play_count"), F.col("total_daily_plays")).alias("play_share_pct"),
        F.coalesce(F.col("rank") <= top, F.lit(False)).alias("is_top_10_song"),
    )


def mart_user_behavior_daily(page_views: DataFrame, listens: DataFrame) -> DataFrame:
    def clicks(page: str):
        return F.count_if(F.col("page") == page)

    pages = page_views.groupBy("user_id", _day()).agg(
        clicks("NextSong").alias("next_song_clicks"),
        clicks("Settings").alias("settings_clicks"),
        clicks("Help").alias("help_clicks"),
        clicks("Error").alias("error_count"),
        F.count_distinct("session_id").alias("total_sessions"),
    )
    listening = listens.groupBy("user_id", _day()).agg(exact_sum(F.col("duration")).alias("_listened"))
    return (
        pages.join(listening, ["user_id", "activity_date"], "left")
        .withColumn("total_listening_time", F.coalesce("_listened", F.lit(0.0)))
        .drop("_listened")
    )


def mart_user_listening_stats(listens: DataFrame, users: DataFrame) -> DataFrame:
    """Listening per user and day with the user's current version."""
    activity = listens.groupBy("user_id", _day()).agg(
        F.count("song").alias("total_songs_listened"),
        exact_sum(F.col("duration")).alias("_seconds"),
        F.count_distinct("artist").alias("unique_artists_listened"),
    )
    current = keep_first(
        users,
        ["user_id"],
        [F.col("row_effective_datetime").desc_nulls_last(), F.col("row_expiry_datetime").desc_nulls_last()]
        + [F.col(c).asc_nulls_last() for c in ("level", "first_name", "last_name", "gender")],
    ).select("user_id", "first_name", "last_name", "gender", F.col("level").alias("user_tier"))
    return activity.join(current, "user_id").select(
        "user_id",
        "first_name",
        "last_name",
        "gender",
        "user_tier",
        "activity_date",
        "total_songs_listened",
        round_half_up(F.col("_seconds") / 60, 2).alias("total_listening_minutes"),
        "unique_artists_listened",
    )


def mart_session_quality_analysis(
    page_views: DataFrame, high_minutes: int = 30, medium_minutes: int = 10, active_events: int = 50
) -> DataFrame:
    sessions = page_views.groupBy("user_id", "session_id").agg(
        F.min("event_datetime").alias("session_start_datetime"),
        F.max("event_datetime").alias("session_end_datetime"),
        F.count(F.lit(1)).alias("total_events_in_session"),
    )
    minutes = elapsed("MINUTE", F.col("session_start_datetime"), F.col("session_end_datetime"))
    return sessions.select(
        "user_id",
        "session_id",
        "session_start_datetime",
        "session_end_datetime",
        minutes.alias("session_duration_minutes"),
        "total_events_in_session",
        session_tier(minutes, high_minutes, medium_minutes).alias("session_quality_tier"),
        engagement_label(F.col("total_events_in_session"), active_events).alias("user_engagement_level"),
    )


def mart_user_subscription_journey(users: DataFrame, status: DataFrame) -> DataFrame:
    """Days from registration to the first upgrade, and the segment they fall in."""
    registered = users.groupBy("user_id").agg(
        F.min("registration_datetime").alias("registration_datetime"),
        F.min("first_name").alias("first_name"),
        F.min("last_name").alias("last_name"),
    )
    upgraded = (
        status.where(F.lower("prev_level") == "free")
        .groupBy("user_id")
        .agg(F.min("event_datetime").alias("subscription_upgrade_datetime"))
    )
    days = elapsed("DAY", F.col("registration_datetime"), F.col("subscription_upgrade_datetime"))
    return registered.join(upgraded, "user_id", "left").select(
        "user_id",
        "first_name",
        "last_name",
        "registration_datetime",
        "subscription_upgrade_datetime",
        days.alias("days_to_upgrade"),
        days_segment(F.col("subscription_upgrade_datetime"), days).alias("user_subscription_segment"),
    )


def mart_fact_user_daily_activity(behavior: DataFrame, listening: DataFrame, journey: DataFrame) -> DataFrame:
    """The user-day marts side by side."""
    rows = behavior.join(
        listening.select(
            "user_id", "activity_date", "total_songs_listened", "total_listening_minutes", "unique_artists_listened"
        ),
        ["user_id", "activity_date"],
        "left",
    ).join(journey.select("user_id", "user_subscription_segment", "days_to_upgrade"), "user_id", "left")
    return rows.select(
        surrogate_key(rows, ["user_id", "activity_date"]).alias("user_activity_fact_key"),
        "user_id",
        "activity_date",
        F.coalesce("user_subscription_segment", F.lit("Unknown")).alias("subscription_segment"),
        "days_to_upgrade",
        "total_sessions",
        "next_song_clicks",
        "settings_clicks",
        "help_clicks",
        "error_count",
        F.coalesce("total_songs_listened", F.lit(0)).alias("total_songs_listened"),
        F.coalesce("unique_artists_listened", F.lit(0)).alias("unique_artists_listened"),
        F.coalesce("total_listening_minutes", F.lit(0.0)).alias("total_listening_minutes"),
        F.coalesce("total_listening_time", F.lit(0.0)).alias("total_listening_time_seconds"),
        ratio_or_zero(F.col("next_song_clicks"), F.col("total_sessions")).alias("avg_next_song_clicks_per_session"),
    )
