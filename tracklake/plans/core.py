"""Star schema: four dimensions and three facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    exact_sum,
    flipped_level,
    match_artist,
    match_title,
    normalize_title,
    page_category,
    round_half_up,
    second_boundaries,
    standard_postal,
    surrogate_key,
)
from ..operators import asof_join, keep_first, lookup_join, nearest_match, user_versions
from .staging import LISTEN_KEY, STATUS_KEY

DURATION_TOLERANCE = 0.01
LOCATION_MATCH = {"city": "city", "state": "state_code", "postal_code": "raw_postal_code"}
VALIDITY = {"start": "row_effective_datetime", "end": "row_expiry_datetime"}


def dim_users(users: DataFrame, status: DataFrame) -> DataFrame:
    """Type-2 users: one row per user and period of constant level."""
    versions = user_versions(users, status)
    return versions.select(surrogate_key(versions, ["user_id", "row_effective_datetime"]).alias("pk_user"), "*")


def dim_songs(songs: DataFrame) -> DataFrame:
    distinct = songs.select(
        "artist",
        normalize_title(F.col("title")).alias("title"),
        round_half_up(F.col("duration"), 2).alias("duration"),
        "genre",
    ).distinct()
    return distinct.select(surrogate_key(distinct, ["artist", "title", "duration"]).alias("pk_song"), "*")


def dim_locations(locations: DataFrame) -> DataFrame:
    """The key is taken from the source columns, before missing names are filled in."""
    key = surrogate_key(locations, ["country_code", "postal_code", "city", "state"])
    return locations.select(
        key.alias("pk_location"),
        "country_code",
        standard_postal(F.col("postal_code"), F.col("country_code")).alias("standardised_postal_code"),
        F.col("postal_code").cast("string").alias("raw_postal_code"),
        F.coalesce("city", F.lit("NO CITY")).alias("city"),
        F.coalesce("state", F.lit("NO STATE")).alias("state"),
        F.col("state_code").cast("string").alias("state_code"),
    ).distinct()


def dim_pages(page_views: DataFrame) -> DataFrame:
    pages = page_views.select(F.col("page").alias("page_name")).distinct()
    return pages.select(
        surrogate_key(pages, ["page_name"]).alias("pk_page"),
        "page_name",
        page_category(F.col("page_name")).alias("page_category"),
    )


def match_songs(listens: DataFrame, songs: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
    """``pk_song`` of the song with the same title and artist and the nearest duration."""
    return nearest_match(
        listens,
        songs,
        left_keys=[match_title(F.col("song")), match_artist(F.col("artist"))],
        right_keys=[match_title(F.col("title")), match_artist(F.col("artist"))],
        left_value=F.col("duration"),
        right_value=F.col("duration"),
        take="pk_song",
        tolerance=DURATION_TOLERANCE,
        keys_from=keys_from,
    )


def user_at(events: DataFrame, users: DataFrame, time: str, keys_from: DataFrame | None = None) -> DataFrame:
    """``pk_user`` of the user version valid at ``time``."""
    return asof_join(events, users, key="user_id", time=time, take=["pk_user"], keys_from=keys_from, **VALIDITY)


def fact_listen_events(
    listens: DataFrame, songs: DataFrame, users: DataFrame, locations: DataFrame
) -> DataFrame:
    """One row per listen with its user version, song and location.

    Each lookup gives at most one value per row, so no ranking over the whole
    fact is needed afterwards. Repeats are removed on the key columns alone.
    """
    rows = listens.select(*LISTEN_KEY).distinct()
    rows = match_songs(rows, songs, keys_from=listens)
    rows = lookup_join(rows, locations, LOCATION_MATCH, "pk_location")
    rows = user_at(rows, users, "event_datetime", keys_from=listens)
    key = ["event_datetime", "user_id", "song", "artist", "duration", "postal_code", "city", "state"]
    return rows.select(
        surrogate_key(rows, key).alias("listen_event_key"), "event_datetime", "pk_user", "pk_location", "pk_song"
    )


SESSION_KEY = ["session_id", "user_id", "postal_code", "city", "state", "level"]


def session_facts(page_views: DataFrame) -> DataFrame:
    """One row per session, address and level, with its first page.

    A page view counts once per time, user, session, position and page. Sessions
    with a NULL in their key have no first page and are left out.
    """
    once = keep_first(
        page_views,
        ["event_datetime", "user_id", "session_id", "item_in_session", "page"],
        [
            F.col(c).asc_nulls_last()
            for c in ("postal_code", "city", "state", "level", "user_agent", "ad_revenue", "bucket_ingestion_datetime")
        ],
    )
    # Of several pages at the first position the alphabetically first one counts.
    entry = F.min(
        F.when(
            F.col("item_in_session").isNotNull(),
            F.struct("item_in_session", F.col("page").isNull().alias("no_page"), "page"),
        )
    )
    return (
        once.dropna(subset=SESSION_KEY)
        .groupBy(*SESSION_KEY)
        .agg(
            entry.alias("_entry"),
            F.count(F.lit(1)).alias("num_pages_visited"),
            F.min("event_datetime").alias("session_start_datetime"),
            F.max("event_datetime").alias("_last"),
            F.count_if(F.col("page") == "PlayAd").alias("num_ads_served"),
            exact_sum(F.col("ad_revenue")).alias("total_ad_revenue"),
        )
        .where(F.col("_entry").isNotNull())
        .select(
            *SESSION_KEY,
            F.col("_entry.page").alias("first_page"),
            "num_pages_visited",
            "session_start_datetime",
            second_boundaries(F.col("session_start_datetime"), F.col("_last")).alias("session_seconds"),
            "num_ads_served",
            "total_ad_revenue",
        )
    )


def fact_session_events(
    page_views: DataFrame, users: DataFrame, locations: DataFrame, pages: DataFrame
) -> DataFrame:
    """One row per session start, session and user."""
    # Parts of a session that start together differ in level or address only.
    sessions = keep_first(
        session_facts(page_views),
        ["session_start_datetime", "session_id", "user_id"],
        [F.col(c).asc_nulls_last() for c in ("level", "postal_code", "city", "state")],
    )
    rows = lookup_join(sessions, locations, LOCATION_MATCH, "pk_location")
    rows = lookup_join(rows, pages, {"first_page": "page_name"}, "pk_page", "pk_entry_page")
    # Sessions start at a page view, so the page views name all times in question.
    starts = page_views.select("user_id", F.col("event_datetime").alias("session_start_datetime"))
    return user_at(rows, users, "session_start_datetime", keys_from=starts).select(
        "session_start_datetime",
        "session_id",
        "pk_user",
        "pk_location",
        "pk_entry_page",
        "session_seconds",
        "num_pages_visited",
        "num_ads_served",
        "total_ad_revenue",
    )


def fact_status_change_events(status: DataFrame, users: DataFrame) -> DataFrame:
    rows = user_at(status.select(*STATUS_KEY).distinct(), users, "event_datetime")
    return rows.select(
        surrogate_key(rows, STATUS_KEY).alias("status_change_event_key"),
        "event_datetime",
        "pk_user",
        "prev_level",
        flipped_level(F.col("prev_level")).alias("next_level"),
    )
