"""The declared data checks of the models.

Fixed values: what is checked, and how severe a failure is, model by model.
"""

from __future__ import annotations

from ..operators.quality import Check

LEVELS = ("free", "paid")


def _unique(model: str, column: str, severity: str = "error") -> Check:
    return Check(model, "unique", (column,), severity)


def _combination(model: str, *columns: str) -> Check:
    return Check(model, "unique_combination", columns)


def _not_null(model: str, *columns: str, severity: str = "error") -> list[Check]:
    return [Check(model, "not_null", (c,), severity) for c in columns]


def _levels(model: str, column: str) -> Check:
    return Check(model, "accepted_values", (column,), values=LEVELS)


def _refers(model: str, column: str, parent: str, parent_column: str | None = None) -> Check:
    return Check(model, "relationships", (column,), parent=parent, parent_column=parent_column or column)


def _range(model: str, column: str, low=0, high=None, inclusive=True, severity="warn") -> Check:
    return Check(model, "accepted_range", (column,), severity, low=low, high=high, inclusive=inclusive)


CHECKS: list[Check] = [
    # staging
    _levels("stg_users", "level"),
    _combination("stg_status_change_events", "event_datetime", "user_id", "prev_level"),
    _levels("stg_status_change_events", "prev_level"),
    _combination(
        "stg_listen_events",
        "event_datetime",
        "user_id",
        "postal_code",
        "city",
        "state",
        "song",
        "artist",
        "duration",
    ),
    _levels("stg_listen_events", "level"),
    *_not_null("stg_listen_events", "song", "artist", "duration"),
    _range("stg_listen_events", "duration", inclusive=False, severity="error"),
    _combination("stg_page_view_events", "event_datetime", "user_id", "session_id", "item_in_session"),
    _levels("stg_page_view_events", "level"),
    # dimensions
    _combination("dim_users", "user_id", "row_effective_datetime"),
    _unique("dim_songs", "pk_song"),
    *_not_null("dim_songs", "pk_song"),
    *_not_null("dim_songs", "artist", "title", "duration", severity="warn"),
    _range("dim_songs", "duration", inclusive=False),
    _unique("dim_locations", "pk_location"),
    *_not_null("dim_locations", "pk_location", "country_code", "standardised_postal_code"),
    # facts
    _unique("fact_listen_events", "listen_event_key"),
    *_not_null("fact_listen_events", "listen_event_key", "pk_song"),
    _refers("fact_listen_events", "pk_user", "dim_users"),
    _refers("fact_listen_events", "pk_song", "dim_songs"),
    _refers("fact_listen_events", "pk_location", "dim_locations"),
    _combination("fact_session_events", "session_start_datetime", "session_id", "pk_user"),
    _refers("fact_session_events", "pk_user", "dim_users"),
    _refers("fact_session_events", "pk_entry_page", "dim_pages", "pk_page"),
    _refers("fact_session_events", "pk_location", "dim_locations"),
    *_not_null("fact_session_events", "session_seconds", "num_pages_visited", severity="warn"),
    _range("fact_session_events", "session_seconds", inclusive=False),
    _range("fact_session_events", "num_pages_visited", inclusive=False),
    _range("fact_session_events", "num_ads_served"),
    _range("fact_session_events", "total_ad_revenue"),
    _unique("fact_status_change_events", "status_change_event_key"),
    *_not_null("fact_status_change_events", "status_change_event_key"),
    _refers("fact_status_change_events", "pk_user", "dim_users"),
    _levels("fact_status_change_events", "prev_level"),
    _levels("fact_status_change_events", "next_level"),
    # marts
    _unique("mart_fact_user_daily_activity", "user_activity_fact_key"),
    *_not_null("mart_fact_user_daily_activity", "user_activity_fact_key", "user_id", "activity_date"),
    _range("mart_fact_user_daily_activity", "total_sessions"),
    _range("mart_fact_user_daily_activity", "total_songs_listened"),
    _unique("mart_fact_song_daily_performance", "song_daily_fact_key"),
    *_not_null("mart_fact_song_daily_performance", "song_daily_fact_key", "activity_date", "song", "artist"),
    _range("mart_fact_song_daily_performance", "play_count"),
    _range("mart_fact_song_daily_performance", "play_share_pct", high=1),
]
