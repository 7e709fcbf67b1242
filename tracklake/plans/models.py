"""All models over one set of raw tables, each built when first asked for."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from . import core, marts, staging

STAGING = ("stg_listen_events", "stg_page_view_events", "stg_status_change_events", "stg_users")
DIMENSIONS = ("dim_users", "dim_songs", "dim_locations", "dim_pages")
FACTS = ("fact_listen_events", "fact_session_events", "fact_status_change_events")
MARTS = (
    "mart_daily_trending_songs",
    "mart_fact_song_daily_performance",
    "mart_user_behavior_daily",
    "mart_user_listening_stats",
    "mart_session_quality_analysis",
    "mart_user_subscription_journey",
    "mart_fact_user_daily_activity",
)
MODELS = STAGING + DIMENSIONS + FACTS + MARTS


class Models(Mapping):
    """Model name to lazy DataFrame.

    ``raw`` maps listen_events, page_view_events, status_change_events, user_info,
    songs and locations to DataFrames. ``stored`` may give models that are already
    tables, which are then read instead of computed.
    """

    def __init__(self, raw: Mapping[str, DataFrame], stored: Mapping[str, DataFrame] | None = None):
        self.raw, self.stored = raw, stored if stored is not None else {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(name)
        return self.stored[name] if name in self.stored else getattr(self, name)

    def __iter__(self):
        return iter(MODELS)

    def __len__(self) -> int:
        return len(MODELS)

    @cached_property
    def stg_listen_events(self) -> DataFrame:
        return staging.stg_listen_events(self.raw["listen_events"])

    @cached_property
    def stg_page_view_events(self) -> DataFrame:
        return staging.stg_page_view_events(self.raw["page_view_events"])

    @cached_property
    def stg_status_change_events(self) -> DataFrame:
        return staging.stg_status_change_events(self.raw["status_change_events"])

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw["user_info"])

    @cached_property
    def dim_users(self) -> DataFrame:
        return core.dim_users(self["stg_users"], self["stg_status_change_events"])

    @cached_property
    def dim_songs(self) -> DataFrame:
        return core.dim_songs(self.raw["songs"])

    @cached_property
    def dim_locations(self) -> DataFrame:
        return core.dim_locations(self.raw["locations"])

    @cached_property
    def dim_pages(self) -> DataFrame:
        return core.dim_pages(self["stg_page_view_events"])

    @cached_property
    def fact_listen_events(self) -> DataFrame:
        return core.fact_listen_events(
            self["stg_listen_events"], self["dim_songs"], self["dim_users"], self["dim_locations"]
        )

    @cached_property
    def fact_session_events(self) -> DataFrame:
        return core.fact_session_events(
            self["stg_page_view_events"], self["dim_users"], self["dim_locations"], self["dim_pages"]
        )

    @cached_property
    def fact_status_change_events(self) -> DataFrame:
        return core.fact_status_change_events(self["stg_status_change_events"], self["dim_users"])

    @cached_property
    def mart_daily_trending_songs(self) -> DataFrame:
        return marts.mart_daily_trending_songs(self["stg_listen_events"])

    @cached_property
    def mart_fact_song_daily_performance(self) -> DataFrame:
        return marts.mart_fact_song_daily_performance(self["mart_daily_trending_songs"])

    @cached_property
    def mart_user_behavior_daily(self) -> DataFrame:
        return marts.mart_user_behavior_daily(self["stg_page_view_events"], self["stg_listen_events"])

    @cached_property
    def mart_user_listening_stats(self) -> DataFrame:
        return marts.mart_user_listening_stats(self["stg_listen_events"], self["dim_users"])

    @cached_property
    def mart_session_quality_analysis(self) -> DataFrame:
        return marts.mart_session_quality_analysis(self["stg_page_view_events"])

    @cached_property
    def mart_user_subscription_journey(self) -> DataFrame:
        return marts.mart_user_subscription_journey(self["stg_users"], self["stg_status_change_events"])

    @cached_property
    def mart_fact_user_daily_activity(self) -> DataFrame:
        return marts.mart_fact_user_daily_activity(
            self["mart_user_behavior_daily"],
            self["mart_user_listening_stats"],
            self["mart_user_subscription_journey"],
        )
