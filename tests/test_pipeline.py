"""Stored models: full refresh, increments, repeats."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tracklake.plans import core, marts, staging
from tracklake.plans.models import MODELS, Models
from tracklake.plans.refresh import LAYOUTS, refresh
from tracklake.testbed.queries import CUT_MILLIS
from tracklake.testbed.shapes import Shapes

from .conftest import SMALL, rows


@pytest.fixture(scope="module")
def shapes(spark):
    return Shapes(spark, SMALL)


class Before(dict):
    """The raw tables as they were at the cut."""

    def __init__(self, shapes):
        names = ("listen_events", "page_view_events", "status_change_events", "user_info")
        super().__init__({n: shapes[n].where(F.col("ts") < CUT_MILLIS) for n in names})
        self.update({n: shapes[n] for n in ("songs", "locations")})


def test_increment_equals_full_build_and_repeats_change_nothing(spark, shapes, tmp_path):
    root = str(tmp_path / "wh")
    names = (
        "stg_listen_events", "stg_status_change_events", "stg_users", "dim_users", "dim_songs", "dim_locations",
        "fact_listen_events", "fact_status_change_events",
    )
    refresh(spark, root, Before(shapes), names=names)
    for _ in range(2):
        tables = refresh(spark, root, shapes, names=names)
        whole = Models(shapes)
        for name in ("stg_listen_events", "stg_status_change_events", "stg_users", "fact_status_change_events"):
            columns = whole[name].columns
            assert rows(tables[name], *columns) == rows(whole[name], *columns), name
        assert tables["fact_listen_events"].count() == tables["stg_listen_events"].count()


def test_facts_from_a_day_leave_earlier_days_alone(spark, shapes, tmp_path):
    root = str(tmp_path / "wh")
    names = ("stg_status_change_events", "dim_users", "fact_status_change_events")
    refresh(spark, root, Before(shapes), names=names)
    fact = tmp_path / "wh" / "fact_status_change_events"
    written = {p: p.stat().st_mtime_ns for p in fact.glob("event_date=*/*.parquet")}
    tables = refresh(spark, root, shapes, names=names, facts_from=date(2024, 1, 15))
    early = [p for p in written if p.parent.name < "event_date=2024-01-15"]
    assert early and all(p.exists() and p.stat().st_mtime_ns == written[p] for p in early)
    whole = Models(shapes)["fact_status_change_events"]
    keys = ("status_change_event_key", "event_datetime", "prev_level", "next_level")
    assert rows(tables["fact_status_change_events"], *keys) == rows(whole, *keys)


def test_late_rows_beyond_the_lateness_are_lost_and_countable(spark, shapes, tmp_path):
    root, name = str(tmp_path / "wh"), "stg_status_change_events"
    raw = shapes["status_change_events"]
    newest = raw.agg(F.max("ts")).first()[0]
    late = {"status_change_events": raw.where(F.col("ts") != newest)}
    refresh(spark, root, {"status_change_events": raw.where(F.col("ts") == newest)}, names=(name,))
    tables = refresh(spark, root, late, names=(name,), lateness=timedelta(hours=3))
    kept = raw.where(F.col("ts") > newest - 3 * 3_600_000).select("ts", "userId", "level").distinct().count()
    assert tables[name].count() == kept


def test_layouts_name_known_models_and_partition_pruning_works(spark, shapes, tmp_path):
    assert set(LAYOUTS) <= set(MODELS)
    tables = refresh(spark, str(tmp_path / "wh"), shapes, names=("stg_listen_events",))
    day = tables.stored("stg_listen_events").where(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == Models(shapes)["stg_listen_events"].where("date(event_datetime) = '2024-01-05'").count()


def test_reemitted_user_keeps_first_emission(spark, ts):
    schema = "event_datetime timestamp, bucket_ingestion_datetime timestamp, user_id bigint, first_name string"
    known = spark.createDataFrame([(ts("01-01 10:05"), ts("01-01 10:00"), 1, "a"), (ts("01-01 11:00"), ts("01-01 11:00"), 2, "b")], schema)
    again = spark.createDataFrame([(ts("01-03 10:05"), ts("01-03 10:00"), 1, "A"), (ts("01-03 11:00"), ts("01-03 11:00"), 3, "c")], schema)
    got = rows(staging.merged_users(known, again), "user_id", "first_name", "event_datetime")
    assert got == [(1, "A", ts("01-01 10:05")), (2, "b", ts("01-01 11:00")), (3, "c", ts("01-03 11:00"))]


PAGE_VIEW = (
    "event_datetime timestamp, bucket_ingestion_datetime timestamp, user_id bigint, postal_code string, city string, "
    "state string, level string, session_id bigint, item_in_session bigint, page string, user_agent string, ad_revenue double"
)


def view(ts, time, item, page, level="free", postal="1", session=1, revenue=0.0):
    return (ts(time), ts(time), 1, postal, "C", "S", level, session, item, page, "ua", revenue)


def test_session_facts_edges(spark, ts):
    df = spark.createDataFrame(
        [
            view(ts, "01-01 10:00:00", 0, "NextSong"),
            view(ts, "01-01 10:00:00", 0, "Home"),  # a second page at the first position
            view(ts, "01-01 10:00:00", 0, "Home", revenue=9.0),  # a repeat counts once
            view(ts, "01-01 10:05:00", 1, "PlayAd", revenue=0.5),
            view(ts, "01-01 10:06:00", 2, "Home", level="paid"),  # upgrade splits the session
            view(ts, "01-01 10:07:00", 3, "Home", postal=None),  # no key, no session
            view(ts, "01-01 10:08:00", None, "Home", session=2),  # no position, no first page
        ],
        PAGE_VIEW,
    )
    got = rows(core.session_facts(df), "level", "first_page", "num_pages_visited", "session_seconds", "num_ads_served", "total_ad_revenue")
    assert got == [("free", "Home", 3, 300, 1, 0.5), ("paid", "Home", 1, 0, 0, 0.0)]


def test_session_quality_edges(spark, ts):
    def session(n, minutes, events):
        last = f"01-01 10:{minutes:02d}:00"
        return [view(ts, "01-01 10:00:00", i, "Home", session=n) for i in range(events - 1)] + [view(ts, last, events, "Home", session=n)]

    data = session(1, 9, 50) + session(2, 10, 51) + session(3, 29, 2) + session(4, 30, 2)
    quality = marts.mart_session_quality_analysis(spark.createDataFrame(data, PAGE_VIEW))
    got = rows(quality, "session_id", "session_quality_tier", "user_engagement_level")
    assert got == [
        (1, "Short Session", "Passive"),
        (2, "Medium Quality", "Highly Active"),
        (3, "Medium Quality", "Passive"),
        (4, "High Quality", "Passive"),
    ]


def test_listen_dedup_and_na_titles(spark):
    raw = spark.createDataFrame(
        [("a", "x", 1.0, 1000, "paid", 7), ("a", "x", 1.0, 1000, "free", 7), ("a", "NA", 1.0, 2000, "free", 7)],
        "artist string, song string, duration double, ts bigint, level string, userId bigint",
    ).withColumns({c: F.lit(None).cast(t) for c, t in {"zip": "bigint", "city": "string", "state": "string"}.items()})
    staged = staging.stg_listen_events(raw)
    assert rows(staged, "song", "level", "city", "postal_code") == [("NA", "free", "NO CITY", None), ("x", "free", "NO CITY", None)]
    assert rows(marts.mart_daily_trending_songs(staged), "song", "play_count", "rank") == [("x", 1, 1)]
