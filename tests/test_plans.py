"""The plans of the models are the ones meant."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tracklake.plans.models import MODELS, Models
from tracklake.plans.refresh import refresh
from tracklake.testbed.shapes import Shapes

from .conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The models over stored staging tables and dimensions."""
    names = ("stg_listen_events", "stg_page_view_events", "stg_status_change_events", "stg_users", "dim_users")
    shapes = Shapes(spark, SMALL)
    root = str(tmp_path_factory.mktemp("tables"))
    return Models(shapes, refresh(spark, root, shapes, names=names))


@pytest.mark.parametrize("name", MODELS)
def test_no_model_compares_all_pairs_or_runs_python(stored, name):
    plan = plan_of(stored[name])
    assert not re.search("NestedLoop|Cartesian|Python|BatchEval|ArrowEval", plan)


def test_trending_filters_in_the_scan_and_shares_its_shuffle(stored):
    plan = final_plan(stored["mart_daily_trending_songs"])
    assert "ReusedExchange" in plan
    assert re.search(r"PushedFilters: \[IsNotNull\(song\), Not\(EqualTo\(song,NA\)\)\]", plan)


def test_daily_marts_read_only_the_columns_they_need(stored):
    plan = plan_of(stored["mart_session_quality_analysis"])
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas == ["event_datetime:timestamp,user_id:bigint,session_id:bigint"]


def test_dedup_prunes_before_the_shuffle(spark):
    staged = Models(Shapes(spark, SMALL))["stg_listen_events"]
    assert plan_of(staged).count("WindowGroupLimit") == 2


def test_ordinary_keys_take_one_shuffle_in_the_asof_join(spark, stored, tmp_path):
    from tracklake.plans.core import user_at

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(user_at(stored["stg_listen_events"], stored["dim_users"], "event_datetime"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    left = plan.split("SortMergeJoin [user_id", 1)[1]
    assert "LeftOuter" in left.split("\n")[0]
    events = left.split("FileScan parquet", 1)[0]
    assert events.count("Exchange hashpartitioning") == 1


def test_day_filter_prunes_partitions(stored):
    table = stored.stored.stored("stg_listen_events")
    plan = plan_of(table.where(F.col("event_date") == "2024-01-03"))
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_lag_shuffles_its_rows_once(spark, tmp_path):
    """The carry is joined on the columns the window is partitioned by: no second exchange of the rows."""
    from tracklake.operators import previous_within

    path = str(tmp_path / "rows")
    spark.range(2000).selectExpr("id % 7 AS k", "timestamp_millis(id * 1000) AS t", "id AS payload").write.parquet(path)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(previous_within(spark.read.parquet(path), "k", "t", "before"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # Only the rows carry the payload; the carry table has the four key columns and an edge.
    exchanged = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning", line)]
    after_window = plan.split("Window")[0]
    assert "SortMergeJoin" in after_window and after_window.count("Exchange hashpartitioning") == 0
    assert len(exchanged) <= 4
