"""Upkeep by arrival: the ledger, spliced users, and facts rebuilt for the days that changed."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracklake import functions as fn
from tracklake.operators import merge_by_key
from tracklake.operators.incremental import replace_keys
from tracklake.plans import advance as upkeep
from tracklake.plans import arrivals
from tracklake.plans.models import Models
from tracklake.plans.refresh import USER_BUCKET, Tables
from tracklake.sinks import write_partitioned
from tracklake.testbed.queries import CUT_MILLIS
from tracklake.testbed.shapes import Shapes

from .conftest import SMALL, rows

SOURCES = ("listen_events", "status_change_events", "user_info")


@pytest.fixture(scope="module")
def shapes(spark):
    return Shapes(spark, SMALL)


def written(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def same(tables, shapes, *names):
    whole = Models(shapes)
    for name in names:
        columns = whole[name].columns
        assert rows(tables[name], *columns) == rows(whole[name], *columns), name


def test_a_late_song_rebuilds_exactly_its_days_even_after_a_crash(spark, shapes, tmp_path, monkeypatch):
    root, songs = str(tmp_path), shapes["songs"]
    day = "date(event_datetime) = '2024-01-09'"
    plays = Models(shapes)["stg_listen_events"]
    # One title that is played on a few days only.
    by_title = plays.where("song <> 'NA'").select(fn.match_title(F.col("song")).alias("t"), F.to_date("event_datetime").alias("d"))
    days = {}
    for r in by_title.distinct().collect():
        days.setdefault(r["t"], set()).add(r["d"])
    title = min((t for t in days if plays.where(day).count() >= 0), key=lambda t: (len(days[t]), t))
    missing = fn.match_title(fn.normalize_title(F.col("title"))) != title
    new = {n: shapes[n] for n in SOURCES}
    upkeep.advance(spark, root, new, songs.where(missing), shapes["locations"])
    fact = tmp_path / "fact_listen_events"
    before = written(fact)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(upkeep, "_rebuild", fail)
        with pytest.raises(RuntimeError):
            upkeep.advance(spark, root, {}, songs, shapes["locations"])
    assert written(fact) == before and (tmp_path / "_journal").exists()
    tables = upkeep.advance(spark, root, {})  # nothing has arrived since, but the journal is not done
    after = written(fact)
    touched = {p.parent.name for p in before.keys() ^ after.keys()} | {p.parent.name for p in before.keys() & after.keys() if before[p] != after[p]}
    assert touched == {f"event_date={d}" for d in days[title]}
    same(tables, shapes, "fact_listen_events", "dim_songs", "fact_status_change_events", "dim_users")
    assert not (tmp_path / "_journal").exists()

    # The same arrivals again, in one go: nothing differs, nothing is written.
    every = written(tmp_path)
    upkeep.advance(spark, root, new, songs, shapes["locations"])
    assert written(tmp_path) == every


def test_only_buckets_of_affected_users_are_read_and_written(spark, shapes, tmp_path):
    root, late = str(tmp_path), F.col("userId") == 7
    users, changes = shapes["user_info"], shapes["status_change_events"]
    last = F.col("ts") >= CUT_MILLIS
    upkeep.advance(spark, root, {"user_info": users, "status_change_events": changes.where(~(late & last))})
    before = written(tmp_path / "dim_users")
    ids = spark.createDataFrame([(7,)], "user_id bigint")
    bucket = ids.select(upkeep.user_bucket()).first()[0]
    plan = upkeep.affected_versions(Tables(spark, root), ids)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"FileScan parquet .*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert len(filters) == plan.count("FileScan parquet") > 0
    assert all(re.search(rf"{USER_BUCKET}#\d+ = {bucket}\)", f) for f in filters)
    tables = upkeep.advance(spark, root, {"status_change_events": changes.where(late & last)})
    after = written(tmp_path / "dim_users")
    touched = {p.parent.name for p in before.keys() ^ after.keys()}
    assert touched == {f"{USER_BUCKET}={bucket}"}
    same(tables, shapes, "dim_users", "stg_status_change_events")


def test_people_without_an_id_share_their_version_across_arrivals(spark, ts, tmp_path):
    def info(user, name, at):
        return (user, name, "L", "F", 1_700_000_000_000, at)

    schema = "userId bigint, firstName string, lastName string, gender string, registration bigint, ts bigint"
    steps = [[info(0, "a", CUT_MILLIS), info(5, "e", CUT_MILLIS)], [info(None, "b", CUT_MILLIS + 1)], [info(5, "f", CUT_MILLIS + 2)]]
    for step in steps:
        tables = upkeep.advance(spark, str(tmp_path), {"user_info": spark.createDataFrame(step, schema)})
    found = rows(tables["dim_users"], "user_id", "first_name", "level")
    assert found == [(0, "NA", "free"), (5, "f", "free")]


def test_empty_arrivals_and_missing_tables(spark, shapes, tmp_path):
    assert list(upkeep.advance(spark, str(tmp_path), {})) == []
    none = {n: shapes[n].limit(0) for n in SOURCES}
    assert list(upkeep.advance(spark, str(tmp_path), none)) == []
    tables = upkeep.advance(spark, str(tmp_path), {"listen_events": shapes["listen_events"].limit(10)})
    assert list(tables) == ["stg_listen_events"]


def test_ledger_names_new_hours_only_and_tells_late_ones(spark, shapes, tmp_path):
    event, lake, table, book = "user_info", str(tmp_path / "lake"), str(tmp_path / "raw"), str(tmp_path / "ledger")
    source = fn.time_parts(shapes[event].withColumn("ts", F.timestamp_millis("ts")), "ts")
    write_partitioned(source, lake, ["year", "month", "day", "hour"])
    hours = sorted(r[0] for r in source.select(F.date_trunc("HOUR", "ts").cast("timestamp_ntz")).distinct().collect())
    late, absent = hours[2], datetime(2030, 1, 1)
    assert arrivals.ledger(spark, book, event).count() == 0
    first = arrivals.load_and_record(spark, lake, event, [h for h in hours[:-3] if h != late] + [absent], table, book)
    lines = arrivals.unsettled(spark, book, event, "a")
    assert sorted(r["slot"] for r in lines.collect()) == first and absent not in first
    assert {(r["first_ms"] <= r["last_ms"], r["rows"] > 0) for r in lines.collect()} == {(True, True)}
    arrivals.settle(book, event, "a", lines)
    assert arrivals.unsettled(spark, book, event, "a").count() == 0
    assert arrivals.unsettled(spark, book, event, "b").count() == len(first)
    arrivals.load_and_record(spark, lake, event, [late, *hours[-3:]], table, book)
    arrivals.load_and_record(spark, lake, event, [hours[-1]], table, book)  # loaded again: a line of its own
    lines = arrivals.unsettled(spark, book, event, "a")
    read = arrivals.arrived(spark, table, event, lines)
    folders = {f.split("/raw/")[1].rsplit("/", 1)[0] for f in read.inputFiles()}
    assert folders == {f"load_year={h.year}/load_month={h.month}/load_day={h.day}/load_hour={h.hour}" for h in [late, *hours[-3:]]}
    assert read.count() == source.where(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").isin([late, *hours[-3:]])).count()
    book_lines = arrivals.ledger(spark, book, event)
    assert [r["slot"] for r in arrivals.late_hours(book_lines).collect()] == [late]
    assert arrivals.late_hours(book_lines, timedelta(days=400)).count() == 0


def test_splice_and_merge_finish_what_was_cut_off(spark, tmp_path, monkeypatch):
    from tracklake import sinks

    path, schema = str(tmp_path / "t"), "k bigint, v string, p int"
    spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "c", 1), (3, "d", 1)], schema).write.partitionBy("p").parquet(path)
    gone = spark.createDataFrame([(1, 0), (9, 0)], "k bigint, p int")
    before = written(tmp_path / "t" / "p=1")
    replace_keys(path, spark.createDataFrame([(1, "x", 0), (1, "y", 0), (9, "n", 0)], schema), gone, ["k"], "p")
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "x"), (1, "y"), (2, "c"), (3, "d"), (9, "n")]
    assert written(tmp_path / "t" / "p=1") == before

    plain = sinks.write_partitioned

    def cut(df, where, *args, **options):
        if where == path:
            raise RuntimeError("lost")
        plain(df, where, *args, **options)

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "write_partitioned", cut)
        with pytest.raises(RuntimeError):
            merge_by_key(path, spark.createDataFrame([(3, "late", 1)], schema), ["k", "v"], "p")
    merge_by_key(path, spark.createDataFrame([(9, "n", 0)], schema), ["k", "v"], "p")
    assert (3, "late") in rows(spark.read.parquet(path), "k", "v")
