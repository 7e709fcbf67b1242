"""Compaction: the same rows at any time, fewer files, and nothing lost when a run is cut off."""

from __future__ import annotations

import datetime

import pytest

from tracklake.sinks import compact, compaction, read_compacted
from tracklake.sinks.compaction import pack_files

CLOSED = datetime.datetime(2024, 1, 2, 5)


def write(spark, path, first, hours=(3, 4, 5)):
    rows = [(first + k, 2024, 1, 2, hour) for k, hour in enumerate(hours)]
    df = spark.createDataFrame(rows, "id long, year int, month int, day int, hour int")
    df.coalesce(1).write.mode("append").partitionBy("year", "month", "day", "hour").parquet(path)


def ids(df):
    return sorted((r["id"], r["hour"]) for r in df.collect())


def files(df):
    return len(df.inputFiles())


def test_bins_hold_what_fits():
    assert pack_files({"a": 5, "b": 4, "c": 3, "d": 2, "e": 20}, 8) == [["e"], ["a", "c"], ["b", "d"]]
    assert pack_files({}, 8) == []


def test_same_rows_fewer_files(spark, tmp_path):
    sink, target = str(tmp_path / "sink"), str(tmp_path / "packed")
    for k in range(6):
        write(spark, sink, 10 * k)
    want = ids(spark.read.parquet(sink))
    assert ids(read_compacted(spark, sink, target)) == want
    assert compact(spark, sink, target, CLOSED) == 2
    assert ids(read_compacted(spark, sink, target)) == want
    assert files(read_compacted(spark, sink, target)) == 2 + 6  # the open hour is left alone
    assert compact(spark, sink, target, CLOSED) == 0
    write(spark, sink, 100, (3,))  # late, in an hour that is done
    write(spark, sink, 101, (3,))
    assert len(ids(read_compacted(spark, sink, target))) == len(want) + 2
    assert compact(spark, sink, target, CLOSED, bins_per_run=1) == 1
    assert ids(read_compacted(spark, sink, target)) == ids(spark.read.parquet(sink))


def test_rows_without_a_time_are_left_alone(spark, tmp_path):
    sink, target = str(tmp_path / "sink"), str(tmp_path / "packed")
    for k in range(2):
        df = spark.createDataFrame([(k, None, None, None, None)], "id long, year int, month int, day int, hour int")
        df.write.mode("append").partitionBy("year", "month", "day", "hour").parquet(sink)
        write(spark, sink, 10 * k, (3,))
    assert compact(spark, sink, target, CLOSED) == 1
    assert sorted(r["id"] for r in read_compacted(spark, sink, target).collect()) == [0, 0, 1, 10]


def test_a_run_that_is_cut_off_is_not_read(spark, tmp_path, monkeypatch):
    sink, target = str(tmp_path / "sink"), str(tmp_path / "packed")
    for k in range(3):
        write(spark, sink, 10 * k)
    want = ids(spark.read.parquet(sink))

    def fails(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_publish", fails)
        with pytest.raises(RuntimeError):
            compact(spark, sink, target, CLOSED)
    assert ids(read_compacted(spark, sink, target)) == want
    assert compact(spark, sink, target, CLOSED) == 2
    assert ids(read_compacted(spark, sink, target)) == want
