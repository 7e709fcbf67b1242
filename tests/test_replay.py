"""Replay of the archive: starting points, batches, restarts, lost files. Supervision: a failed query alone starts again."""

from __future__ import annotations

import glob
import os
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tracklake.settings import IngestSettings
from tracklake.sources import event_stream, file_stream, replay_stream
from tracklake.streaming import health, keep_running, start_archive

from .conftest import rows

HOUR = 3_600_000
JAN_2 = 1_704_153_600_000


def archive(spark, folder, values, at, batch):
    """Messages of one batch, added to the archive by its own query."""
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")
    sent = file_stream(spark, f"{folder}/in", "listen_events")
    hour = F.timestamp_millis(F.lit(at))
    start_archive(sent, f"{folder}/archive", f"{folder}/archive-state", run_once=True, at=hour).awaitTermination()


def drain(spark, folder, messages):
    """Values in order of their batch: (batch, value)."""
    writer = messages.withColumn("value", F.col("value").cast("string")).writeStream.option("checkpointLocation", f"{folder}/state")

    def store(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{folder}/out")

    writer.foreachBatch(store).trigger(availableNow=True).start().awaitTermination()
    return rows(spark.read.parquet(f"{folder}/out"), "value")


@pytest.fixture
def archived(spark, tmp_path):
    for n in range(3):  # hours 0, 1 and 2 of a day
        archive(spark, tmp_path, [f"m{n}a", f"m{n}b"], JAN_2 + n * HOUR, n)
    return str(tmp_path)


def test_start_batches_and_restart(spark, archived, tmp_path):
    root = f"{archived}/archive"
    whole = str(tmp_path / "whole")
    assert drain(spark, whole, replay_stream(spark, root, "listen_events", max_files_per_trigger=1)) == [(f"m{n}{c}",) for n in range(3) for c in "ab"]
    batches = spark.read.parquet(f"{whole}/out").groupBy("batch").count()
    assert rows(batches, "count") == [(2,)] * 3
    archive(spark, archived, ["late"], JAN_2, 3)  # into the first hour's folder, after a later one was read
    again = drain(spark, whole, replay_stream(spark, root, "listen_events", max_files_per_trigger=1))
    assert again == [("late",)] + [(f"m{n}{c}",) for n in range(3) for c in "ab"]
    from_hour = replay_stream(spark, root, "listen_events", "2024-01-02T01")
    assert drain(spark, str(tmp_path / "hour"), from_hour) == [(f"m{n}{c}",) for n in (1, 2) for c in "ab"]
    assert drain(spark, str(tmp_path / "other"), replay_stream(spark, root, "user_info")) == []
    with pytest.raises(ValueError):
        replay_stream(spark, root, "listen_events", "yesterday")
    with pytest.raises(ValueError):
        replay_stream(spark, root, "listen_events", "latest")


def test_latest_is_fixed_at_the_first_start(spark, archived, tmp_path):
    settings = IngestSettings(
        lake_root=str(tmp_path / "lake"), checkpoint_root=str(tmp_path / "checkpoint"), source="archive",
        files_root=f"{archived}/archive", starting_offsets="latest",
    )
    out = str(tmp_path / "latest")
    assert drain(spark, out, event_stream(spark, settings, "listen_events")) == []
    archive(spark, archived, ["while down"], JAN_2, 3)
    assert drain(spark, out, event_stream(spark, settings, "listen_events")) == [("while down",)]
    assert len(drain(spark, str(tmp_path / "all"), event_stream(spark, replace(settings, starting_offsets="earliest"), "listen_events"))) == 7


def test_a_lost_file_is_skipped_or_an_error(spark, archived, tmp_path):
    lost = glob.glob(f"{archived}/archive/topic=listen_events/date=2024-01-02 01*/*.gz")
    assert len(lost) == 1
    os.remove(lost[0])
    root = f"{archived}/archive"
    assert drain(spark, str(tmp_path / "lenient"), replay_stream(spark, root, "listen_events")) == [(f"m{n}{c}",) for n in (0, 2) for c in "ab"]
    for starting in ("earliest", "2024-01-02T01"):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
            replay_stream(spark, root, "listen_events", starting, fail_on_data_loss=True)
    later = replay_stream(spark, root, "listen_events", "2024-01-02T02", fail_on_data_loss=True)
    assert drain(spark, str(tmp_path / "strict"), later) == [("m2a",), ("m2b",)]


def counted(spark, folder, name, fail_times, ran):
    spark.range(0, 5, 1, 5).selectExpr("CAST(id AS string) AS value").write.text(f"{folder}/{name}-in")
    messages = file_stream(spark, f"{folder}/{name}-in", name, 1)

    def store(batch, number):
        ran.append((name, number))
        if number == 2 and ran.count((name, number)) <= fail_times:
            raise RuntimeError(f"{name} fails")
        batch.select(F.col("value").cast("string").alias("value")).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")

    return messages.writeStream.option("checkpointLocation", f"{folder}/{name}-state").foreachBatch(store).trigger(availableNow=True)


def test_only_the_failed_query_starts_again(spark, tmp_path):
    ran, reports = [], []
    writers = {name: counted(spark, tmp_path, name, times, ran) for name, times in (("a", 0), ("b", 2), ("c", 0))}
    keep_running(spark, writers, attempts=2, pause=0.1, poll=0.1, report=reports.append)
    for name in writers:
        assert rows(spark.read.parquet(str(tmp_path / name)), "value") == [(str(k),) for k in range(5)]
    assert [ran.count(("b", k)) for k in range(5)] == [1, 1, 3, 1, 1]
    assert all(ran.count((name, k)) == 1 for name in "ac" for k in range(5))
    assert sorted((r["query"], r["failures"], r["error"] is None) for r in reports) == [
        ("a", 0, True), ("b", 1, False), ("b", 2, False), ("b", 2, True), ("c", 0, True),
    ]
    assert {r["query"]: r["last_batch"] for r in reports if r["error"] is None} == {"a": 4, "b": 4, "c": 4}


def test_a_query_that_keeps_failing_is_raised(spark, tmp_path):
    ran = []
    endless = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "rate"))
    with pytest.raises(StreamingQueryException):
        keep_running(spark, {"x": counted(spark, tmp_path, "x", 99, ran), "endless": endless}, attempts=1, pause=0.1, poll=0.1)
    assert ran.count(("x", 2)) == 2 and not spark.streams.active


def test_health_of_a_query(spark, tmp_path):
    query = counted(spark, tmp_path, "h", 0, []).start()
    query.awaitTermination()
    row = health("h", query, 0)
    assert row["recent_rows"] == 5 and not row["active"] and row["error"] is None
