"""Lateness as state: what is late is marked, what is on time comes once, and a restart goes on."""

from __future__ import annotations

from datetime import timedelta

import pytest

from tracklake.streaming.lateness import split_sink, with_lateness

from .conftest import rows

SCHEMA = "ts bigint, g string, v string"
MINUTE = 60_000


def test_three_batches_and_a_restart(spark, tmp_path):
    batches = [
        [(100 * MINUTE, "a", "x"), (100 * MINUTE, "a", "x"), (3 * MINUTE, "a", "old but first"), (5 * MINUTE, None, "n"), (None, "a", "t")],
        [(95 * MINUTE, "a", "within"), (100 * MINUTE, "a", "x"), (7 * MINUTE, "b", "other group"), (50 * MINUTE, None, "n")],
        [(89 * MINUTE, "a", "late"), (89 * MINUTE, "a", "late"), (90 * MINUTE, "a", "edge"), (95 * MINUTE, "a", "within"), (39 * MINUTE, None, "late null")],
    ]
    source, on_time, late, state = (str(tmp_path / n) for n in ("in", "on_time", "late", "state"))
    for batch in batches:  # each batch is a query of its own: the state comes back from the checkpoint
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        judged = with_lateness(stream, ["g"], ["ts", "g", "v"], lateness=timedelta(minutes=10))
        split_sink(judged, on_time, late, state).trigger(availableNow=True).start().awaitTermination()
    kept = [(100, "a", "x"), (3, "a", "old but first"), (5, None, "n"), (95, "a", "within"), (7, "b", "other group"), (50, None, "n"), (90, "a", "edge")]
    expected = [(t * MINUTE, g, v) for t, g, v in kept] + [(None, "a", "t")]
    order = lambda found: sorted(found, key=repr)
    assert order(rows(spark.read.parquet(on_time), "ts", "g", "v")) == order(expected)
    assert order(rows(spark.read.parquet(late), "ts", "g", "v")) == order([(89 * MINUTE, "a", "late"), (39 * MINUTE, None, "late null")])


def test_clashing_column_is_refused(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value AS ts", "'x' AS Late")
    with pytest.raises(ValueError):
        with_lateness(stream, ["Late"], ["ts"])
