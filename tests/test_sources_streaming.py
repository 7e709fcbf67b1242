"""Sources, sinks and the stream."""

from __future__ import annotations

import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tracklake.plans.load import load_hour, load_hours, raw_table
from tracklake.schemas import LOCATIONS_FEED, RAW, SONGS_FEED, TOPICS, WIRE
from tracklake.settings import IngestSettings
from tracklake.sinks import append_hour, ensure_table
from tracklake.sources import (
    csv_with_header,
    delimited_feed,
    drop_view,
    file_stream,
    hour_has_rows,
    hour_of,
    kafka_options,
    rate_stream,
    register_view,
    seed,
    snake_case_columns,
)
from tracklake.streaming import decode_events, decoded_with_context, dedup_sink, dedup_stream, rejected, run_topics, start_topic, supervise

from .conftest import rows


def test_feeds(spark, tmp_path):
    (tmp_path / "US.txt").write_text("US\t2134\tAllston\tMassachusetts\tMA\tSuffolk\t025\t\t\t42.3\t-71.1\t4\n")
    with gzip.open(tmp_path / "songs.txt.gz", "wt") as f:
        f.write('T1\tBand\tSay "hi"\t200.5\t9\tRock\n')
    place = delimited_feed(spark, str(tmp_path / "US.txt"), LOCATIONS_FEED).first()
    assert place.asDict()["postal_code"] == "2134" and place["borough_county_code"] == "025" and len(place) == 7
    song = delimited_feed(spark, str(tmp_path / "songs.txt.gz"), SONGS_FEED).first()
    assert tuple(song) == ("T1", "Band", 'Say "hi"', 200.5, "Rock")


def test_csv_rules(spark, tmp_path):
    path = tmp_path / "songs.csv"
    path.write_text("id,name\n1,a\n2,b,extra\n3,c\n")
    assert rows(csv_with_header(spark, str(path), "id BIGINT, name STRING")) == [(1, "a"), (3, "c")]
    with pytest.raises(ValueError):
        csv_with_header(spark, str(tmp_path / "songs.txt"))


def test_seed_skips_byte_order_mark(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes("﻿stateCode,stateName\nAK,Alaska\n".encode())
    assert seed(spark, str(path)).columns == ["stateCode", "stateName"]


def test_views_and_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Country Code", "Borough/County Code"])
    assert snake_case_columns(df).columns == ["country_code", "borough_county_code"]
    register_view(df, "things_ext")
    assert drop_view(spark, "things_ext") and not drop_view(spark, "things_ext")


def test_hour_read_prunes_and_absent_hours_are_empty(spark, tmp_path):
    root = str(tmp_path / "events")
    spark.range(48).selectExpr("id", "2024 as year", "1 as month", "int(id / 24) + 1 as day", "int(id % 24) as hour").write.partitionBy(
        "year", "month", "day", "hour"
    ).parquet(root)
    hour = hour_of(spark, root, datetime(2024, 1, 2, 5))
    assert rows(hour, "id") == [(29,)] and hour_has_rows(hour)
    assert len(hour.inputFiles()) == 1  # nothing but the hour's own folder is listed
    assert not hour_has_rows(hour_of(spark, root, datetime(2024, 2, 2, 5)))
    assert not hour_has_rows(hour_of(spark, str(tmp_path / "none"), datetime(2024, 1, 1), RAW["user_info"]))


def test_append_hour_is_idempotent_on_request(spark, tmp_path):
    path, slot = str(tmp_path / "raw"), {"year": 2024, "h": 2}
    df = spark.range(3)
    with pytest.raises(ValueError, match="year"):
        append_hour(df, path, {"month": 1, "h": 2})
    append_hour(df, path, slot)
    append_hour(df, path, slot)
    assert spark.read.parquet(path).count() == 3
    append_hour(df, path, slot, idempotent=False)
    assert spark.read.parquet(path).count() == 6
    assert ensure_table(spark, path, spark.read.parquet(path).schema).count() == 6
    assert ensure_table(spark, str(tmp_path / "new"), RAW["user_info"]).count() == 0


def test_settings_and_kafka_options():
    env = {"KAFKA_ADDRESS": "broker", "KAFKA_PORT": "1", "LAKE_ROOT": "s/", "SPARK_MAX_OFFSETS_PER_TRIGGER": "7"}
    settings = IngestSettings.from_env(env)
    options = kafka_options(settings, "auth_events")
    assert options["kafka.bootstrap.servers"] == "broker:1" and options["maxOffsetsPerTrigger"] == "7"
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert settings.sink_path("auth_events") == "s/auth_events"
    replay = IngestSettings.from_env({**env, "SPARK_RUN_ID": "again"})
    assert replay.sink_path("auth_events") != settings.sink_path("auth_events")
    assert replay.checkpoint_path("auth_events") != settings.checkpoint_path("auth_events")


def lines(*texts):
    return [(t.encode() if t is not None else None, "listen_events", 0, i) for i, t in enumerate(texts)]


MESSAGE = "value binary, topic string, partition int, offset bigint"


def test_decode_and_reject(spark):
    good = json.dumps({"ts": 1704067200123, "userId": 5, "song": r"caf\303\251", "artist": '"A"', "zip": 7})
    wrong_type = json.dumps({"ts": 1704067200000, "userId": "not a number", "song": "s"})
    no_time = json.dumps({"userId": 5})
    df = spark.createDataFrame(lines(good, wrong_type, no_time, "garbage", None), MESSAGE)
    got = decode_events(df, "listen_events").where("userId = 5").select("ts", "song", "artist", "year", "hour").first()
    assert tuple(got) == (datetime(2024, 1, 1, 0, 0, 0, 123000), "café", "A", 2024, 0)
    assert decode_events(df, "listen_events", keep_unreadable=True).count() == 5
    letters = rows(rejected(decoded_with_context(df, "listen_events")), "offset", "reason")
    # An event with an unreadable field is stored, and its raw message kept beside it.
    assert letters == [(1, "unreadable field"), (2, "no event time"), (3, "unreadable json"), (4, "empty message")]
    kept = decode_events(df, "listen_events").where("song = 's'").select("userId", "year").first()
    assert tuple(kept) == (None, 2024)  # a field of the wrong type is NULL, the event stays
    assert decode_events(df, "listen_events").count() + len(letters) - 1 == 5


def test_every_topic_decodes(spark):
    for topic in TOPICS:
        df = spark.createDataFrame([(b'{"ts": 1704067200000}', topic, 0, 0)], MESSAGE)
        assert decode_events(df, topic).count() == 1
        assert set(WIRE[topic].names) <= set(decode_events(df, topic).columns)


def test_stream_equals_batch_and_runs_once(spark, tmp_path):
    texts = [json.dumps({"ts": 1704067200000 + i * 600_000, "userId": i, "action": "start"}) for i in range(20)] + ["junk"]
    folder = tmp_path / "in" / "session_start_end_events"
    folder.mkdir(parents=True)
    for n in range(3):
        (folder / f"{n}.txt").write_text("\n".join(texts[n::3]) + "\n")
    settings = IngestSettings(
        lake_root=str(tmp_path / "lake"),
        checkpoint_root=str(tmp_path / "cp"),
        source="files",
        files_root=str(tmp_path / "in"),
        max_files_per_trigger=1,
        run_once=True,
    )
    for _ in range(2):  # the second run finds nothing new
        for query in start_topic(spark, settings, "session_start_end_events"):
            query.awaitTermination()
        stored = spark.read.parquet(settings.sink_path("session_start_end_events"))
        assert stored.count() == 20
    batch = spark.createDataFrame(lines(*texts), MESSAGE)
    columns = ["ts", "userId", "action", "year", "month", "day", "hour"]
    assert rows(stored, *columns) == rows(decode_events(batch, "session_start_end_events"), *columns)
    assert spark.read.json(f"{settings.sink_path('dead_letters')}/session_start_end_events").count() == 1


def test_run_topics_and_supervision(spark, tmp_path):
    for topic in ("user_info", "auth_events"):
        (tmp_path / "in" / topic).mkdir(parents=True)
        (tmp_path / "in" / topic / "a.txt").write_text('{"ts": 1704067200000, "userId": 1}\n')
    settings = IngestSettings(
        lake_root=str(tmp_path / "lake"), checkpoint_root=str(tmp_path / "cp"), source="files",
        files_root=str(tmp_path / "in"), run_once=True,
    )
    started = run_topics(spark, settings, ("user_info", "auth_events"))
    assert set(started) == {"user_info", "auth_events"}
    assert supervise(spark, 60)
    for queries in started.values():
        for query in queries:
            query.awaitTermination()
    assert spark.read.parquet(settings.sink_path("user_info")).count() == 1


def test_watermark_dedup_across_runs(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()

    def run(name, *stamps):
        (folder / name).write_text("\n".join(json.dumps({"ts": s, "userId": 1}) for s in stamps) + "\n")
        events = decode_events(file_stream(spark, str(folder), "user_info"), "user_info").select("ts", "userId")
        writer = dedup_stream(events, ["ts", "userId"], "ts").writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    base = 1704067200000
    run("1.txt", base, base, base + 60_000)
    run("2.txt", base + 60_000, base + 7_200_000)
    run("3.txt", base + 1, base + 7_200_001)  # the first is two hours late
    assert rows(spark.read.parquet(out).select(F.unix_millis("ts"))) == [(base,), (base + 60_000,), (base + 7_200_000,), (base + 7_200_001,)]


def test_dedup_sink_keeps_late_rows_and_stores_repeats_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()

    def run(name, *stamps):
        (folder / name).write_text("\n".join(json.dumps({"ts": s, "userId": 1}) for s in stamps) + "\n")
        events = decode_events(file_stream(spark, str(folder), "user_info"), "user_info").select("ts", "userId")
        dedup_sink(events, out, checkpoint, ["ts", "userId"], "ts").trigger(availableNow=True).start().awaitTermination()

    base = 1704067200000
    run("1.txt", base, base, base + 60_000)
    run("2.txt", base + 60_000, base + 7_200_000)
    run("3.txt", base + 1, base + 7_200_001, base)  # the first is two hours late
    found = rows(spark.read.parquet(out).select(F.unix_millis("ts")))
    assert found == [(base + k,) for k in (0, 1, 60_000, 7_200_000, 7_200_001)]
    with pytest.raises(ValueError, match="key"):
        dedup_sink(spark.readStream.format("rate").load(), out, checkpoint, ["value"], "timestamp")


def test_the_same_hour_of_two_years_is_two_hours(spark, tmp_path):
    lake, table = str(tmp_path / "lake"), str(tmp_path / "raw")
    for year, n in ((2023, 3), (2024, 2)):
        hours = spark.range(n).selectExpr("id AS ts", "id AS userId", f"{year} AS year", "1 AS month", "2 AS day", "9 AS hour")
        hours.write.mode("append").partitionBy("year", "month", "day", "hour").parquet(lake)
    slots = [datetime(2023, 1, 2, 9), datetime(2024, 1, 2, 9)]
    assert all(load_hour(spark, lake, "user_info", s, table) for s in [*slots, slots[0]])
    assert not load_hour(spark, lake, "user_info", datetime(2022, 1, 2, 9), table)
    counted = raw_table(spark, table, "user_info").groupBy("load_year").count()
    assert rows(counted) == [(2023, 3), (2024, 2)]
    again = str(tmp_path / "again")
    assert load_hours(spark, lake, "user_info", [*slots, datetime(2022, 1, 2, 9)], again) == slots
    assert raw_table(spark, again, "user_info").count() == 5


def test_rate_source_decodes(spark):
    stream = decode_events(rate_stream(spark, "user_info", 10), "user_info")
    assert stream.isStreaming and "userId" in stream.columns
