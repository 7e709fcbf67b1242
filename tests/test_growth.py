"""What must not grow faster than the input: tasks that hold everything, files a batch makes, texts parsed again and again."""

from __future__ import annotations

from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tracklake.operators import incremental, merge_by_key
from tracklake.plans import advance as upkeep
from tracklake.plans import refresh as refreshing
from tracklake.plans.models import MODELS, Models
from tracklake.schemas import WIRE
from tracklake.settings import IngestSettings
from tracklake.streaming import decoded_with_context, doubtful, file_sink, rejected, topic_writers
from tracklake.streaming import run as running
from tracklake.testbed.queries import QUERIES
from tracklake.testbed.shapes import Shapes


@pytest.mark.parametrize("name", ["stream_dedup_native", "stream_late_rows"])
def test_streams_take_their_plays_from_many_tasks(spark, monkeypatch, name):
    def whole(self, partitions):
        raise AssertionError("all plays in one task")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", whole)
    assert QUERIES[name](spark, SMALL).count() > 0


def test_a_batch_over_many_hours_makes_a_file_an_hour(spark, tmp_path):
    rows = spark.range(400).select("id", (F.col("id") % 5).cast("int").alias("hour"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("openCostInBytes", 1).parquet(str(tmp_path / "in"))
    sink = str(tmp_path / "out")
    file_sink(stream.repartition(4), sink, str(tmp_path / "state"), run_once=True, partition_by=("hour",)).start().awaitTermination()
    assert len(list((tmp_path / "out").glob("hour=*/*.parquet"))) == 5
    assert spark.read.parquet(sink).count() == 400


def test_a_message_is_parsed_once(spark):
    received = spark.createDataFrame([(bytearray(b'{"ts": 1704067200000, "userId": "x"}'), "user_info", 0, 0), (None, "user_info", 0, 1)],
                                     "value binary, topic string, partition int, offset long")
    letters = rejected(decoded_with_context(received, "user_info"))
    assert sorted(r["reason"] for r in letters.collect()) == ["empty message", "unreadable field"]
    assert letters._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


MESSAGE = "value binary, topic string, partition int, offset long"


def test_what_is_readable_at_a_glance_is_not_parsed_for_dead_letters(spark):
    s, left = Shapes(spark, SMALL), {}
    for topic, schema in WIRE.items():
        names = [n for n in schema.names if n in s[topic].columns]
        sent = s[topic].select(F.to_json(F.struct(*names)).cast("binary").alias("value"))
        left[topic] = doubtful(sent, topic).count()
    assert left == dict.fromkeys(WIRE, 0)


ODD_VALUES = (
    '"x"', '"é\U0001f3b5"', '""', r'"a\"b\\\/\b\f\n\r\t"', r'"\u00e9"', r'"\q"', '"\t"', '"\x1f"', '"\x7f"', r'"end\"', '"open', "0", "-0", "7", "-7", "007", "+7",
    "7.", ".5", "7.25", "-7.25E-3", "7e3", "1E400", "2147483648", "-2147483649", "999999999", "1999999999", "2099999999", "-2099999999", "2100000000", "10000000000", "9223372036854775808", "1" * 40, "NaN",
    "Infinity", "true", "false", "True", "null", "", "[1]", '{"a":1}', '"' + r"\n" * 60 + '"', '"7"',
)


def test_no_dead_letter_is_readable_at_a_glance(spark):
    """Every value in a field of every type, and objects that are none: the same letters as without the glance."""
    texts = ["", "{}", "x", "[]", '{"ts":1}', ' {"ts":1}', '{"ts":1} ', '{"ts":1}x', '{"ts":1}{"ts":2}', '{"ts":1,}', '{"ts":1', '{"ts":1,,"page":"a"}',
             '{"userId":1}', '{"ts":1,"page":"a" "auth":"b"}', '{"ts":1,"ts":"x"}', '{"page":"a","ts":1}', '{"ts":1,"other":2}', '{"TS":1}',
             '{"ts": 1, "page": "a"}', '{"ts":0}', '{"ts":99999999999999}', '{"ts":253402300800000}', '{"ts":-62135596800001}', "\ufeff{\"ts\":1}"]
    texts += ['{"ts":%s}' % v for v in ODD_VALUES]
    texts += ['{"ts":1704067200000,"%s":%s,"userId":5}' % (n, v) for n in ("page", "status", "lon", "song") for v in ODD_VALUES]
    texts += ['{"ts":1704067200000,"success":%s}' % v for v in ODD_VALUES] + ['{"ts":1704067200000,"registration":%s}' % v for v in ODD_VALUES]
    sent = [t.encode() for t in texts] + [b'{"ts":1,"page":"\xff\xc3"}', b'{"ts":1,"page":"\xed\xa0\x80"}', b"\xff", None]
    sent += [b'{"ts":1,"page":"' + b"a" * n + b'"}' for n in (500_000, 1_500_000)]
    for topic in ("page_view_events", "auth_events", "user_info"):
        received = spark.createDataFrame([(v and bytearray(v), topic, 0, i) for i, v in enumerate(sent)], MESSAGE)
        found = rows(rejected(decoded_with_context(doubtful(received, topic), topic)), "offset", "reason")
        assert found == rows(rejected(decoded_with_context(received, topic)), "offset", "reason")
        assert len(found) > 10 and doubtful(received, topic).count() < received.count()


@pytest.mark.parametrize("session, parsed", [(0, 0), (1_999_999_999, 0), (-2_099_999_999, 0), (2_147_483_648, 1), (10_000_000_000, 1)])
def test_session_numbers_of_ten_digits_are_readable_at_a_glance(spark, session, parsed):
    value = bytearray(b'{"ts":1704067200000,"sessionId":%d,"userId":5}' % session)
    received = spark.createDataFrame([(value, "auth_events", 0, 0)], MESSAGE)
    assert doubtful(received, "auth_events").count() == parsed


def test_topics_look_for_letters_at_a_glance(spark, tmp_path, monkeypatch):
    parsed, plain = [], running.decoded_with_context
    monkeypatch.setattr(running, "decoded_with_context", lambda df, topic: (parsed.append(df), plain(df, topic))[1])
    (tmp_path / "in" / "user_info").mkdir(parents=True)
    settings = IngestSettings(
        lake_root=str(tmp_path / "lake"), checkpoint_root=str(tmp_path / "cp"), source="files", files_root=str(tmp_path / "in"), run_once=True,
    )
    topic_writers(spark, settings, "user_info")
    assert len(parsed) == 1 and "RLIKE" in parsed[0]._jdf.queryExecution().analyzed().toString().upper()


def test_noted_keys_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    journal = upkeep.Journal(spark, str(tmp_path))
    journal.note("users", spark.range(5).where(counted("id")))
    assert seen.value == 5 and sorted(r["id"] for r in journal.read("users").collect()) == list(range(5))
    journal.note("spans", spark.range(0))
    assert journal.read("spans") is None and journal.read("days") is None


def test_what_differs_either_way_meets_null_with_null(spark):
    new = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b"), (3, "n"), (3, "n")], "k int, v string")
    old = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("c", 2)], "v string, k int")
    differing = upkeep.either_way(new, old)
    assert rows(differing, "k", "v") == [(2, "c"), (3, "n")]
    plan = differing._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_arrivals_are_stored_and_counted_once(spark, tmp_path, monkeypatch):
    counted, s, early = [], Shapes(spark, SMALL), "ts < 1705363200000"
    plain = incremental.require_unique
    monkeypatch.setattr(incremental, "require_unique", lambda df, keys: (counted.append(tuple(keys)), plain(df, keys)))
    for part in (early, f"NOT {early}"):
        new = {n: s[n].where(part) for n in ("listen_events", "status_change_events", "user_info")}
        tables = upkeep.advance(spark, str(tmp_path), new, s["songs"], s["locations"])
    assert set(counted) == {("user_id",)}  # the others have one row per key already
    assert tables["fact_listen_events"].count() == Models(s)["fact_listen_events"].count()


def test_a_swap_gathers_its_rows_once(spark, tmp_path, monkeypatch):
    path, hints = str(tmp_path / "t"), []
    make = lambda *r: spark.createDataFrame(list(r), "k int, v string, d int")
    merge_by_key(path, make((1, "a", 1), (2, "a", 2)), ["k"], "d", ["v"])
    frame = type(spark.range(1))
    plain = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, *a: (hints.append(a), plain(df, *a))[1])
    merge_by_key(path, make((1, "b", 1), (3, "b", 2)), ["k"], "d", ["v"])
    assert hints == [("rebalance", "d")]
    assert rows(spark.read.parquet(path), "k", "v", "d") == [(1, "b", 1), (2, "a", 2), (3, "b", 2)]


def test_models_that_do_not_read_each_other_are_stored_side_by_side(spark, tmp_path, monkeypatch):
    met, plain = Barrier(2, timeout=60), refreshing.store

    def together(*args, **options):
        met.wait()
        plain(*args, **options)

    monkeypatch.setattr(refreshing, "store", together)
    names = ("dim_songs", "dim_locations")
    assert set(refreshing.refresh(spark, str(tmp_path), Shapes(spark, SMALL), names=names)) == set(names)


def test_no_model_reads_one_of_its_own_wave_or_a_later_one(spark):
    class Asked(dict):
        def __contains__(self, name):
            read.add(name)
            return False

    assert sorted(n for wave in refreshing.WAVES for n in wave) == sorted(MODELS)
    before: set = set()
    for wave in refreshing.WAVES:
        for name in wave:
            read: set = set()
            getattr(Models(Shapes(spark, SMALL), Asked()), name)
            assert read <= before, name
        before |= set(wave)
