"""Operators on hand-made edge rows and against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.operators import (
    Check,
    asof_join,
    check_report,
    dense_rank_within,
    high_water_mark,
    interval_join,
    keep_first,
    late_rows,
    latest_rows,
    load_tolerant,
    lookup_join,
    merge_by_key,
    merge_rows,
    nearest_match,
    next_within,
    previous_within,
    since,
    sync_schema,
    user_versions,
    violations,
)
from tracklake.schemas import RAW

from .conftest import rows

T0 = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


# --- dedup, rank, lag -----------------------------------------------------


def test_keep_first_breaks_ties_by_the_order_given(spark):
    df = spark.createDataFrame([(1, "paid"), (1, "free"), (1, None), (2, None), (None, "x"), (None, "w")], "k int, level string")
    kept = keep_first(df, ["k"], [F.col("level").asc_nulls_last()])
    assert rows(kept) == [(None, "w"), (1, "free"), (2, None)]


def test_latest_rows_keeps_ties_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d")], "k int, t int, v string")
    assert rows(latest_rows(df, ["k"], "t"), "v") == [("a",), ("b",)]


def test_dense_rank_matches_the_window(spark):
    random.seed(1)
    data = [(random.choice(["a", "b", None]), random.choice([1, 2, 2, 5, None])) for _ in range(200)]
    df = spark.createDataFrame(data, "g string, v bigint")
    ranked = dense_rank_within(df, ["g"], "v", "place")
    direct = df.selectExpr("g", "v", "dense_rank() over (partition by g order by v desc nulls last) as place")
    assert rows(ranked, "g", "v", "place") == rows(direct)


@pytest.mark.parametrize("bucket", [60, 3600, 10**9])
def test_previous_within_matches_lag(spark, bucket):
    random.seed(2)
    data = [(random.choice([1, 2, None]), at(random.randrange(0, 600)), i) for i in range(300)] + [(3, None, 999)]
    df = spark.createDataFrame(data, "k int, t timestamp, i int")
    got = previous_within(df, "k", "t", "before", [F.col("i")], bucket)
    want = df.selectExpr("k", "t", "i", "lag(t) over (partition by k order by t, i) as before")
    assert rows(got, "k", "t", "i", "before") == rows(want)
    after = next_within(df, "k", "t", "after", [F.col("i")], bucket)
    want = df.selectExpr("k", "t", "i", "lead(t) over (partition by k order by t, i) as after")
    assert rows(after, "k", "t", "i", "after") == rows(want)


# --- as-of and interval join ----------------------------------------------


def brute_asof(events, versions):
    out = []
    for key, t, i in events:
        begun = [v for v in versions if t is not None and v[0] == key and v[1] <= t and v[1] < v[2]]
        latest = max(begun, key=lambda v: v[1], default=None)
        out.append((key, t, i, latest[3] if latest and t < latest[2] else None))
    return out


def chained_versions(keys, seed):
    random.seed(seed)
    versions = []
    for k in keys:
        edges = sorted(random.sample(range(-50, 900), 6))
        for n, (a, b) in enumerate(zip(edges, edges[1:] + [10**7])):
            if n != 2:  # leave a gap
                versions.append((k, at(a), at(b), f"{k}-{n}"))
        versions.append((k, at(edges[3]), at(edges[3]), f"{k}-empty"))
    return versions


@pytest.mark.parametrize("most, slot", [(1000, 10), (0, 10), (0, 3600), (0, 10**8), (8, 600)])
def test_asof_join_matches_brute_force(spark, most, slot):
    random.seed(3)
    versions = chained_versions([1, 2, 3], 4) + chained_versions([2], 5)[:4]  # key 2 has more, overlapping ones
    versions = [(k, a, b, f"{k}-{a.isoformat()}" if a < b else name) for k, a, b, name in versions]
    events = [(random.choice([1, 1, 1, 2, 3, 4, None]), at(random.randrange(-100, 1000)), i) for i in range(400)]
    events += [(1, v[1], 1000 + i) for i, v in enumerate(versions)] + [(1, None, 2000), (None, None, 2001)]
    ev = spark.createDataFrame(events, "k int, t timestamp, i int")
    ve = spark.createDataFrame(versions, "k int, a timestamp, b timestamp, name string")
    common = {"key": "k", "time": "t", "start": "a", "end": "b", "take": ["name"]}
    got = asof_join(ev, ve, max_versions=most, slot_seconds=slot, **common)
    want = sorted(brute_asof(events, versions), key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(got, "k", "t", "i", "name") == want
    wider = ev.select("k", "t").unionByName(ev.select("k", "t"))
    assert rows(asof_join(ev, ve, keys_from=wider, max_versions=most, slot_seconds=slot, **common), "k", "t", "i", "name") == want


def test_interval_join_gives_every_valid_version(spark):
    versions = spark.createDataFrame([(1, at(0), at(10), "a"), (1, at(5), at(20), "b")], "k int, s timestamp, e timestamp, v string")
    events = spark.createDataFrame([(1, at(m)) for m in (-1, 7, 15)], "k int, t timestamp")
    got = interval_join(events, versions, key="k", time="t", start="s", end="e", take=["v"])
    assert rows(got, "t", "v") == [(at(-1), None), (at(7), "a"), (at(7), "b"), (at(15), "b")]


def test_asof_boundaries(spark):
    versions = spark.createDataFrame([(1, at(0), at(10), "old"), (1, at(10), at(20), "new")], "k int, a timestamp, b timestamp, v string")
    events = spark.createDataFrame([(1, at(m)) for m in (-1, 0, 9, 10, 20)], "k int, t timestamp")
    got = asof_join(events, versions, key="k", time="t", start="a", end="b", take=["v"])
    assert [r["v"] for r in got.orderBy("t").collect()] == [None, "old", "old", "new", None]


def test_lookup_join_keeps_row_count(spark):
    left = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    right = spark.createDataFrame([("x", "p2"), ("x", "p1"), (None, "p0")], "city string, pk string")
    assert rows(lookup_join(left, right, {"c": "city"}, "pk")) == [(None, None), ("x", "p1"), ("y", None)]


# --- tolerance match ------------------------------------------------------


def brute_match(left, right, tolerance):
    out = []
    for t, a, d in left:
        near = [
            (abs((d or 0.0) - (e or 0.0)), pk)
            for u, b, e, pk in right
            if t is not None and a is not None and t == u and a == b and abs((d or 0.0) - (e or 0.0)) <= tolerance
        ]
        out.append((t, a, d, min(near)[1] if near else None))
    return out


def test_nearest_match_matches_brute_force(spark):
    random.seed(5)
    cents = [round(x * 0.01, 2) for x in range(0, 60)] + [None]
    left = [(random.choice(["t", "u", None]), random.choice(["a", "b"]), random.choice(cents)) for _ in range(300)]
    right = [(random.choice(["t", "u"]), random.choice(["a", "b"]), random.choice(cents), f"pk{i:03d}") for i in range(80)]
    ldf = spark.createDataFrame(left, "title string, artist string, d double")
    rdf = spark.createDataFrame(right, "title string, artist string, e double, pk string")
    keys = [F.col("title"), F.col("artist")]
    got = nearest_match(
        ldf, rdf, left_keys=keys, right_keys=keys, left_value=F.col("d"), right_value=F.col("e"), take="pk", tolerance=0.01
    )
    want = sorted(brute_match(left, right, 0.01), key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(got, "title", "artist", "d", "pk") == want


# --- type 2 ---------------------------------------------------------------

USER = "event_datetime timestamp, user_id bigint, first_name string, last_name string, gender string, level string, registration_datetime timestamp"
STATUS = "event_datetime timestamp, user_id bigint, prev_level string"
END = datetime(9999, 1, 1)


def person(i, emitted=0, registered=-100):
    return (at(emitted), i, f"f{i}", f"l{i}", "F", "free", at(registered))


def versions_of(spark, users, status):
    df = user_versions(spark.createDataFrame(users, USER), spark.createDataFrame(status, STATUS))
    return rows(df, "user_id", "level", "row_effective_datetime", "row_expiry_datetime")


def test_user_without_changes(spark):
    assert versions_of(spark, [person(1)], []) == [(1, "free", at(-100), END)]


def test_user_with_three_changes(spark):
    changes = [(at(10), 1, "free"), (at(20), 1, "paid"), (at(30), 1, "free")]
    assert versions_of(spark, [person(1)], changes) == sorted(
        [
            (1, "free", at(-100), at(10)),
            (1, "paid", at(10), at(20)),
            (1, "free", at(20), at(30)),
            (1, "paid", at(30), END),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_changes_at_one_instant_give_two_final_rows(spark):
    got = versions_of(spark, [person(1)], [(at(10), 1, "free"), (at(10), 1, "paid")])
    assert sorted(r[1] for r in got if r[3] == END) == ["free", "paid"]
    assert (1, "paid", at(10), at(10)) in got  # the empty one in between


def test_change_before_first_emission_is_not_history(spark):
    got = versions_of(spark, [person(1, emitted=15)], [(at(10), 1, "free"), (at(20), 1, "paid")])
    assert (1, "paid", at(-100), at(20)) in got and len(got) == 2


def test_change_without_user_is_dropped(spark):
    assert versions_of(spark, [person(1)], [(at(10), 2, "free")]) == [(1, "free", at(-100), END)]


# --- load -----------------------------------------------------------------


def test_tolerant_load_defaults(spark):
    source = spark.createDataFrame(
        [
            ("1704067200000", "7", "yes", "1.25"),
            ("2024-01-01 00:00:00", "1.5", "TRUE", "x"),
            (None, None, "false", None),
            ("soon", "abc", None, "3"),
        ],
        "ts string, userId string, success string, lat string",
    )
    got = load_tolerant(source, RAW["auth_events"])
    assert got.schema.names == RAW["auth_events"].names
    assert [f.dataType for f in got.schema] == [f.dataType for f in RAW["auth_events"]]
    assert rows(got, "ts", "userId", "success", "lat", "city", "zip") == [
        (0, 0, False, 0.0, "NA", 0),
        (0, 0, False, 3.0, "NA", 0),
        (1704067200000, 0, True, 0.0, "NA", 0),
        (1704067200000, 7, False, 1.25, "NA", 0),
    ]


def test_tolerant_load_of_typed_sources(spark):
    source = spark.createDataFrame([(at(0), 1.5, 2.0, True)], "ts timestamp, zip double, sessionId double, userId boolean")
    assert load_tolerant(source, RAW["listen_events"]).select("ts", "zip", "sessionId", "userId", "duration").first() == (
        1704067200000,
        0,
        2,
        0,
        -1.0,
    )


# --- increments and merge -------------------------------------------------


def test_lateness_window_is_open_at_its_edge(spark):
    newest = 100
    raw = spark.createDataFrame([(1704067200000 + m * 60_000,) for m in (89, 90, 91, 100)], "ts bigint")
    mark = high_water_mark(raw.select(F.timestamp_millis("ts").alias("event_datetime")))
    assert mark == at(newest)
    assert since(raw, mark).count() == 2 and late_rows(raw, mark).count() == 2
    assert since(raw, None).count() == 4 and late_rows(raw, None).count() == 0


def test_increment_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(1000).selectExpr("id as ts", "id as v").write.parquet(path)
    plan = since(spark.read.parquet(path), T0)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,1704066600000)" in plan


def test_merge_matches_null_keys_and_syncs_columns(spark):
    old = spark.createDataFrame([(1, "a", 0.5), (None, "n", 0.5), (3, "c", 0.5)], "k int, v string, gone double")
    new = spark.createDataFrame([(1, "A", True), (None, "N", False), (4, "D", True)], "k int, v string, added boolean")
    assert rows(merge_rows(old, new, ["k"])) == [(None, "N", False), (1, "A", True), (3, "c", None), (4, "D", True)]
    assert sync_schema(old, new).columns == ["k", "v", "added"]


def test_merge_by_key_is_idempotent_and_rejects_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "t")

    def day(n, pairs):
        return spark.createDataFrame([(k, v, n) for k, v in pairs], "k int, v string, d int")

    merge_by_key(path, day(1, [(1, "a"), (2, "b")]).union(day(2, [(3, "c"), (None, "x")])), ["d", "k"], "d")
    update = day(2, [(3, "C"), (4, "D"), (None, "X")])
    for _ in range(2):
        merge_by_key(path, update, ["d", "k"], "d")
        assert rows(spark.read.parquet(path), "d", "k", "v") == [
            (1, 1, "a"), (1, 2, "b"), (2, None, "X"), (2, 3, "C"), (2, 4, "D"),
        ]
    with pytest.raises(ValueError, match="several updates"):
        merge_by_key(path, day(1, [(1, "p"), (1, "q")]), ["d", "k"], "d")


def test_merge_by_key_rewrites_all_partitions_on_a_new_column(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_by_key(path, spark.createDataFrame([(1, 1), (2, 2)], "k int, d int"), ["k"], "d")
    merge_by_key(path, spark.createDataFrame([(2, 2, "new")], "k int, d int, v string"), ["k"], "d")
    assert rows(spark.read.parquet(path), "k", "v", "d") == [(1, None, 1), (2, "new", 2)]


# --- data checks ----------------------------------------------------------


def test_each_check_finds_its_violation(spark):
    child = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", 0.0), (2, "a", None), (None, "zzz", -1.0), (9, None, 11.0)], "id int, c string, x double"
    )
    tables = {"m": child, "p": spark.createDataFrame([(1,), (2,)], "pid int")}
    checks = [
        Check("m", "unique", ("id",)),
        Check("m", "not_null", ("id",)),
        Check("m", "accepted_values", ("c",), values=("a", "b")),
        Check("m", "relationships", ("id",), "warn", parent="p", parent_column="pid"),
        Check("m", "accepted_range", ("x",), "warn", low=0, high=10, inclusive=True),
        Check("m", "accepted_range", ("x",), "warn", low=0, inclusive=False),
        Check("m", "unique_combination", ("id", "c")),
    ]
    report = check_report(checks, tables).collect()
    got = {(r["test"], r["column_name"]): r["failures"] for r in report if r["test"] != "accepted_range"}
    assert got == {
        ("unique", "id"): 1,
        ("not_null", "id"): 1,
        ("accepted_values", "c"): 1,
        ("relationships", "id"): 1,
        ("unique_combination", "id, c"): 0,
    }
    assert sorted(r["failures"] for r in report if r["test"] == "accepted_range") == [2, 2]
    assert rows(violations(checks[0], tables)) == [(1, 2)]
    assert violations(checks[3], tables).first()["id"] == 9


def test_row_level_checks_of_a_model_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(10).selectExpr("id", "id as x").write.parquet(path)
    checks = [Check("m", "not_null", (c,)) for c in ("id", "x")] + [Check("m", "accepted_range", ("x",), low=0)]
    plan = check_report(checks, {"m": spark.read.parquet(path)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_all_declared_checks_are_listed():
    from collections import Counter

    from tracklake.plans.checks import CHECKS

    assert Counter(c.kind for c in CHECKS) == {
        "unique": 6,
        "not_null": 22,
        "accepted_values": 6,
        "relationships": 7,
        "accepted_range": 10,
        "unique_combination": 5,
    }


def test_types_of_raw_tables():
    assert {len(s) for s in RAW.values()} == {19, 23, 16, 6}
    assert all(isinstance(f.dataType, (T.StringType, T.LongType, T.DoubleType, T.BooleanType)) for s in RAW.values() for f in s)


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    from tracklake import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://cluster:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "s3a://shared/tmp"})
    assert session.scratch_dir(Session(), "x").startswith("s3a://shared/tmp/x-")
    Session.conf = Conf({"spark.master": "local[4]"})
    assert session.scratch_dir(Session(), "x")


def test_merge_repeats_a_cut_off_step_and_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame(rows, "k int, v string, d int")
    merge_by_key(path, make((1, "a", 1), (2, "a", 2)), ["k"], "d")
    # As a merge leaves it that was cut off after it had removed a partition.
    make((1, "b", 1)).write.partitionBy("d").parquet(f"{path}__pending")
    for f in (tmp_path / "t" / "d=1").iterdir():
        f.unlink()
    merge_by_key(path, make((3, "c", 2)), ["k"], "d")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "d").collect()) == [(1, "b", 1), (2, "a", 2), (3, "c", 2)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_high_water_mark_ignores_times_from_the_future(spark):
    from datetime import datetime

    df = spark.createDataFrame([(datetime(2024, 1, 2),), (datetime(2104, 1, 1),)], "event_datetime timestamp")
    assert high_water_mark(df, not_after=datetime(2024, 2, 1)) == datetime(2024, 1, 2)


def test_users_without_an_id_share_one_version(spark):
    from datetime import datetime

    at = datetime(2024, 1, 1)
    users = [(0, f"f{k}", "l", "F", "free", at, at) for k in range(50)] + [(None, "x", "l", "M", "free", at, at), (7, "a", "b", "M", "free", at, at)]
    df = spark.createDataFrame(users, "user_id long, first_name string, last_name string, gender string, level string, "
                                      "registration_datetime timestamp, event_datetime timestamp")  # fmt: skip
    changes = [(0, datetime(2024, 1, 2, 0, k), "free") for k in range(50)] + [(7, datetime(2024, 1, 3), "free")]
    status = spark.createDataFrame(changes, "user_id long, event_datetime timestamp, prev_level string")
    from tracklake.operators import user_versions

    got = user_versions(df, status)
    assert got.where("user_id = 0").count() == 1 and got.where("user_id = 7").count() == 2 and got.count() == 3
    single = user_versions(df.where("first_name = 'f1' OR user_id = 7"), status)
    assert single.where("user_id = 0").count() == 51  # a real user 0


def test_values_that_are_not_finite_match_nothing(spark):
    inf = float("inf")
    left = spark.createDataFrame([("a", 1.0), ("a", inf), ("a", -inf), ("a", float("nan")), ("a", None), ("a", 1e300)], "k string, v double")
    right = spark.createDataFrame([("a", 1.0, "one"), ("a", inf, "inf"), ("a", float("nan"), "nan"), ("a", 1e300, "big")], "k string, v double, id string")
    got = nearest_match(left, right, left_keys=[F.col("k")], right_keys=[F.col("k")], left_value=F.col("v"), right_value=F.col("v"), take="id", tolerance=0.5)
    assert got.count() == 6 and [r["id"] for r in got.where("id IS NOT NULL").collect()] == ["one"]
