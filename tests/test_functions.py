"""Column functions on hand-made edge rows."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tracklake import functions as fn
from tracklake.functions.repair import _repaired


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "row, text",
    [
        ((datetime(2024, 1, 2, 3, 4, 5), 7, 900.0), "2024-01-02 03:04:05+00-7-900"),
        ((datetime(2024, 1, 2, 3, 4, 5, 120000), 7, 0.25), "2024-01-02 03:04:05.120+00-7-0.25"),
        ((datetime(2024, 1, 2, 3, 4, 5, 120001), 7, -1.0), "2024-01-02 03:04:05.120001+00-7--1"),
        ((None, 7, None), "_dbt_utils_surrogate_key_null_-7-_dbt_utils_surrogate_key_null_"),
    ],
)
def test_surrogate_key_text(spark, row, text):
    df = spark.createDataFrame([row], "t timestamp, n bigint, d double")
    assert df.select(fn.surrogate_key(df, ["t", "n", "d"])).first()[0] == md5(text)


@pytest.mark.parametrize(
    "title, clean",
    [('say "hi"', "say hi"), ("Beyoncé", "Beyonc"), ("日本", ""), ("a\\b", "a\\b"), (None, None), ("", "")],
)
def test_normalize_title(spark, title, clean):
    assert one(spark, fn.normalize_title(F.col("x").cast("string")), x=title) == clean


def test_match_forms(spark):
    assert one(spark, fn.match_title(F.col("x")), x="AC\\DC\\") == "ACDC"
    assert one(spark, fn.match_artist(F.col("x")), x=" \t The Band \n") == "the band"


@pytest.mark.parametrize(
    "code, country, out",
    [("2134", "US", "02134"), ("123456", "US", "12345"), ("sw1a 1aa", "GB", "SW1A 1AA"), ("ab", None, "AB"), (None, "US", None)],
)
def test_standard_postal(spark, code, country, out):
    column = fn.standard_postal(F.col("p").cast("string"), F.col("c").cast("string"))
    assert one(spark, column, p=code, c=country) == out


@pytest.mark.parametrize(
    "page, category", [("NextSong", "Streaming"), ("Logout", "Authentication"), ("Lounge", "UNKNOWN"), (None, "UNKNOWN")]
)
def test_page_category(spark, page, category):
    assert one(spark, fn.page_category(F.col("p").cast("string")), p=page) == category


@pytest.mark.parametrize("minutes, tier", [(9, "Short Session"), (10, "Medium Quality"), (29, "Medium Quality"), (30, "High Quality")])
def test_session_tier(spark, minutes, tier):
    assert one(spark, fn.session_tier(F.col("m")), m=minutes) == tier


def test_engagement(spark):
    assert one(spark, fn.engagement_label(F.col("n")), n=50) == "Passive"
    assert one(spark, fn.engagement_label(F.col("n")), n=51) == "Highly Active"


@pytest.mark.parametrize("days, prefix", [(7, "Fast"), (8, "Standard"), (30, "Standard"), (31, "Long-term"), (-3, "Fast")])
def test_days_segment(spark, days, prefix):
    assert one(spark, fn.days_segment(F.lit("x"), F.col("d")), d=days).startswith(prefix)
    assert one(spark, fn.days_segment(F.lit(None), F.col("d")), d=days) == "Free Tier (Never Upgraded)"


def test_elapsed_is_not_boundaries(spark):
    a, b = datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000)
    assert one(spark, fn.elapsed("SECOND", F.col("a"), F.col("b")), a=a, b=b) == 0
    assert one(spark, fn.second_boundaries(F.col("a"), F.col("b")), a=a, b=b) == 1


@pytest.mark.parametrize("value, digits, out", [(1.005, 2, 1.01), (-1.005, 2, -1.01), (0.015, 2, 0.02), (1e300, 2, 1e300), (None, 2, None), (0.0049999996, 2, 0.0), (1.0049999997, 2, 1.0), (1e-9, 9, 1e-9)])
def test_round_half_up(spark, value, digits, out):
    assert one(spark, fn.round_half_up(F.col("v").cast("double"), digits), v=value) == out


def test_exact_sum_keeps_what_no_decimal_holds(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double")
    assert df.select(fn.exact_sum(F.col("v"))).first()[0] == 1.0
    tiny = spark.createDataFrame([(1e-7,)] * 10 + [(1e6,)], "v double")
    assert tiny.select(fn.exact_sum(F.col("v"))).first()[0] == 1000000.000001
    huge = spark.createDataFrame([(1e300,), (2.0,)], "v double")
    assert huge.select(fn.exact_sum(F.col("v"))).first()[0] == 1e300
    assert df.where("v is null").select(fn.exact_sum(F.col("v"))).first()[0] is None


def test_guarded_ratios(spark):
    assert one(spark, fn.ratio_or_zero(F.col("a"), F.col("b")), a=1, b=0) == 0.0
    assert one(spark, fn.ratio_or_zero(F.col("a"), F.col("b")), a=2, b=3) == 0.67
    assert one(spark, fn.safe_share(F.col("a"), F.col("b")), a=1, b=0) is None
    assert one(spark, fn.safe_share(F.col("a"), F.col("b")), a=1, b=3) == 0.3333


@pytest.mark.parametrize(
    "text, out",
    [
        (r"\303\251", "é"),
        (r'"Beyonc\303\251"', "Beyoncé"),
        ("Beyoncé", "Beyoncé"),
        ("BeyoncÃ©", "Beyoncé"),
        ("日本", "日本"),
        ("ends with \\", "ends with \\"),
        (r"bad \303 byte", r"bad \303 byte"),
        ('"quoted"', "quoted"),
        ("plain", "plain"),
        ("", ""),
        (None, None),
    ],
)
def test_repair_text(spark, text, out):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(fn.repair_text(F.col("s"))).first()[0] == out
    if text is not None:  # the JVM shortcut and the Python path agree
        assert _repaired(text) == out


def test_repair_needs_python_for_backslashes_only(spark):
    """Other text takes built-in functions, with the same result as the Python codec chain."""
    texts = ["plain", '"quoted"', "Beyoncé", "BeyoncÃ©", '"Ã¼ber"', "日本", "\u00c3", "é\u20ac", "", '"', "a\u0080b", "\u00ed\u00a0\u0080"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", fn.repair_text(F.col("t")).alias("r"))
    assert {r["t"]: r["r"] for r in out.collect()} == {t: _repaired(t) for t in texts}


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A session started from another folder, with the package on the driver's path only."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from pyspark.sql import functions as F\n"
        "from tracklake.session import get_session\nfrom tracklake.functions import repair_text\n"
        "spark = get_session('other', 'local[1]', {'spark.ui.enabled': 'false'})\n"
        "print('GOT', spark.createDataFrame([(r'caf\\303\\251',)], 't string').select(repair_text(F.col('t'))).first()[0])\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONIOENCODING": "utf-8"}
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "GOT café" in ran.stdout, ran.stderr[-800:]


def test_times_out_of_range_are_null(spark):
    values = [0, 1704067200123, 99999999999999999, 2**63 - 1, -(2**63), 253402300800000, -62135596800001, None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] is not None for r in df.select(F.unix_millis(fn.millis_to_timestamp(F.col("v")))).collect()]
    assert got == [True, True, False, False, False, False, False, False]
