"""The interleaved layout: the same rows, and fewer files for a filter on any of its columns."""

from __future__ import annotations

import datetime
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tracklake.sinks import interleaved_key, rank_bounds, write_clustered, write_interleaved

from .conftest import rows


def files_for(path, column, value):
    """How many files may hold the value, by their statistics."""
    count = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        count += any(s.has_min_max and s.min <= value <= s.max for s in stats)
    return count


def test_every_column_skips_files(spark, tmp_path):
    pick = lambda seed, n: F.floor(F.rand(seed) * n)
    df = spark.range(0, 40_000, 1, 4).select(
        pick(1, 5000).alias("a"), F.format_string("s%05d", pick(2, 5000)).alias("b"), F.date_add(F.lit("2024-01-01"), pick(3, 5000).cast("int")).alias("c"),
        F.when(F.rand(4) < 0.3, F.lit(7)).otherwise(F.col("id")).alias("hot"),
    )
    df.write.parquet(str(tmp_path / "in"))
    df, z, plain = spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "z"), str(tmp_path / "plain")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        write_interleaved(df, z, ["a", "b", "c"])
        write_clustered(df, plain, ["a", "b", "c"])
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert rows(spark.read.parquet(z)) == rows(df)
    for column, value in (("b", "s02500"), ("c", datetime.date(2027, 1, 1))):
        assert files_for(plain, column, value) > 55
        assert files_for(z, column, value) <= 36  # 16 if the ranges of the files ended at cubes; most reach into a second one
    assert files_for(z, "a", 2500) <= 36


def test_edges(spark, tmp_path):
    schema = "`x.y` double, t timestamp, m map<string,int>"
    odd = spark.createDataFrame([(None, None, None), (float("nan"), None, {"a": 1}), (1.0, None, {}), (1.0, None, {}), (float("inf"), None, None)], schema)
    write_interleaved(odd, str(tmp_path / "odd"), ["x.y", "t"])
    assert spark.read.parquet(str(tmp_path / "odd")).count() == 5
    write_interleaved(odd.limit(0), str(tmp_path / "none"), ["x.y"])
    assert spark.read.schema(schema).parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        write_interleaved(odd.withColumn("_interleaved", F.lit(1)), str(tmp_path / "clash"), ["t"])
    with pytest.raises(ValueError):
        interleaved_key({str(k): [1] for k in range(11)})


def test_key_takes_bits_in_turn(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)] + [(None, 3)], "a int, b int")
    key = interleaved_key({"a": [1, 2, 3], "b": [1, 2, 3]}, bits=2)
    got = {(r["a"], r["b"]): r["k"] for r in df.select("*", key.alias("k")).collect()}
    want = {(a, b): (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | b & 1 for a in range(4) for b in range(4)}
    assert got == {**want, (None, 3): want[0, 3]}
    assert rank_bounds(df, ["a"], bits=2)["a"] == [1, 2, 3]
