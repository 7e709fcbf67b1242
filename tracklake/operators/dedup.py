"""One row per key.

Both forms prune inside each input partition before the shuffle (partial
aggregation, or the partial group limit Spark plans for ``row_number() = 1``),
so a key with very many copies sends at most one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under a total ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_rows(df: DataFrame, key: list[str], time: str) -> DataFrame:
    """The rows of every key at its latest time; rows tied on that time all stay."""
    w = Window.partitionBy(*key).orderBy(F.col(time).desc_nulls_last())
    return (
        df.where(F.col(time).isNotNull()).withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")
    )


def drop_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """For rows whose other columns follow from ``keys``: a plain hash distinct."""
    return df.dropDuplicates(keys)
