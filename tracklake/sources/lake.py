"""Reads of the event lake and of reference parquet tables."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def hour_of(
    spark: SparkSession, root: str, slot: datetime, schema: T.StructType | None = None, with_year: bool = True
) -> DataFrame:
    """One hour of an event directory. Only its own folder is listed, however long the lake's history is.

    ``with_year=False`` reads the older layout that has no year folder. An absent
    folder gives no rows if ``schema`` says what they would look like.
    """
    parts = {"month": slot.month, "day": slot.day, "hour": slot.hour}
    if with_year:
        parts = {"year": slot.year, **parts}
    folder = "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in parts.items())])
    try:
        return spark.read.option("basePath", root).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        # Without a schema the directory itself has to say what rows would look like.
        return spark.read.parquet(root).limit(0) if schema is None else spark.createDataFrame([], schema)


def hour_has_rows(hour: DataFrame) -> bool:
    """Guard of the hourly load: False where there is nothing to load."""
    return not hour.isEmpty()


def parquet_glob(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.parquet(pattern)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """``Country Code`` and ``Borough/County`` become ``country_code`` and ``borough_county``."""
    return df.toDF(*[re.sub(r"[^0-9a-z]+", "_", c.lower()).strip("_") for c in df.columns])


def register_view(df: DataFrame, name: str) -> DataFrame:
    """(Re)place a temporary view, the counterpart of an external table."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    """Drop a temporary view; False, not an error, where there is none."""
    return spark.catalog.dropTempView(name)
