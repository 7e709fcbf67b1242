"""Flat files: delimited feeds, CSV, seeds and archived JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FeedSpec


def delimited_feed(spark: SparkSession, path: str, spec: FeedSpec, strict: bool = False) -> DataFrame:
    """A headerless feed, plain or gzip (by file name), reduced to the columns kept.

    Missing fields and unreadable values become NULL; with ``strict`` the first such line ends the job instead, and
    :func:`feed_rejects` lists them. A gzip file cannot be split: deliver big feeds as several files.
    """
    reader = spark.read.schema(spec.schema).option("sep", spec.delimiter).option("quote", '"')
    if strict:  # column pruning would hide malformed lines from the parser
        reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
    return reader.csv(path).select(*spec.keep)


def feed_rejects(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """The lines of a feed with a wrong number of fields or an unreadable value, as they are."""
    schema = T.StructType([*spec.schema.fields, T.StructField("_line", T.StringType())])
    reader = spark.read.schema(schema).option("sep", spec.delimiter).option("quote", '"').option("columnPruning", False)
    lines = reader.option("columnNameOfCorruptRecord", "_line").csv(path)
    return lines.where("_line IS NOT NULL").select(F.col("_line").alias("line"))


def csv_with_header(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV with a header line; rows with the wrong number of fields or types are left out."""
    if not path.rstrip("*").rstrip("/").endswith("csv"):
        raise ValueError(f"not a csv path: {path}")
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("enforceSchema", schema is None)
    # Column pruning would hide malformed rows from the parser.
    reader = reader.option("columnPruning", False)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def seed(spark: SparkSession, path: str) -> DataFrame:
    """A small static CSV; all columns are text and a byte order mark is skipped."""
    return spark.read.option("header", True).csv(path)


def json_archive(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Gzipped JSON lines below ``root``, with the ``date=`` folders as a column."""
    partitioned = T.StructType([*schema.fields, T.StructField("date", T.StringType())])
    return spark.read.schema(partitioned).option("basePath", root).json(root)
