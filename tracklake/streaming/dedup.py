"""Repeats in the stream: exactly, against the sink's days, or within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.joins import join_null_safe
from ..sinks import table_exists


def dedup_stream(df: DataFrame, keys: list[str], time: str, lateness: str = "10 minutes") -> DataFrame:
    """Drop repeats of ``keys`` that arrive within ``lateness``, and rows later than that.

    For live streams that bound their state and may lose late rows: a catch-up read, whose batches span days, loses
    all that is older than the newest event so far. ``dedup_sink`` loses none.
    """
    return df.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def dedup_sink(
    df: DataFrame, path: str, checkpoint: str, keys: list[str], time: str, day: str = "event_date"
) -> DataStreamWriter:
    """A writer that stores every distinct key once, however late it comes and however the stream is cut into batches.

    The table is partitioned by the day of ``time``, which must be one of ``keys``: a batch is compared with the
    stored rows of its own days only. A batch that is run again after a failure finds its rows stored and adds none.
    Rows without a time are kept in a partition of their own.
    """
    if time not in keys:
        raise ValueError(f"{time} must be a key, so that equal rows share a day")

    def store(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(keys).withColumn(day, F.to_date(time))
        if not table_exists(spark, path):
            rows.write.mode("append").partitionBy(day).parquet(path)
            return
        rows = rows.persist()  # read for its days and for the write
        days = [r[0] for r in rows.select(day).distinct().collect()]  # days of one batch
        known = spark.read.parquet(path)
        dated = F.col(day).isin([d for d in days if d is not None])
        known = known.where(dated | F.col(day).isNull() if None in days else dated)
        join_null_safe(rows, known.select(*keys), keys, "left_anti").write.mode("append").partitionBy(day).parquet(path)
        rows.unpersist()

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
