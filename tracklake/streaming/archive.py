"""Hourly archive of raw messages as gzipped JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Topics archived, folder format, file size and flush interval.
ARCHIVED_TOPICS = ("listen_events", "page_view_events", "status_change_events", "user_info")
HOUR_FOLDER = "yyyy-MM-dd HH':00:00+00'"
MAX_RECORDS_PER_FILE = 1_000_000
FLUSH_INTERVAL = "300 seconds"


def archive_frame(messages: DataFrame, at: Column | None = None) -> DataFrame:
    """Message text with its topic and hour folder; the hour is that of arrival unless given."""
    hour = F.date_format(F.current_timestamp() if at is None else at, HOUR_FOLDER)
    return messages.where(F.col("value").isNotNull()).select(
        F.col("value").cast("string").alias("value"), "topic", hour.alias("date")
    )


def start_archive(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = FLUSH_INTERVAL,
    run_once: bool = False,
    at: Column | None = None,
) -> StreamingQuery:
    writer = (
        archive_frame(messages, at)
        .writeStream.format("text")
        .partitionBy("topic", "date")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if run_once else writer.trigger(processingTime=interval)).start()
