"""Streaming sources. All give a binary ``value`` column and where it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import IngestSettings
from .replay import LATEST, replay_stream, start_mark

CONTEXT = ["value", "topic", "partition", "offset"]


def kafka_options(settings: IngestSettings, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": settings.starting_offsets,
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
        # Consumer time limits in milliseconds.
        "kafka.max.poll.interval.ms": "300000",
        "kafka.session.timeout.ms": "30000",
    }


def kafka_stream(spark: SparkSession, settings: IngestSettings, topic: str) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(settings, topic)).load().select(*CONTEXT)


def file_stream(
    spark: SparkSession, path: str, topic: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Text files with one JSON message per line, in place of a topic."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
    )


def rate_stream(spark: SparkSession, topic: str, rows_per_second: int = 1000) -> DataFrame:
    """A load generator: each message is ``{"ts": <epoch ms>, "userId": <counter>}``."""
    generated = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    message = F.to_json(F.struct(F.unix_millis("timestamp").alias("ts"), F.col("value").alias("userId")))
    return generated.select(
        message.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("value").alias("offset"),
    )


def event_stream(spark: SparkSession, settings: IngestSettings, topic: str) -> DataFrame:
    if settings.source == "kafka":
        return kafka_stream(spark, settings, topic)
    if settings.source == "files":
        return file_stream(spark, f"{settings.files_root}/{topic}", topic, settings.max_files_per_trigger)
    if settings.source == "archive":
        mark = start_mark(spark, f"{settings.checkpoint_path(topic)}_start") if settings.starting_offsets == LATEST else None
        return replay_stream(
            spark, settings.files_root, topic, settings.starting_offsets, mark, settings.max_files_per_trigger, settings.fail_on_data_loss
        )
    if settings.source == "rate":
        return rate_stream(spark, topic)
    raise ValueError(f"unknown source: {settings.source}")
