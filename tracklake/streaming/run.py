"""Start one query per topic and watch over them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..schemas import TOPICS
from ..settings import IngestSettings
from ..sources.stream import event_stream
from .decode import decode_events, decoded_with_context, doubtful, rejected

PARTITIONS = ("year", "month", "day", "hour")
PARTITIONS_WITHOUT_YEAR = ("month", "day", "hour")


def file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: str = "60 seconds",
    run_once: bool = False,
    output_mode: str = "append",
    file_format: str = "parquet",
    partition_by: Iterable[str] = PARTITIONS,
) -> DataStreamWriter:
    """An hour-partitioned, exactly-once file sink.

    The partition folders without a year are kept for readers of the older layout. Rows are gathered by folder, so that a batch
    over many hours makes about a file an hour, not one an hour and task; adaptive execution splits an hour that is too big for
    one task.
    """
    folders = list(partition_by)
    writer = (
        (df.hint("rebalance", *folders) if folders else df)
        .writeStream.format(file_format)
        .partitionBy(*folders)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    return writer.trigger(availableNow=True) if run_once else writer.trigger(processingTime=trigger)


def topic_writers(
    spark: SparkSession,
    settings: IngestSettings,
    topic: str,
    source: Callable[[SparkSession, IngestSettings, str], DataFrame] = event_stream,
    partition_by: Iterable[str] = PARTITIONS,
) -> dict[str, DataStreamWriter]:
    """By query name, what stores the topic's events, and beside them what could not be read.

    Two queries, each with its own checkpoint, keep both sinks exactly-once. ``partition_by=PARTITIONS_WITHOUT_YEAR``
    writes the older layout.
    """
    messages = source(spark, settings, topic)
    common = {"trigger": settings.trigger_interval, "run_once": settings.run_once}
    events = file_sink(
        decode_events(messages, topic), settings.sink_path(topic), settings.checkpoint_path(topic),
        partition_by=partition_by, **common,
    )
    letters = file_sink(
        rejected(decoded_with_context(doubtful(messages, topic), topic)),
        f"{settings.sink_path('dead_letters')}/{topic}",
        settings.checkpoint_path(f"dead_letters/{topic}"),
        partition_by=(),
        file_format="json",
        **common,
    )
    return {name: writer.queryName(name) for name, writer in ((topic, events), (f"{topic}_dead_letters", letters))}


def start_topic(
    spark: SparkSession,
    settings: IngestSettings,
    topic: str,
    source: Callable[[SparkSession, IngestSettings, str], DataFrame] = event_stream,
    partition_by: Iterable[str] = PARTITIONS,
) -> list[StreamingQuery]:
    """Start the queries of :func:`topic_writers`."""
    return [writer.start() for writer in topic_writers(spark, settings, topic, source, partition_by).values()]


def run_topics(
    spark: SparkSession, settings: IngestSettings, topics: Iterable[str] = TOPICS
) -> dict[str, list[StreamingQuery]]:
    """Start every topic; one driver, independent queries."""
    spark.streams.resetTerminated()
    return {topic: start_topic(spark, settings, topic) for topic in topics}


def supervise(spark: SparkSession, timeout_seconds: int | None = None) -> bool:
    """Wait until any query ends (a failure is raised); True if one did in time."""
    ended = spark.streams.awaitAnyTermination(timeout_seconds)
    spark.streams.resetTerminated()
    return bool(ended) if timeout_seconds is not None else True


def health(name: str, query: StreamingQuery, failures: int) -> dict:
    """How a query is doing: its last batch, the rows of its recent batches, its failures so far and its error."""
    recent, error = query.recentProgress, query.exception()
    return {
        "query": name,
        "active": query.isActive,
        "last_batch": recent[-1].batchId if recent else None,
        "recent_rows": sum(p.numInputRows for p in recent),
        "failures": failures,
        "error": str(error) if error else None,
    }


def keep_running(
    spark: SparkSession,
    writers: Mapping[str, DataStreamWriter],
    attempts: int = 3,
    pause: float = 5.0,
    longest_pause: float = 300.0,
    poll: float = 1.0,
    report: Callable[[dict], None] = lambda row: None,
) -> None:
    """Start all queries and start again, from its checkpoint, only that one that fails; returns when all have ended well.

    A query waits ``pause`` seconds before it is started again, twice as long after each further failure. ``report`` gets
    :func:`health` whenever a query ends. After ``attempts`` restarts of one query the others are stopped, which loses nothing,
    and its error is raised.
    """
    spark.streams.resetTerminated()
    running = {name: writer.start() for name, writer in writers.items()}
    failures = dict.fromkeys(writers, 0)
    due: dict[str, float] = {}
    while running or due:
        for name, query in list(running.items()):
            if query.isActive:
                continue
            del running[name]
            error = query.exception()
            failures[name] += error is not None
            report(health(name, query, failures[name]))
            if error is None:
                continue
            if failures[name] > attempts:
                for other in running.values():
                    other.stop()
                raise error
            due[name] = time.monotonic() + min(longest_pause, pause * 2 ** (failures[name] - 1))
        for name in [n for n, at in due.items() if at <= time.monotonic()]:
            del due[name]
            running[name] = writers[name].start()
        time.sleep(poll)
    spark.streams.resetTerminated()
