"""Replay of the raw message archive as a stream, with a starting point, an admission limit and tolerance of lost files.

The archive's own commit log decides what is there, so files of an unfinished write are never read, and the checkpoint of the
replaying query keeps its position: a restart goes on behind the last file that was read, wherever the replay started.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import millis_to_timestamp

EARLIEST, LATEST = "earliest", "latest"
_HOUR = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}")


def start_mark(spark: SparkSession, folder: str) -> int:
    """When (epoch milliseconds) the replay whose mark lies in ``folder`` was first started; written at the first call and kept from then on.

    With a new time at every start, what is archived while a query is down would be skipped. A mark whose write was cut off is an
    error, not a new mark.
    """
    try:
        return spark.read.schema("ms bigint").parquet(folder).first()["ms"]  # no row: the write of the mark was cut off
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.range(1).select(F.unix_millis(F.current_timestamp()).alias("ms")).coalesce(1).write.parquet(folder)
    return spark.read.parquet(folder).first()["ms"]


def _from(starting: str, mark_ms: int | None) -> Column:
    if starting == EARLIEST:
        return F.lit(True)
    if starting == LATEST:
        if mark_ms is None:
            raise ValueError("a replay from the latest message needs the mark of its first start")
        return F.col("_metadata.file_modification_time") >= millis_to_timestamp(F.lit(mark_ms))
    if not _HOUR.fullmatch(starting):
        raise ValueError(f"neither earliest, latest nor an hour like 2024-01-02T03: {starting}")
    return F.col("date").cast("string") >= starting.replace("T", " ")  # folder names sort by time


def check_present(spark: SparkSession, root: str, topic: str, starting: str = EARLIEST, mark_ms: int | None = None) -> int:
    """How many files a replay would read. One that the archive's log names and that is gone is an error; contents are not read."""
    files = spark.read.format("binaryFile").load(root)
    if "topic" not in files.columns:  # nothing archived yet
        return 0
    wanted = files.where((F.col("topic") == topic) & _from(starting, mark_ms))
    return wanted.agg(F.count("length").alias("n"), F.max("modificationTime")).first()["n"]


def replay_stream(
    spark: SparkSession,
    root: str,
    topic: str,
    starting: str = EARLIEST,
    mark_ms: int | None = None,
    max_files_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Messages of a topic from the archive below ``root``, in the columns of every stream source.

    ``starting`` is ``earliest``, an hour of the archive (only folders from that hour on are read), or ``latest``: files
    written since ``mark_ms`` (see :func:`start_mark`). ``max_files_per_trigger`` bounds a batch; a file holds a bounded number
    of messages, and files of other topics count. An archived file that is gone is skipped; with ``fail_on_data_loss``
    all files are looked up first (:func:`check_present`), and one that goes later ends the query. The archive keeps no partition and offset, so these are NULL. An archive without messages of the topic gives none.
    """
    if fail_on_data_loss:
        check_present(spark, root, topic, starting, mark_ms)
    reader = spark.readStream.schema("value string, topic string, date string").format("text")
    reader = reader.option("ignoreMissingFiles", not fail_on_data_loss)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    messages = reader.load(root).where((F.col("topic") == topic) & _from(starting, mark_ms))
    return messages.select(
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
    )
