"""Compaction of the small files a stream leaves, while the stream goes on writing.

Files of closed folders are packed by size into bins; a bin is read and written by one task, without a shuffle. A run of bins goes to
a folder of its own and counts only once its manifest, the list of files it stands for, is complete. Readers take the runs with
a manifest and the sink's files that no manifest names, so every row is there once at any time: before, during and after a run,
after one that was cut off (its folder is never read), and when a late file arrives in a folder that was compacted before.
The sink's own files are not touched; once named in a manifest they may be deleted by the cluster's clean-up.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .tables import _file_system, path_exists

SLOT = ("year", "month", "day", "hour")
MANIFEST = "folder string, path string, bytes bigint"


def _runs(spark: SparkSession, target: str) -> list[str]:
    """Names of the runs whose manifest is complete."""
    files, there = _file_system(spark, f"{target}/manifest")
    names = [s.getPath().getName() for s in files.listStatus(there)] if files.exists(there) else []
    return sorted(n for n in names if path_exists(spark, f"{target}/manifest/{n}/_SUCCESS"))


def _named(spark: SparkSession, target: str, runs: Sequence[str]) -> set[str]:
    """Files that manifests name; like the sink's own listing, this is held by the driver."""
    if not runs:
        return set()
    manifests = spark.read.schema(MANIFEST).parquet(*[f"{target}/manifest/{n}" for n in runs])
    return {r["path"] for r in manifests.select("path").collect()}


def _ends(folder: str) -> datetime:
    """When the hour, or the day where there is no hour, of a folder is over; never for rows without a time."""
    at = {name: int(value) for name, value in re.findall(r"(\w+)=(\d+)", folder) if name in SLOT}
    if not {"year", "month", "day"} <= set(at) or "__HIVE_DEFAULT_PARTITION__" in folder:
        return datetime.max
    start = datetime(at["year"], at["month"], at["day"], at.get("hour", 0))
    return start + (timedelta(hours=1) if "hour" in at else timedelta(days=1))


def pack_files(sizes: dict[str, int], target_bytes: int) -> list[list[str]]:
    """First fit, largest first: bins of at most ``target_bytes``; a larger file is a bin of its own."""
    bins: list[tuple[int, list[str]]] = []
    for path in sorted(sizes, key=lambda p: (-sizes[p], p)):
        at = next((k for k, (held, _) in enumerate(bins) if held + sizes[path] <= target_bytes), None)
        if at is None:
            bins.append((sizes[path], [path]))
        else:
            bins[at] = (bins[at][0] + sizes[path], [*bins[at][1], path])
    return [paths for _, paths in bins]


def _publish(spark: SparkSession, target: str, run: str, rows: list[tuple[str, str, int]]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{target}/manifest/{run}")


def compact(
    spark: SparkSession,
    sink: str,
    target: str,
    closed_before: datetime,
    target_bytes: int = 256 << 20,
    bins_per_run: int = 200,
) -> int:
    """Compact the folders of ``sink`` that were over by ``closed_before``; manifests name the files replaced.

    Returns the number of files written. Bins of a single file are left as they are, so a second call without new files writes
    nothing. Folders need year, month and day, and may have hours. An absent or empty sink is an error of the read. One compaction
    of a target at a time; readers and the stream may run beside it.
    """
    whole = spark.read.parquet(sink)
    named = _named(spark, target, _runs(spark, target))
    folders: dict[str, dict[str, int]] = {}
    for path in whole.inputFiles():
        folder = path.rsplit("/", 1)[0]
        if path not in named and _ends(folder) <= closed_before:
            folders.setdefault(folder, {})[path] = 0
    bins: list[tuple[str, list[str]]] = []
    sizes: dict[str, int] = {}
    for folder, paths in sorted(folders.items()):
        if len(paths) < 2:
            continue
        files, there = _file_system(spark, folder)
        by_name = {s.getPath().getName(): s.getLen() for s in files.listStatus(there)}
        own = {p: by_name[p.rsplit("/", 1)[1]] for p in paths}
        sizes |= own
        bins += [(folder, some) for some in pack_files(own, target_bytes) if len(some) > 1]
    names = [n for n in SLOT if n in whole.columns]
    for at in range(0, len(bins), bins_per_run):
        some, run = bins[at : at + bins_per_run], uuid.uuid4().hex
        read = spark.read.schema(whole.schema).option("basePath", sink)
        parts = [read.parquet(*paths).coalesce(1) for _, paths in some]
        reduce(DataFrame.unionAll, parts).write.partitionBy(*names).parquet(f"{target}/runs/run={run}")
        _publish(spark, target, run, [(folder, path, sizes[path]) for folder, paths in some for path in paths])
    return len(bins)


def read_compacted(spark: SparkSession, sink: str, target: str) -> DataFrame:
    """All rows of the sink, from compacted files where there are some."""
    runs = _runs(spark, target)
    whole = spark.read.parquet(sink)
    if not runs:
        return whole
    named = _named(spark, target, runs)
    rest = [path for path in whole.inputFiles() if path not in named]
    read = spark.read.schema(whole.schema)
    packed = read.option("basePath", f"{target}/runs").parquet(*[f"{target}/runs/run={n}" for n in runs]).select(*whole.columns)
    return packed.unionAll(read.option("basePath", sink).parquet(*rest)) if rest else packed
