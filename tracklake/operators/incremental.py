"""Bounded-lateness increments and merge by key on partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_null_safe

LATENESS = timedelta(minutes=10)


def single_value(df: DataFrame, expression: str):
    """One scalar of ``df`` on the driver, for use as a literal that pushes down."""
    return df.selectExpr(expression).first()[0]


def high_water_mark(
    target: DataFrame,
    time: str = "event_datetime",
    partition: str | None = None,
    not_after: datetime | None = None,
):
    """The newest time in ``target``, or None. With ``partition`` only its newest partition is read.

    Times after ``not_after`` are left out: a producer whose clock is wrong must not move the mark
    past everything that is still to come.
    """
    if not_after is not None:
        limit = F.lit(not_after).cast("timestamp")
        target = target.where(F.col(time) <= limit)
        if partition:
            target = target.where(F.col(partition) <= F.to_date(limit))
    if partition:
        newest = single_value(target, f"max({partition})")
        if newest is None:
            return None
        target = target.where(F.col(partition) == F.lit(newest))
    return single_value(target, f"max({time})")


def _cutoff_millis(mark: datetime, lateness: timedelta) -> Column:
    return F.unix_millis(F.lit(mark).cast("timestamp")) - F.lit(int(lateness.total_seconds() * 1000))


def since(df: DataFrame, mark: datetime | None, millis: str = "ts", lateness: timedelta = LATENESS) -> DataFrame:
    """Rows newer than ``mark`` less the lateness; all rows on a first run.

    Rows without a time (NULL, or the load default 0) cannot be late: they stay, so that an increment and a
    full build agree on them. The raw epoch column is compared with constants, which reach the scan.
    """
    if mark is None:
        return df
    time = F.col(millis)
    return df.where((time > _cutoff_millis(mark, lateness)) | time.isNull() | (time == 0))


def late_rows(df: DataFrame, mark: datetime | None, millis: str = "ts", lateness: timedelta = LATENESS) -> DataFrame:
    """The rows ``since`` leaves out, so that they can be counted."""
    if mark is None:
        return df.limit(0)
    return df.where((F.col(millis) <= _cutoff_millis(mark, lateness)) & (F.col(millis) != 0))


def sync_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows in the columns of ``new``: added ones NULL, removed ones gone."""
    have = set(old.columns)
    return old.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in new.schema.fields
        ]
    )


def merge_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: updates replace target rows with an equal key (NULL equals NULL), others stay."""
    kept = join_null_safe(target, updates.select(*keys), keys, "left_anti")
    return sync_schema(kept, updates).unionByName(updates)


def require_unique(updates: DataFrame, keys: list[str]) -> None:
    """A merge needs at most one update per key; raise with an example otherwise."""
    repeated = updates.groupBy(*keys).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"several updates for one key: {repeated.asDict()}")


def only_partitions_of(target: DataFrame, updates: DataFrame, partition: str) -> DataFrame:
    """The part of ``target`` in the partitions ``updates`` falls in, as a filter that prunes folders."""
    # One value per day or bucket, never per row.
    touched = [r[0] for r in updates.select(partition).distinct().collect()]
    wanted = F.col(partition).isin([v for v in touched if v is not None])
    return target.where(wanted | F.col(partition).isNull() if None in touched else wanted)


def merge_by_key(
    path: str,
    updates: DataFrame,
    keys: list[str],
    partition_by: str,
    order_by: Sequence[str] = (),
    stored: bool = False,
    unique: bool = False,
) -> None:
    """Upsert ``updates`` into the parquet table at ``path``, created on first use.

    ``partition_by`` must be a function of the key, so that a row never moves
    between partitions. Then only the partitions the updates touch are read and
    rewritten (dynamic overwrite); all others are left alone. Running the same
    updates again gives the same table.

    The updates are computed once, beside the table: they are read for the
    uniqueness check, the partitions touched and the merge itself. The merged
    partitions are written beside the table too before any is replaced. If that
    last step is cut off, the next merge first repeats it from there, so a table
    holds the old or the new rows of a partition, never neither for good. Both
    copies are deleted at the end.

    ``stored=True``: the updates are read from files that do not change meanwhile, so no copy of them is made. ``unique=True``:
    they were reduced to one row per key already, so they are not counted again.
    """
    from ..sinks import delete_path, table_exists, write_partitioned

    spark = updates.sparkSession
    staged = f"{path.rstrip('/')}__updates"
    finish_swap(spark, path, partition_by, order_by)
    if not stored:
        updates.write.mode("overwrite").parquet(staged)
        updates = spark.read.schema(updates.schema).parquet(staged)
    if not unique:
        require_unique(updates, keys)
    if table_exists(spark, path):
        target = spark.read.parquet(path)
        # A change of columns rewrites the whole table, so that all files agree.
        if dict(target.dtypes) == dict(updates.dtypes):
            target = only_partitions_of(target, updates, partition_by)
        swap_partitions(path, merge_rows(target, updates, keys).select(*updates.columns), partition_by, order_by)
    else:
        write_partitioned(updates, path, [partition_by], order_by)
    if not stored:
        delete_path(spark, staged)


def finish_swap(spark, path: str, partition_by: str, order_by: Sequence[str] = ()) -> None:
    """Repeat the last step of a swap that was cut off while it replaced partitions."""
    from ..sinks import delete_path, path_exists, write_partitioned

    pending = f"{path.rstrip('/')}__pending"
    if path_exists(spark, f"{pending}/_SUCCESS"):
        # Its files are laid out by partition already: they are read and written again without a shuffle.
        write_partitioned(spark.read.parquet(pending), path, [partition_by], order_by, gathered=True)
    delete_path(spark, pending)


def swap_partitions(path: str, rows: DataFrame, partition_by: str, order_by: Sequence[str] = ()) -> None:
    """Replace the partitions of ``rows``, which may read the table itself: they are written beside it first."""
    from ..sinks import write_partitioned

    # Whole, so that the writer's mark says that it is: replacing single partitions leaves none.
    write_partitioned(rows, f"{path.rstrip('/')}__pending", [partition_by], order_by, replace_all=True)
    finish_swap(rows.sparkSession, path, partition_by, order_by)


def replace_keys(
    path: str, rows: DataFrame, gone: DataFrame, keys: list[str], partition_by: str, order_by: Sequence[str] = ()
) -> None:
    """Splice: all rows of the keys in ``gone`` leave the parquet table at ``path`` and ``rows`` come in; several rows may share a key.

    ``gone`` and ``rows`` hold the partition column, a function of the key. Only the partitions of ``gone`` are read and
    rewritten, and a splice that was cut off is finished by the next one. A partition is not emptied: of keys that all leave without new rows, the last
    rows of a partition stay.
    """
    spark = rows.sparkSession
    finish_swap(spark, path, partition_by, order_by)
    target = only_partitions_of(spark.read.parquet(path), gone, partition_by)
    kept = join_null_safe(target, gone.select(*keys), keys, "left_anti").select(*rows.columns)
    swap_partitions(path, kept.unionByName(rows), partition_by, order_by)
