"""A layout in which file statistics skip on every one of several columns, not on the first alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import MAX_ROWS_PER_FILE

KEY = "_interleaved"


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = 6, sample_rows: int = 20_000) -> dict[str, list]:
    """Per column at most ``2 ** bits - 1`` rising values that part its rows evenly, by a bounded sample of all rows.

    They say where rows are laid, never which rows there are.
    """
    sample = df.select(*[F.col(f"`{c}`") for c in columns]).orderBy(F.rand(17)).limit(sample_rows).collect()
    bounds = {}
    for at, column in enumerate(columns):
        values = sorted(r[at] for r in sample if r[at] is not None and r[at] == r[at])
        parts = 2**bits
        bounds[column] = sorted({values[k * len(values) // parts] for k in range(1, parts)}) if values else []
    return bounds


def _at_most(value: Column) -> Callable[[Column], Column]:
    return lambda bound: bound <= value


def interleaved_key(bounds: dict[str, list], bits: int = 6) -> Column:
    """The bits of all columns' ranks in turn, the highest of the first column first. NULL has the lowest rank."""
    many = len(bounds)
    if many * bits > 62:
        raise ValueError(f"{many} columns of {bits} bits do not fit a long")
    key = F.lit(0).cast("bigint")
    for at, (column, steps) in enumerate(bounds.items()):
        if not steps:
            continue
        shift = many - 1 - at
        spread = [sum((rank >> bit & 1) << (bit * many + shift) for bit in range(bits)) for rank in range(len(steps) + 1)]
        passed = F.size(F.filter(F.array(*[F.lit(v) for v in steps]), _at_most(F.col(f"`{column}`"))))
        key = key + F.element_at(F.array(*[F.lit(v).cast("bigint") for v in spread]), passed + 1)
    return key


def write_interleaved(df: DataFrame, path: str, cluster_by: Sequence[str], bits: int = 6, sample_rows: int = 20_000) -> None:
    """Write so that a filter on any column of ``cluster_by`` reads a part of the files.

    One shuffle, on the key; rows of one key part by a hash, so that a busy key goes to several tasks. ``df`` is read three
    times (sample, ranges, rows): hand over a table, not a long plan. Any sortable column types; no rows give a table without rows.
    """
    if KEY in df.columns:
        raise ValueError(f"a column is named {KEY}")
    plain = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    keyed = df.withColumn(KEY, interleaved_key(rank_bounds(df, cluster_by, bits, sample_rows), bits))
    (
        keyed.repartitionByRange(KEY, F.xxhash64(*plain))
        .sortWithinPartitions(KEY, *[F.col(f"`{c}`") for c in cluster_by])
        .drop(KEY)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .parquet(path)
    )
