"""Lateness as state: rows on time once each, late rows marked instead of lost.

A watermark drops what is older than it allows. Here every group of a stream keeps its newest event time and the rows it has let
through within the lateness; a row that is older than the newest time of *earlier* batches less the lateness is late, and comes out marked, so that a
sink can put it aside. State is kept in the checkpoint and survives a restart.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.incremental import LATENESS

STATE = "newest BIGINT, seen ARRAY<STRING>, times ARRAY<BIGINT>"
LATE, ROW, AT = "late", "_row", "_at"


def with_lateness(
    df: DataFrame,
    group: list[str],
    keys: list[str],
    millis: str = "ts",
    lateness: timedelta = LATENESS,
    idle: timedelta | None = None,
) -> DataFrame:
    """The rows of a stream and ``late``: on-time rows once per ``keys``, late rows once per batch.

    ``millis`` is the event time in epoch milliseconds; a row without one is on time. The lateness is judged per ``group``, so a producer that
    is behind does not make others late; a group that is too busy for one task takes a hash of the keys as a further group column, and is
    then judged per hash. NULL is a group like any other, and NULL equals NULL in keys. State per group: one time, and
    a digest of each row of the last ``lateness``. With ``idle`` a group that is silent for so long (processing time) is forgotten, and its next row is on time; this
    needs a trigger that goes on, as a query that waits for such a timeout never runs out of batches.
    """
    if LATE in (c.lower() for c in df.columns):
        raise ValueError(f"the stream has a column {LATE}")
    allowed, forget = int(lateness.total_seconds() * 1000), idle and int(idle.total_seconds() * 1000)
    # A whole number beside a NULL becomes a double in pandas: numbers travel as text, and rows are named before that.
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)]
    name = F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    named = df.withColumns({ROW: name, AT: F.col(millis)}).withColumns({c: F.col(c).cast("string") for c in wide})
    schema = T.StructType([*named.drop(ROW, AT).schema.fields, T.StructField(LATE, T.BooleanType())])

    def judge(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before, seen = None, {}
        if state.exists:
            before, held, times = state.get
            seen = dict(zip(held, times, strict=True))
        newest, told = before, set()
        for rows in parts:
            at, names = rows[AT], rows[ROW]
            late = at < before - allowed if before is not None else pd.Series(False, rows.index)
            late = late.fillna(False).astype(bool)
            fresh = []
            for name, is_late, when in zip(names, late, at, strict=True):
                known = name in (told if is_late else seen)
                fresh.append(not known)
                if is_late:
                    told.add(name)
                else:
                    seen[name] = -1 if pd.isna(when) else int(when)
            if not at.isna().all():
                newest = max(int(at.max()), newest if newest is not None else int(at.max()))
            out = rows[fresh].drop(columns=[ROW, AT]).assign(**{LATE: late[fresh]})
            if len(out):
                yield out
        # What is older now would be late; rows without a time are known for good only within a batch.
        kept = {n: t for n, t in seen.items() if newest is not None and t >= newest - allowed}
        state.update((newest, list(kept), list(kept.values())))
        if forget:
            state.setTimeoutDuration(forget)

    judged = named.groupBy(*group).applyInPandasWithState(
        judge,
        schema,
        T.StructType.fromDDL(STATE),
        "append",
        GroupStateTimeout.ProcessingTimeTimeout if forget else GroupStateTimeout.NoTimeout,
    )
    return judged.withColumns({c: F.col(c).cast("bigint") for c in wide})


def split_sink(df: DataFrame, path: str, late_path: str, checkpoint: str) -> DataStreamWriter:
    """A writer of :func:`with_lateness`: rows on time to ``path``, late ones to ``late_path``, each batch in a folder of its own.

    A batch that is run again after a failure writes its folders anew, so no row is stored twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.persist()  # read for both sides
        for folder, side in ((path, ~F.col(LATE)), (late_path, F.col(LATE))):
            rows.where(side).drop(LATE).write.mode("overwrite").parquet(f"{folder}/batch={number}")
        rows.unpersist()

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
