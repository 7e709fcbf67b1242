"""Declarative data checks.

``violations`` gives the offending rows or groups of one check; ``check_report``
counts them for many checks, reading each model once for all row-level checks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_LEVEL = ("not_null", "accepted_range")


@dataclass(frozen=True)
class Check:
    """kind: unique, not_null, accepted_values, relationships, accepted_range, unique_combination."""

    model: str
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    parent: str | None = None
    parent_column: str | None = None

    @property
    def column(self) -> str:
        return self.columns[0]

    @property
    def column_text(self) -> str:
        return ", ".join(self.columns)


def _row_is_bad(check: Check) -> Column:
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    bounds = []
    if check.low is not None:
        bounds.append(value >= check.low if check.inclusive else value > check.low)
    if check.high is not None:
        bounds.append(value <= check.high if check.inclusive else value < check.high)
    return ~reduce(lambda a, b: a & b, bounds)  # NULL stays NULL: not a violation


def violations(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """Offending rows (row-level checks) or offending groups with their row counts."""
    df = tables[check.model]
    if check.kind in ROW_LEVEL:
        return df.where(_row_is_bad(check))
    present = df if check.kind == "unique_combination" else df.where(F.col(check.column).isNotNull())
    groups = present.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records"))
    if check.kind in ("unique", "unique_combination"):
        return groups.where("n_records > 1")
    if check.kind == "accepted_values":
        return groups.where(~F.col(check.column).isin(list(check.values)))
    if check.kind == "relationships":
        # Distinct keys are checked, not rows, so a frequent key costs nothing extra.
        known = tables[check.parent].select(F.col(check.parent_column).alias("_parent")).distinct()
        return groups.join(known, groups[check.column] == known["_parent"], "left_anti")
    raise ValueError(f"unknown check kind: {check.kind}")


def _failure_count(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    bad = violations(check, tables)
    if check.kind == "relationships":  # orphans count per row
        counted = bad.agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("failures"))
    else:
        counted = bad.agg(F.count(F.lit(1)).alias("failures"))
    return _labelled(counted, check)


def _labelled(df: DataFrame, check: Check) -> DataFrame:
    return df.select(
        F.lit(check.model).alias("model"),
        F.lit(check.kind).alias("test"),
        F.lit(check.column_text).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        "failures",
    )


def _row_level_counts(checks: list[Check], df: DataFrame) -> DataFrame:
    """All row-level checks of one model in a single pass over the columns they name."""
    counts = [F.count_if(_row_is_bad(c)).alias(f"_c{i}") for i, c in enumerate(checks)]
    cells = F.array(
        *[
            F.struct(
                F.lit(c.model).alias("model"),
                F.lit(c.kind).alias("test"),
                F.lit(c.column_text).alias("column_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"_c{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return df.agg(*counts).select(F.inline(cells))


def check_report(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """(model, test, column_name, severity, failures), one row per check."""
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        row_level = [c for c in checks if c.model == model and c.kind in ROW_LEVEL]
        if row_level:
            parts.append(_row_level_counts(row_level, tables[model]))
        parts += [_failure_count(c, tables) for c in checks if c.model == model and c.kind not in ROW_LEVEL]
    return reduce(DataFrame.unionByName, parts)
