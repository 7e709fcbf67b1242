"""Surrogate keys: md5 over the text of the key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The token for NULL and the separator decide the key bytes.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def key_text(name: str, dtype: T.DataType) -> str:
    """SQL for the text a key column contributes, in the warehouse's own notation.

    Times print as UTC with 0, 3 or 6 fraction digits and a ``+00`` suffix;
    whole doubles print without ``.0`` (from 1e7 on, and below 1e-3, Spark's
    exponent form stays); everything else is a plain cast.
    """
    column = f"`{name}`"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        instant = f"CAST({column} AS TIMESTAMP)"
        micros = f"pmod(unix_micros({instant}), 1000000)"
        pattern = "yyyy-MM-dd HH:mm:ss"
        return (
            f"CASE WHEN {micros} = 0 THEN date_format({instant}, '{pattern}+00') "
            f"WHEN {micros} % 1000 = 0 THEN date_format({instant}, '{pattern}.SSS+00') "
            f"ELSE date_format({instant}, '{pattern}.SSSSSS+00') END"
        )
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return rf"regexp_replace(CAST({column} AS STRING), r'\.0$', '')"
    return f"CAST({column} AS STRING)"


def surrogate_key(df: DataFrame, columns: list[str]) -> Column:
    """md5 of the ``-``-joined texts of ``columns`` of ``df``; NULL has its own token."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [f"coalesce({key_text(c, types[c])}, '{NULL_TOKEN}')" for c in columns]
    return F.expr(f"md5(concat_ws('{SEPARATOR}', {', '.join(parts)}))")
