"""Schema-tolerant load: every declared column is produced, whatever the source has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import to_epoch_millis
from ..schemas import load_default


def field_or_null(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """The column and its type, or a typed NULL where ``df`` lacks it."""
    for field in df.schema.fields:
        if field.name == name:
            return F.col(f"`{name}`"), field.dataType
    return F.lit(None).cast("string"), T.StringType()


def _read_as(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StringType):
        return value.cast("string")
    if isinstance(want, T.BooleanType):
        # Only true and false count; Spark alone would also take 'yes', '1', 't'.
        word = F.lower(value.cast("string"))
        return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
    if isinstance(want, T.LongType):
        if isinstance(have, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.when(F.floor(value) == value, value.try_cast("bigint"))  # 1.5 is not an integer
        if isinstance(have, T.BooleanType):
            return F.lit(None).cast("bigint")
        return value.try_cast("bigint")
    return value.try_cast(want)


def load_tolerant(df: DataFrame, schema: T.StructType, time_column: str = "ts") -> DataFrame:
    """Cast to ``schema``; absent, NULL or unreadable values become the column's default."""
    columns = []
    for field in schema.fields:
        value, have = field_or_null(df, field.name)
        read = to_epoch_millis(value, have) if field.name == time_column else _read_as(value, have, field.dataType)
        columns.append(F.coalesce(read, F.lit(load_default(field))).cast(field.dataType).alias(field.name))
    return df.select(*columns)
