"""Repair of text that arrives with octal escapes or as mis-decoded UTF-8."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _repaired(text: str) -> str:
    try:
        raw = text.encode("latin-1").decode("unicode-escape").encode("latin-1")
        return raw.decode("utf-8").strip('"')
    except UnicodeError:
        return text  # already readable, or not repairable: keep it


@F.pandas_udf(T.StringType())
def _repair_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_repaired, na_action="ignore")


def repair_text(text: Column) -> Column:
    """Undo escapes, re-read the bytes as UTF-8 and drop outer quotes.

    Text without a backslash stays in the JVM: plain ASCII only needs its quotes
    dropped, and other text within Latin-1 is kept unless its bytes are valid
    UTF-8. Only text with a backslash is handed to the Arrow-batched function.
    """
    escaped = text.rlike(r"\\")
    latin = text.rlike(r"\A[\x00-\xFF]*\z")
    reread = F.try_validate_utf8(F.encode(F.when(latin, text), "ISO-8859-1").cast("string"))
    return (
        F.when(escaped, _repair_batch(F.when(escaped, text)))
        .when(F.length(text) == F.octet_length(text), F.btrim(text, F.lit('"')))
        .otherwise(F.coalesce(F.btrim(reread, F.lit('"')), text))
    )
