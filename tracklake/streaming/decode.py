"""From message bytes to typed event rows. The same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import millis_to_timestamp, plausible_millis, repair_text, time_parts
from ..schemas import REPAIRED_TEXT, WIRE

CORRUPT = "_corrupt_record"
UNREADABLE_FIELD = "unreadable field"

# Literals that a field of each type is sure to take. A time of up to 14 digits is plausible. The control characters are listed one by one:
# Java looks single characters up in a table, and tries ranges in turn.
_RUN = r'[^"\\' + "".join(rf"\x{code:02X}" for code in range(32)) + "]*"
_SURE = {
    T.StringType(): rf'"{_RUN}(?:\\["\\/bfnrt]{_RUN}){{0,50}}"',
    T.LongType(): r"-?(?:0|[1-9][0-9]{0,17}+)",
    T.IntegerType(): r"-?(?:0|1[0-9]{9}|20[0-9]{8}|[1-9][0-9]{0,8}+)",
    T.DoubleType(): r"-?(?:0|[1-9][0-9]{0,17}+)(?:\.[0-9]{1,20}+)?+(?:E-?[0-9]{1,2}+)?+",
    T.BooleanType(): "(?:true|false)",
}
_SURE_TIME = "[1-9][0-9]{0,13}+"
_SURE_BYTES = 1_000_000  # the parser has limits of its own for very long texts


def decoded_with_context(messages: DataFrame, topic: str) -> DataFrame:
    """``data`` (the typed event and, if unreadable, the raw text) beside the message columns.

    ``data`` comes out of an ``explode`` of one element: no filter on it is moved below and parses the text again for each
    field it names.
    """
    schema = T.StructType([*WIRE[topic].fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return messages.withColumn("data", F.explode(F.array(parsed)))


def doubtful(messages: DataFrame, topic: str) -> DataFrame:
    """Messages without those that are readable at a glance, so that dead letters are looked for without parsing each message again.

    A message is left out if it is one object of the topic's fields in their declared order, written without spaces, each with a literal
    that its type is sure to take, and a plausible time; other fields may be absent. Anything else is for the parser to decide.
    """
    parts, comma = [], False
    for field in WIRE[topic].fields:
        pair = f'"{field.name}":{_SURE_TIME if field.name == "ts" else _SURE[field.dataType]}'
        if field.name == "ts":
            parts.append(pair)
            comma = True
        else:
            parts.append(f"(?:,{pair})?+" if comma else f"(?:{pair},)?+")
    sure = F.col("value").cast("string").rlike(r"\A\{" + "".join(parts) + r"\}\z")
    return messages.where(~F.coalesce(sure & (F.octet_length("value") <= _SURE_BYTES), F.lit(False)))


def _reason() -> Column:
    """What is wrong with a message; NULL for a good one.

    Only the event time is needed to store a message. A field of the wrong type
    is NULL in an event that is kept all the same; its raw message becomes a
    dead letter too (``UNREADABLE_FIELD``), so that nothing sent is lost.
    """
    no_time = F.col("data").isNull() | F.col("data.ts").isNull()
    return (
        F.when(F.col("value").isNull(), "empty message")
        .when(no_time & F.col(f"data.{CORRUPT}").isNotNull(), "unreadable json")
        .when(no_time, "no event time")
        .when(~plausible_millis(F.col("data.ts")), "event time out of range")
        .when(F.col(f"data.{CORRUPT}").isNotNull(), UNREADABLE_FIELD)
    )


def readable(decoded: DataFrame) -> DataFrame:
    """Messages that are stored as events."""
    reason = _reason()
    return decoded.where(reason.isNull() | (reason == UNREADABLE_FIELD))


def rejected(decoded: DataFrame) -> DataFrame:
    """Dead letters: the raw message, its origin and what is wrong with it."""
    return decoded.withColumn("reason", _reason()).where("reason IS NOT NULL").select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "reason"
    )


def decode_events(messages: DataFrame, topic: str, keep_unreadable: bool = False) -> DataFrame:
    """Typed rows with ``ts`` as a time, its parts, and repaired text.

    ``keep_unreadable=True`` lets messages that cannot be read through as rows of
    NULLs, as a permissive decoder does; otherwise they are for ``rejected``.
    """
    decoded = decoded_with_context(messages, topic)
    rows = (decoded if keep_unreadable else readable(decoded)).select("data.*").drop(CORRUPT)
    rows = time_parts(rows.withColumn("ts", millis_to_timestamp(F.col("ts"))), "ts")
    return rows.withColumns({c: repair_text(F.col(c)) for c in REPAIRED_TEXT.get(topic, ())})
