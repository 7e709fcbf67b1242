"""Event schemas, load defaults and feed layouts.

Fixed values: column names, types and defaults below are the wire contract of
the six event topics and the two flat-file feeds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}


def ddl(text: str) -> T.StructType:
    """Flat ``name TYPE, ...`` lists, readable before any session exists."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# What a producer sends (JSON). userId is 64-bit in every topic.
_PLACE = "city STRING, zip INT, state STRING, userAgent STRING, lon DOUBLE, lat DOUBLE"
_PERSON = "lastName STRING, firstName STRING, gender STRING, registration BIGINT"

WIRE = {
    "listen_events": ddl(
        f"""artist STRING, song STRING, duration DOUBLE, ts BIGINT, sessionId INT, auth STRING,
        level STRING, itemInSession INT, {_PLACE}, userId BIGINT, {_PERSON}"""
    ),
    "page_view_events": ddl(
        f"""ts BIGINT, sessionId INT, page STRING, auth STRING, method STRING, status INT,
        level STRING, itemInSession INT, {_PLACE}, userId BIGINT, {_PERSON}, artist STRING,
        song STRING, duration DOUBLE, ad_revenue DOUBLE"""
    ),
    "auth_events": ddl(
        f"""ts BIGINT, sessionId INT, level STRING, itemInSession INT, {_PLACE}, userId BIGINT,
        {_PERSON}, success BOOLEAN"""
    ),
    "session_start_end_events": ddl(f"ts BIGINT, sessionId INT, userId BIGINT, action STRING, {_PLACE}"),
    "status_change_events": ddl(f"ts BIGINT, userId BIGINT, level STRING, {_PLACE}, {_PERSON}"),
    "user_info": ddl(
        """ts BIGINT, userId BIGINT, firstName STRING, lastName STRING, gender STRING, level STRING,
        registration BIGINT"""
    ),
}

TOPICS = tuple(WIRE)

# Topics whose song and artist text arrives octal-escaped.
REPAIRED_TEXT = {"listen_events": ("song", "artist"), "page_view_events": ("song", "artist")}

# What the hourly load stores; integers widen to 64 bit.
_PLACE_W = _PLACE.replace("zip INT", "zip BIGINT")
_VISIT_W = f"level STRING, itemInSession BIGINT, {_PLACE_W}, userId BIGINT, {_PERSON}"

RAW = {
    "listen_events": ddl(
        f"artist STRING, song STRING, duration DOUBLE, ts BIGINT, sessionId BIGINT, auth STRING, {_VISIT_W}"
    ),
    "page_view_events": ddl(
        f"""ts BIGINT, sessionId BIGINT, page STRING, auth STRING, method STRING, status BIGINT,
        {_VISIT_W}, artist STRING, song STRING, duration DOUBLE, ad_revenue DOUBLE"""
    ),
    "auth_events": ddl(f"ts BIGINT, sessionId BIGINT, {_VISIT_W}, success BOOLEAN"),
    "session_start_end_events": ddl(f"ts BIGINT, sessionId BIGINT, auth STRING, {_VISIT_W}"),
    "status_change_events": ddl(f"ts BIGINT, sessionId BIGINT, auth STRING, {_VISIT_W}"),
    "user_info": ddl(f"userId BIGINT, {_PERSON}, ts BIGINT"),
}

# Defaults for absent or unreadable values, by type, with one column exception.
DEFAULT_BY_TYPE = {T.StringType(): "NA", T.LongType(): 0, T.DoubleType(): 0.0, T.BooleanType(): False}
DEFAULT_BY_COLUMN = {"duration": -1.0}


def load_default(field: T.StructField):
    return DEFAULT_BY_COLUMN.get(field.name, DEFAULT_BY_TYPE[field.dataType])


@dataclass(frozen=True)
class FeedSpec:
    """A headerless delimited text feed: all columns in file order, and those kept."""

    schema: T.StructType
    keep: tuple[str, ...]
    delimiter: str = "\t"


# Layouts of the two reference feeds (names already snake-cased;
# the two unnamed columns of the locations feed are na_1 and na_2).
LOCATIONS_FEED = FeedSpec(
    ddl(
        """country_code STRING, postal_code STRING, city STRING, state STRING, state_code STRING,
        borough_county STRING, borough_county_code STRING, na_1 STRING, na_2 STRING, lat DOUBLE,
        long DOUBLE, acc INT"""
    ),
    ("country_code", "postal_code", "city", "state", "state_code", "borough_county", "borough_county_code"),
)
SONGS_FEED = FeedSpec(
    ddl("track_id STRING, artist STRING, title STRING, duration DOUBLE, listen_count BIGINT, genre STRING"),
    ("track_id", "artist", "title", "duration", "genre"),
)
