"""Type-2 history of users from first emissions and level changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import OPEN_END, flipped_level
from .dedup import latest_rows
from .ranking import previous_within

# The load gives this id to events and users without one.
UNKNOWN_USER = 0

PROFILE = ["user_id", "first_name", "last_name", "gender", "registration_datetime"]
VERSION = ["level", "row_effective_datetime", "row_expiry_datetime"]


def _open_end():
    return F.lit(OPEN_END).cast("timestamp")


def final_changes(status: DataFrame) -> DataFrame:
    """The open version each user's last change leads to; changes tied on that time all stay."""
    return latest_rows(status, ["user_id"], "event_datetime").select(
        "user_id",
        flipped_level(F.col("prev_level")).alias("level"),
        F.col("event_datetime").alias("row_effective_datetime"),
        _open_end().alias("row_expiry_datetime"),
    )


def user_history(users: DataFrame, status: DataFrame) -> DataFrame:
    """Versions that end with a change, or never where a user has none.

    A version starts at the user's previous change, or at registration. Changes
    before the user's first emission are left out before the look-back.
    """
    u = users.select(*PROFILE, "level", F.col("event_datetime").alias("_emitted"))
    s = status.select(
        F.col("user_id").alias("_user"), F.col("event_datetime").alias("_changed"), F.col("prev_level").alias("_prev")
    )
    # An inner join can be split on either side where one user has very many changes.
    changed = s.join(u, s["_user"] == u["user_id"]).where(
        F.col("_changed").isNull() | (F.col("_changed") >= F.col("_emitted"))
    )
    ties = [F.col("_emitted"), F.col("first_name"), F.col("last_name"), F.col("gender"), F.col("_prev")]
    history = previous_within(changed, "user_id", "_changed", "_previous", ties).select(
        *PROFILE,
        F.coalesce("_prev", "level").alias("level"),
        F.coalesce("_previous", "registration_datetime").alias("row_effective_datetime"),
        F.coalesce(F.col("_changed"), _open_end()).alias("row_expiry_datetime"),
    )
    known = s.select("_user").distinct()
    unchanged = u.join(known, u["user_id"] == known["_user"], "left_anti").select(
        *PROFILE,
        "level",
        F.col("registration_datetime").alias("row_effective_datetime"),
        _open_end().alias("row_expiry_datetime"),
    )
    return history.unionByName(unchanged)


def _split_unknown(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one key per case: is id 0 many people?, the version they then share).

    Users without an id (NULL, or the load default 0) are many people under one id if they have more than one profile.
    Their profiles and changes do not belong together; joined to each other they would give the product of both counts.
    """
    nobody = users.where(F.coalesce("user_id", F.lit(UNKNOWN_USER)) == UNKNOWN_USER)
    people = F.count_distinct(F.struct("first_name", "last_name", "gender", "registration_datetime"))
    shared = nobody.agg(people.alias("_people"), F.min("registration_datetime").alias("_first")).where("_people > 1")
    kind = dict(users.dtypes)
    version = shared.select(
        F.lit(UNKNOWN_USER).cast(kind["user_id"]).alias("user_id"),
        *[F.lit("NA").alias(c) for c in ("first_name", "last_name", "gender")],
        F.col("_first").alias("registration_datetime"),
        F.lit("free").alias("level"),
        F.col("_first").alias("row_effective_datetime"),
        _open_end().alias("row_expiry_datetime"),
    )
    return shared.select(F.lit(UNKNOWN_USER).cast("bigint").alias("_unknown")), version


def user_versions(users: DataFrame, status: DataFrame) -> DataFrame:
    """All versions of all users: the final states and the history before them.

    If several people share the id 0 or NULL, they share one version, open since their first registration, and their changes
    have no versions; so the result grows with profiles plus changes. A real user 0 is a user like any other.
    """
    unknown, shared = _split_unknown(users)

    def known(df: DataFrame) -> DataFrame:
        key = F.coalesce(F.col("user_id").cast("bigint"), F.lit(UNKNOWN_USER).cast("bigint"))
        return df.join(unknown, key == F.col("_unknown"), "left_anti")

    users, status = known(users), known(status)
    profiles = users.select(*PROFILE).distinct()
    final = profiles.join(final_changes(status), "user_id").select(*PROFILE, *VERSION)
    return final.unionByName(user_history(users, status)).unionByName(shared)
