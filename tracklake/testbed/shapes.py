"""Event-shaped raw tables over the given parquet tables, as lazy Spark views.

``shapes_sql`` states the same tables for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc

USER_AGENT = '"Mozilla/5.0"'


class Shapes:
    """The six raw event tables and two feeds, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = pin_utc(spark), sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        """A raw table by name, as the models ask for it."""
        if name not in self._built:
            self._built[name] = getattr(self, name)()
        return self._built[name]

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in self._built:
            self._built[path] = self.spark.read.parquet(path)
        return self._built[path]

    def ev(self) -> DataFrame:
        """Events with epoch milliseconds and the number in their properties."""
        return self.table("events").select(
            "event_id",
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
            F.col("ts").cast("timestamp").alias("at"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )

    def people(self) -> DataFrame:
        """Customers with where they live and when they registered."""
        registered = F.lit(1_701_410_400_000) + (F.col("c_custkey") % 45) * 86_400_000
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("person"),
                F.col("c_name").alias("lastName"),
                F.col("c_mktsegment").alias("firstName"),
                F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                registered.alias("registration"),
                F.col("n_nationkey").cast("bigint").alias("zip"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.col("c_acctbal").alias("lon"),
                (-F.col("c_acctbal")).alias("lat"),
            )
        )

    def _visits(self, events: DataFrame) -> DataFrame:
        """Events with the person behind them and the place and session columns."""
        k = F.col("k")
        return (
            events.join(self["people"], F.col("user_id") == F.col("person"))
            .withColumns(
                {
                    "userId": F.col("user_id"),
                    "ts": F.col("ms"),
                    "sessionId": F.col("user_id") * 1000 + F.dayofyear("at"),
                    "itemInSession": (F.hour("at") * 60 + F.minute("at")).cast("bigint"),
                    "auth": F.when(k % 20 == 0, "Guest").otherwise("Logged In"),
                    "level": F.when(k >= 50, "paid").otherwise("free"),
                    "userAgent": F.lit(USER_AGENT),
                    "city": F.when(k % 25 != 4, F.col("city")),
                    "zip": F.when(k % 50 != 9, F.col("zip")),
                }
            )
        )

    def listen_events(self) -> DataFrame:
        k = F.col("k")
        played = self._visits(self["ev"].where(F.col("event_type").isin("click", "view"))).join(
            self.table("part"), k == F.col("p_partkey")
        )
        name = F.col("p_name")
        song = (
            F.when(k % 10 == 0, F.lit("NA"))
            .when(k % 10 == 3, F.concat(F.lit('"'), name, F.lit('é"')))
            .when(k % 10 == 7, F.concat(name, F.lit("\\")))
            .otherwise(name)
        )
        artist = F.when(k % 4 == 1, F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" "))).otherwise(F.col("p_brand"))
        rows = played.select(
            artist.alias("artist"),
            song.alias("song"),
            (F.col("p_retailprice") + (k % 5 - 2) * F.lit(0.004)).alias("duration"),
            "ts", "sessionId", "auth", "level", "itemInSession", "city", "zip", "state", "userAgent", "lon",
            "lat", "userId", "lastName", "firstName", "gender", "registration",
            repeated(7).alias("_copies"),
        )
        return with_copies(rows)

    def page_view_events(self) -> DataFrame:
        k, kind = F.col("k"), F.col("event_type")
        page = (
            F.when((kind == "click") & (k % 10 == 3), "Settings")
            .when((kind == "click") & (k % 10 == 4), "Help")
            .when(kind == "click", "NextSong")
            .when(kind == "view", "Home")
            .when(kind == "purchase", "Submit Upgrade")
            .when(kind == "signup", "PlayAd")
            .when((kind == "error") & (k % 10 == 5), "Lounge")
            .otherwise("Error")
        )
        rows = self._visits(self["ev"]).select(
            "ts", "sessionId", page.alias("page"), "auth", F.lit("PUT").alias("method"),
            F.lit(200).cast("bigint").alias("status"), "level", "itemInSession", "city", "zip", "state",
            "userAgent", "lon", "lat", "userId", "lastName", "firstName", "gender", "registration",
            F.lit(None).cast("string").alias("artist"), F.lit(None).cast("string").alias("song"),
            F.lit(None).cast("double").alias("duration"),
            F.when(kind == "signup", F.col("value")).alias("ad_revenue"),
            repeated(11).alias("_copies"),
        )
        return with_copies(rows)

    def status_change_events(self) -> DataFrame:
        kind = F.col("event_type")
        rows = self._visits(self["ev"].where(kind.isin("purchase", "error"))).select(
            "ts", "userId", F.when(kind == "purchase", "FREE").otherwise("paid").alias("level"), "city", "zip",
            "state", "userAgent", "lon", "lat", "lastName", "firstName", "gender", "registration",
            repeated(5).alias("_copies"),
        )
        return with_copies(rows)

    def user_info(self) -> DataFrame:
        """One record per sign-up event: the same person is emitted many times."""
        return self._visits(self["ev"].where(F.col("event_type") == "signup")).select(
            "userId", "lastName", "firstName", "gender", "registration", "ts"
        )

    def auth_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self._visits(self["ev"].where(kind.isin("signup", "error"))).select(
            "ts", "sessionId", "level", "itemInSession", "city", "zip", "state", "userAgent", "lon", "lat",
            "userId", "lastName", "firstName", "gender", "registration", (kind == "signup").alias("success"),
        )

    def session_start_end_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self._visits(self["ev"].where(kind.isin("view", "purchase"))).select(
            "ts", "sessionId", "userId", F.when(kind == "view", "start").otherwise("end").alias("action"),
            "city", "zip", "state", "userAgent", "lon", "lat",
        )

    def songs(self) -> DataFrame:
        title = F.when(F.col("p_partkey") % 10 == 3, F.concat(F.col("p_name"), F.lit("ü"))).otherwise(F.col("p_name"))
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("track_id"),
            F.col("p_brand").alias("artist"),
            title.alias("title"),
            F.col("p_retailprice").alias("duration"),
            F.col("p_type").alias("genre"),
        )

    def locations(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.when(F.col("n_nationkey") % 4 == 3, "ca").otherwise("US").alias("country_code"),
                F.col("n_nationkey").cast("string").alias("postal_code"),
                F.col("n_name").alias("city"),
                F.when(F.col("n_nationkey") % 8 != 6, F.col("r_name")).alias("state"),
                F.col("r_name").alias("state_code"),
            )
        )


def repeated(every: int) -> Column:
    """Two copies of every n-th event, one of the others."""
    return F.when(F.col("event_id") % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))


def with_copies(df: DataFrame) -> DataFrame:
    return df.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")
