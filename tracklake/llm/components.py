"""Connected components of a link table, as Spark joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import stored


def _up(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest node it knows."""
    both = edges.select("child", "parent").unionByName(
        edges.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    )
    least = both.groupBy("child").agg(F.min("parent").alias("least"))
    least = least.select(F.col("child").alias("node"), F.least("child", "least").alias("least"))
    moved = both.join(least, F.col("child") == F.col("node")).where("parent > child")
    return moved.select(F.col("parent").alias("child"), F.col("least").alias("parent")).where("child > parent").distinct()


def _down(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("least"))
    moved = edges.join(least, F.col("child") == F.col("node"))
    to = moved.select(F.col("parent").alias("child"), F.col("least").alias("parent")).where("child > parent")
    return to.unionByName(least.select(F.col("node").alias("child"), F.col("least").alias("parent"))).distinct()


def component_roots(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of every node that has a link to another.

    Alternates two star operations until only stars are left, which takes about as many rounds as the logarithm of the
    longest chain. Each round is written to the shared folder. Both operations aggregate before they shuffle and join on plain
    keys, so a node with very many links can be split. Rows with a NULL end are no links.
    """
    a, b = F.col(left), F.col(right)
    edges = stored(
        links.where(a != b).select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).distinct(), "links"
    )
    while True:
        nodes = edges.select(F.col("child").alias("node"), F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
            edges.select(F.col("parent").alias("node"), F.lit(0).alias("c"), F.lit(1).alias("p"))
        )
        seen = nodes.groupBy("node").agg(F.sum("c").alias("c"), F.max("p").alias("p"))
        if seen.where((F.col("c") > 1) | ((F.col("c") > 0) & (F.col("p") > 0))).isEmpty():
            break
        edges = stored(_down(_up(edges)), "stars")
    roots = edges.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("root")).unionByName(roots)
