"""Connected components of a link table, as rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links(a, b)`` (long, a <> b) -> ``(node, component)``, the smallest node reachable.

    Alternates large-star and small-star steps: every node is re-linked to the
    smallest neighbour, first by its larger neighbours, then by its smaller ones,
    until each component is a star.  Minima are combined before each shuffle and
    the join back on the hub is an ordinary equi-join, which AQE splits when a
    hub holds many links.  Each round is written to the shared folder.
    Nodes without links are not in the result; an empty input gives an empty result.
    """
    edges = store(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "cc")
    before = None
    while True:
        # large star: neighbours above u go to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = store(spark, small, "cc")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
