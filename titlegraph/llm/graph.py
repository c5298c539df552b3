"""Connected components of a table of links, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b); component is the smallest id reachable.

    Large-star and small-star steps in turn: each hangs neighbours on the smallest id seen, by aggregates of one value a
    key, until only stars are left (a number of rounds in the logarithm of the longest path). Each round is written to
    the shared folder, and the round before it is deleted.
    """
    spark = links.sparkSession
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components")  # written, so that a hub's join can be split
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "components")
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        moved = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        after = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        for done in (edges, low, large, least):
            drop(spark, done)
        edges, now = after, after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first()
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component")))
