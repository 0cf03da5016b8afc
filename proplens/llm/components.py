"""Connected components of a link table by alternating large-star and small-star steps.

Both steps only rewrite links: a node's neighbours are tied to the smallest of them, a node with many neighbours is met
as (node, its minimum) in a join that Spark splits where it is large, and every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.llm.common import forget, written


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Ties the larger (large star: of all neighbours; small star: of the smaller ones and itself) to the minimum."""
    near = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    if both:
        near = near.unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = near.join(least, "u")
    tied = tied.filter("v > u").select("v", "m") if both else tied.select("v", "m").unionByName(
        least.select(F.col("u").alias("v"), "m"))
    return tied.filter("v <> m").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (smallest node reachable) for every node that has a link; self links and repeats don't matter."""
    links = written(links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo < hi").distinct(),
                    "links")
    while not links.isEmpty():
        large = written(_star(links, True), "large-star")
        small = written(_star(large, False), "small-star")
        # Done when every node hangs on one that hangs on none.
        done = small.select(F.col("hi").alias("n")).join(small.select(F.col("lo").alias("n")), "n", "left_semi").isEmpty()
        same = done and small.groupBy("hi").count().filter("count > 1").isEmpty()
        forget(links)
        forget(large)
        links = small
        if same:
            break
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
