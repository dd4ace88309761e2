"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def components(edges: DataFrame, folder: str) -> DataFrame:
    """edges(a, b) -> node, component: the least node that links lead to, for every node with a link.

    Each round is a table in the shared folder. A hot node's links are grouped by the other end in one of the two steps, and only
    minima are taken of them, so no neighbourhood is gathered.
    """
    now = written(edges.filter("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(), folder, "cc0")
    state, step = None, 0
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        mine = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(mine, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(mine.select("u", F.col("m").alias("v"))).distinct()
        step += 1
        new = written(small, folder, f"cc{step}")
        dropped(new.sparkSession, f"{folder}/cc{step - 1}")
        # unchanged once every node hangs on its least node: same links, same sum
        mark = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if mark == state:
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state, now = mark, new
