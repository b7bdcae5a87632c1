"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, persisted, shared_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node long, component long) of every node that isn't its component's smallest.

    Large-star and small-star steps take turns: every node's larger neighbours are hung
    under its smallest one, then its smaller neighbours are, until nothing changes and
    each component is a star around its smallest node.  Each step is two aggregations
    and two joins on written tables; no component ever meets in one task.  Tables of a
    finished round are deleted.

    Edges with a null end or two equal ends are ignored, repeated ones count once.
    """
    spark = edges.sparkSession
    here: list[str] = []  # the tables of this round

    def written(df: DataFrame) -> DataFrame:
        here.append(shared_dir(spark))
        return persisted(df, here[-1])

    def least_of(pairs: DataFrame) -> DataFrame:
        """(u, m): the smallest v of every u, written, so that a join with it can be split where a u is hot."""
        return written(pairs.groupBy("u").agg(F.min("v").alias("m")))

    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now, before = written(now.distinct()), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, old = state, list(here)
        here.clear()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = least_of(both)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = written(large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct())
        least = least_of(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        dropped(spark, *old)
