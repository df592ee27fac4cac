"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import written


def state(links: DataFrame) -> tuple:
    """A fingerprint by which two rounds' link sets are told apart."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def least(links: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours; combined before the shuffle, so hubs are no burden."""
    return links.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` for every node of a link: the smallest node of its component.

    Rounds halve the depth of the trees, so their number grows with the
    logarithm of the longest path. Each round is written, which cuts the
    lineage and lets a lost executor reread it.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = written(e, "links")
    before = state(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both), F.col("u") == F.col("node")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "links")
        found = large.join(least(large), F.col("u") == F.col("node"))
        small = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(found.select("u", F.col("m").alias("v")))
        e = written(small.filter("u <> v").distinct(), "links")
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select(F.col("v"), F.col("v")).distinct())
