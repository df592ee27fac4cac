"""Weekly trending repositories: star counts over the last week, then top k."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from egoline.functions.constants import TOP_K, TREND_TYPE


def weekly_trends(edges: DataFrame, as_of=None, days: int = 7, event_type: str = TREND_TYPE) -> DataFrame:
    """``(reponame, watchcount)`` for events of ``event_type`` in ``(as_of - days, as_of]``.

    ``as_of`` defaults to the latest event time in the input. Both bounds are
    then scalar subqueries over one aggregate, plain values for the scan's
    filters (no arithmetic on them is left to the rows).
    The count is combined map-side, so a hot repository costs one row per task
    in the shuffle.
    """
    week = F.expr(f"INTERVAL {int(days)} DAYS")
    if as_of is None:
        as_of, start = edges.agg(F.max("ts")).scalar(), edges.agg(F.max("ts") - week).scalar()
    else:
        as_of = as_of if hasattr(as_of, "_jc") else F.lit(as_of).cast("timestamp")
        start = as_of - week
    return (edges
            .filter((F.col("type") == F.lit(event_type)) & (F.col("ts") > start) & (F.col("ts") <= as_of))
            .groupBy(F.col("repo").alias("reponame"))
            .agg(F.count(F.lit(1)).alias("watchcount")))


def day_of(ts) -> Column:
    """The UTC day of a time, whatever the session time zone."""
    return F.to_date(F.to_utc_timestamp(ts, F.current_timezone()))


def day_counts(edges: DataFrame) -> DataFrame:
    """``(part, day, type, repo, n, latest)``: partial counts that add up, by the edges' UTC day."""
    return edges.groupBy("part", "day", "type", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))


def merge_day_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of both; any grouping of the batches gives the same table."""
    both = old.unionByName(new)
    return both.groupBy("part", "day", "type", "repo").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))


def week_days(as_of_micros: int, days: int = 7) -> list:
    """The UTC days that ``(as_of - days, as_of]`` touches."""
    end = datetime.fromtimestamp(as_of_micros / 1_000_000, timezone.utc).date()
    return [end - timedelta(d) for d in range(days, -1, -1)]


def weekly_trends_from_days(counts: DataFrame, edges: DataFrame, as_of_micros: int, days: int = 7,
                            event_type: str = TREND_TYPE) -> DataFrame:
    """:func:`weekly_trends` from day counts: the days inside the window come from
    ``counts``, and only its first and last day, which it may cut, from the edges.
    Both tables have a ``day`` column, which is a partition column where they are stored."""
    touched = week_days(as_of_micros, days)
    whole = counts.filter(F.col("day").isin(*touched[1:-1]) & (F.col("type") == event_type)).select("repo", "n")
    end = F.timestamp_micros(F.lit(as_of_micros))
    start = F.timestamp_micros(F.lit(as_of_micros - days * 86_400_000_000))
    cut = (edges.filter(F.col("day").isin(touched[0], touched[-1]) & (F.col("type") == event_type) & (F.col("ts") > start) & (F.col("ts") <= end))
           .select("repo", F.lit(1).cast("long").alias("n")))
    return whole.unionByName(cut).groupBy(F.col("repo").alias("reponame")).agg(F.sum("n").alias("watchcount"))


def top_repos(trends: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top ``k`` by count, ties by name (planned as TakeOrderedAndProject:
    each task keeps its k best, the final merge sees k x tasks rows)."""
    return trends.orderBy(F.desc("watchcount"), F.asc("reponame")).limit(k)


def trending_json(top: DataFrame) -> DataFrame:
    """One row ``json`` = ``{"Trending":[{"reponame":..,"watchcount":..}, ...]}``,
    sorted by count descending, ties by name. The input is the bounded top-k."""
    arr = F.array_sort(
        F.collect_list(F.struct("reponame", "watchcount")),
        lambda l, r: F.when(l["watchcount"] > r["watchcount"], -1)
        .when(l["watchcount"] < r["watchcount"], 1)
        .when(l["reponame"] < r["reponame"], -1)
        .when(l["reponame"] > r["reponame"], 1).otherwise(0))
    return top.agg(F.to_json(F.struct(arr.alias("Trending"))).alias("json"))
