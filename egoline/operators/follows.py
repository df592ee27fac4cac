"""Follow lists: parsing the landed variants, merging sources, inversion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.functions import columns as C
from egoline.functions.constants import STATUS_NOT_FOLLOWING, STATUS_OK
from egoline.operators.edges import SEGMENT
from egoline.operators.ordered import segments, stored
from egoline.operators.skew import partitions_for


def _status(lst):
    return (F.when(lst.isNull() | (F.size(lst) == 0), F.lit(STATUS_NOT_FOLLOWING))
            .otherwise(F.lit(STATUS_OK)))


def parse_follows_json(df: DataFrame, login: str = "login", following: str = "following",
                       keep=()) -> DataFrame:
    """Variant F1 (list of JSON texts) -> ``(username, following, status)``; a bad
    element nulls the whole list."""
    lst = C.follows_from_json(following)
    return df.select(*keep, F.col(login).alias("username"), lst.alias("following"),
                     _status(lst).alias("status"))


def parse_follows_struct(df: DataFrame, login: str = "login", following: str = "following",
                         keep=()) -> DataFrame:
    """Variant F2 (list of structs with ``login``) -> ``(username, following, status)``."""
    lst = C.follows_from_structs(following)
    return df.select(*keep, F.col(login).alias("username"), lst.alias("following"),
                     _status(lst).alias("status"))


def parse_follows_fetched(df: DataFrame, login: str = "login", following: str = "following",
                          keep=()) -> DataFrame:
    """Fetched follow pages (list of structs with ``login``) -> ``(username,
    following, status)``, keeping the logins before the first bad element."""
    lst = C.follows_until_bad(following)
    return df.select(*keep, F.col(login).alias("username"), lst.alias("following"),
                     _status(lst).alias("status"))


def merge_sources(sources, key: str = "username", tie=None) -> DataFrame:
    """Last-writer-wins across sources given as ``[(priority, df), ...]``
    (see :func:`merge_prioritised`)."""
    frames = [df.withColumn("_prio", F.lit(prio)) for prio, df in sources]
    return merge_prioritised(reduce(DataFrame.unionByName, frames), "_prio", key, tie).drop("_prio")


def merge_prioritised(df: DataFrame, priority: str, key: str = "username", tie=None) -> DataFrame:
    """For every key the row of the highest ``priority``, ties broken by the
    ``tie`` columns in order (highest wins). A null list of the winner wins too.

    This is one ``max_by`` aggregate: partial per task, so a key present in many
    rows still sends one candidate per task through the shuffle.
    """
    ties = [tie] if isinstance(tie, str) else list(tie or ())
    values = [c for c in df.columns if c != key]
    won = df.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(priority, *ties)).alias("_w"))
    return won.select(key, *[F.col("_w")[c].alias(c) for c in values])


def follow_edges(userfollow: DataFrame, key: str = "username", following: str = "following") -> DataFrame:
    """List form -> long form ``(username, pos, followee)``.

    A user whose list is null or empty keeps one row with null ``pos`` and
    ``followee``, so "follows no one" stays distinct from "not stored".
    """
    return userfollow.select(F.col(key).alias("username"),
                             F.posexplode_outer(following).alias("pos", "followee"))


def _follower_counts(df: DataFrame, key: str, list_col: str, strip: int) -> tuple[DataFrame, int]:
    """``(member, k, n)``: how often ``k`` lists a member, and the number of partitions
    it lies in, by member and ``k``.

    The pairs are stored and counted first: the partitions follow their number, so
    what a task counts does not grow with the table. A plain aggregate would leave
    that to adaptive execution, which makes about as many tasks as there are cores.
    """
    member = F.col("m")
    for _ in range(strip):
        member = C.strip_first(member)
    pairs = stored(df.select(F.col(key).alias("k"), F.explode(list_col).alias("m")).select(member.alias("member"), F.col("k")), "pairs")
    n = partitions_for(pairs)
    return pairs.repartition(n, "member", "k").groupBy("member", "k").agg(F.count(F.lit(1)).alias("n")), n


def invert_segments(df: DataFrame, key: str = "login", list_col: str = "following", strip: int = 1, size: int = SEGMENT) -> DataFrame:
    """``(username, segment, entries)``: :func:`invert` in cells of at most ``size``
    entries ``(follower, n)``, so a member with a third of all followers fills
    many cells, written by many tasks."""
    pairs = _follower_counts(df, key, list_col, strip)[0].select(F.col("member").alias("username"), F.col("k").alias("follower"), "n")
    return segments(pairs, ["username"], ["follower"], F.struct("follower", "n"), size)


def invert(df: DataFrame, key: str = "login", list_col: str = "following", strip: int = 1,
           out_key: str = "username", out_list: str = "following") -> DataFrame:
    """Invert adjacency: rows ``(key, [members])`` -> ``(member, [keys])``.

    Each member loses its first ``strip`` characters (the stored follower names
    carry a one-character prefix). Lists keep duplicates and are sorted. The
    pairs are counted first, so the per-member group holds one entry per distinct
    partner, not one per raw row; the members are dealt into as many partitions.
    """
    counts, n = _follower_counts(df, key, list_col, strip)
    grouped = counts.repartition(n, "member").groupBy("member").agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("p"))
    lst = F.flatten(F.transform("p", lambda x: F.array_repeat(x["k"], x["n"].cast("int"))))
    return grouped.select(F.col("member").alias(out_key), lst.alias(out_list))
