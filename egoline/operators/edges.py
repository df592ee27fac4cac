"""The edge table and the per-user list views built from it.

The edge table (one row per user, repository, part) is canonical; lists are
derived last. A list for a very active user is built from pre-aggregated
(repo, count) pairs, so the final per-user group holds one entry per distinct
repository rather than one per event, and the raw rows are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.functions.constants import PROTOTYPE_TYPES, YEAR_LABEL_PARTS
from egoline.operators.ordered import segments

#: Entries of a list's segment at most.
SEGMENT = 10_000


def parts_for_label(label: str, routing=None) -> tuple:
    """Year label -> the parts (per-year tables) it reads. Unknown label: error."""
    routing = YEAR_LABEL_PARTS if routing is None else routing
    if label not in routing:
        raise ValueError(f"unknown year label {label!r}; expected one of {sorted(routing)}")
    return tuple(routing[label])


def select_parts(edges: DataFrame, label: str | None = None, parts=None, routing=None) -> DataFrame:
    """Keep the parts of a year label (a partition filter on a written edge table)."""
    if parts is None and label is not None:
        parts = parts_for_label(label, routing)
    if parts is None:
        return edges
    return edges.filter(F.col("part").isin(list(parts)))


def user_repos(edges: DataFrame, by_part: bool = True, distinct: bool = False) -> DataFrame:
    """``(username[, part], repos)``: every repository of a user, duplicates kept
    (``distinct=False``) or once (``distinct=True``), sorted by name.

    Stage 1 counts ``(user, part, repo)`` with a map-side partial aggregate; the
    shuffle key includes the repository, so a hot user's rows spread over many
    tasks. Stage 2 gathers one (repo, count) pair per distinct repository.
    """
    keys = ["username", "part"] if by_part else ["username"]
    pairs = (edges.groupBy(*keys, "repo").agg(F.count(F.lit(1)).alias("n"))
             .groupBy(*keys)
             .agg(F.array_sort(F.collect_list(F.struct("repo", "n"))).alias("pairs")))
    if distinct:
        repos = F.transform("pairs", lambda p: p["repo"])
    else:
        repos = F.flatten(F.transform("pairs", lambda p: F.array_repeat(p["repo"], p["n"].cast("int"))))
    return pairs.select(*keys, repos.alias("repos"))


def user_repo_segments(edges: DataFrame, by_part: bool = True, size: int = SEGMENT) -> DataFrame:
    """``(username[, part], segment, entries)``: :func:`user_repos` in cells of at most
    ``size`` entries ``(repo, n)``, a repository's repeats as its count ``n``.

    No cell and no task grows with a user: the counts are keyed by user and
    repository, their order comes from a range sort.
    """
    keys = ["username", "part"] if by_part else ["username"]
    pairs = edges.groupBy(*keys, "repo").agg(F.count(F.lit(1)).alias("n"))
    return segments(pairs, keys, ["repo"], F.struct("repo", "n"), size)


def user_repo_distinct(edges: DataFrame, across_parts: bool = False) -> DataFrame:
    """Distinct ``(username, repo, part)`` rows (``across_parts``: distinct ``(username, repo)``)."""
    cols = ["username", "repo"] if across_parts else ["username", "repo", "part"]
    return edges.select(*cols).distinct()


def user_repo_times(edges: DataFrame, types=PROTOTYPE_TYPES) -> DataFrame:
    """``(username, repo, latest)``: the latest activity time per user and repository.

    The reference kept whichever (repo, time) pair came last after a shuffle;
    we make it the latest time. Aggregating first also rules out duplicate map keys.
    """
    df = edges if types is None else edges.filter(F.col("type").isin(list(types)))
    return df.groupBy("username", "repo").agg(F.max("ts").alias("latest"))


def user_repo_map(edges: DataFrame, types=PROTOTYPE_TYPES) -> DataFrame:
    """``(username, repos MAP<repo, latest>)`` built from :func:`user_repo_times`."""
    t = user_repo_times(edges, types)
    return (t.groupBy("username")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("repo", "latest")))).alias("repos")))
