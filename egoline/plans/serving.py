"""Answers from the stored tables: each opens the folders of its keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from egoline.operators import follows as FL
from egoline.operators import graph as G
from egoline.operators.edges import parts_for_label
from egoline.plans.jobs import USER_REPOS
from egoline.sources import readers as R
from egoline.sources.keyed import lookup
from egoline.sources.snapshots import current


def named(spark: SparkSession, names) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("username"))


def rows_of(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """The stored rows of the keys; a plain table is read whole and cut."""
    if current(spark, root) is not None:
        return lookup(spark, root, keys, "username")
    return R.read_table(spark, root).join(keys.select(F.col(keys.columns[0]).alias("username")).distinct(), "username", "left_semi")


def ego_answers(spark: SparkSession, userfollow: str, edges: str, names, label: str, form: str = "api", routing=None) -> DataFrame:
    """``(username, json)`` for the named users, as :func:`graph.ego_json` answers them.

    The names' buckets of the follow table are read, then the buckets of the
    users that they follow, in the label's parts; other users' edges are gone
    before repositories are gathered. ``userfollow`` holds lists or long rows.
    """
    seeds = named(spark, names)
    follows = rows_of(spark, userfollow, seeds)
    if "pos" not in follows.columns:
        follows = FL.follow_edges(follows)
    parts = parts_for_label(label, routing)
    if current(spark, edges) is None:
        stored = G.followee_edges(R.read_edges(spark, edges), follows, seeds)
    else:
        followed = follows.filter("followee is not null").select("followee").distinct()
        stored = lookup(spark, edges, followed, "username", USER_REPOS, {"part": parts})
    return G.ego_json(follows, stored, seeds=seeds, parts=parts, form=form)
