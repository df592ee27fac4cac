"""Ego graph: for each seed user, the users they follow and the repositories
those users were active in (a two-hop expansion), for one seed or all seeds.

The reference answered one user per web request with one store lookup per
followed user per year table. Here it is one plan over tables:

    seeds  semi-join  follow edges (username, pos, followee)
           left-join  distinct repo edges of the chosen parts  (on followee)

The long form ``(seed, pos, followee, repo, part)`` is the canonical answer.
The JSON answers use the node form ``(seed, pos, followee, repos)`` instead:
each user's repository list is built once and joined to the edges that point at
the user, one row per edge. Tree statistics join two numbers per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.functions.constants import (
    LEAF_SIZE, MSG_NOT_FOLLOWING, MSG_NOT_FOUND, STATUS_NOT_FOLLOWING, STATUS_NOT_FOUND, STATUS_OK,
)
from egoline.operators.edges import select_parts
from egoline.operators.ordered import preceded
from egoline.operators.skew import skew_join


def _seed_names(seeds) -> DataFrame | None:
    if seeds is None:
        return None
    return seeds.select(F.col(seeds.columns[0]).alias("username")).distinct()


def ego_graph(follows: DataFrame, edges: DataFrame, seeds: DataFrame | None = None,
              label: str | None = None, parts=None, distinct_across: bool = False,
              routing=None, hot: DataFrame | None = None) -> DataFrame:
    """Long-form ego graph ``(seed, pos, followee, repo, part)``.

    ``follows``: long follow table ``(username, pos, followee)`` (null followee =
    follows no one). ``edges``: ``(username, repo, part, ...)``. ``seeds``: a
    DataFrame whose first column holds user names, or None for every user.
    Followed users without repositories keep one row with null ``repo``.
    Repositories are distinct per part (a repository active in two parts of a
    label appears twice) unless ``distinct_across``. ``hot`` may name followees
    (column ``followee``) whose rows are salted; otherwise adaptive execution
    splits skewed partitions of the join.
    """
    f = _followed(follows, seeds)
    e = select_parts(edges, label, parts, routing)
    if distinct_across:
        repos = e.select(F.col("username").alias("followee"), "repo").distinct() \
                 .withColumn("part", F.lit(None).cast("string"))
    else:
        repos = e.select(F.col("username").alias("followee"), "repo", "part").distinct()
    return skew_join(f, repos, "followee", "left", hot).select("seed", "pos", "followee", "repo", "part")


def ego_part_counts(follows: DataFrame, edges: DataFrame, seeds: DataFrame | None = None,
                    label: str | None = None, parts=None, routing=None, hot: DataFrame | None = None) -> DataFrame:
    """``(seed, pos, followee, repo, n_parts)``: in how many parts of the label the
    followed user was active in the repository (0 with a null ``repo`` for none).

    Parts are counted per user and repository before the join, so the join
    emits one row per repository and nothing is aggregated after it.
    """
    e = select_parts(edges, label, parts, routing).select(F.col("username").alias("followee"), "repo", "part").distinct()
    counts = e.groupBy("followee", "repo").agg(F.count("part").alias("n_parts"))
    j = skew_join(_followed(follows, seeds), counts, "followee", "left", hot)
    return j.select("seed", "pos", "followee", "repo", F.coalesce("n_parts", F.lit(0)).alias("n_parts"))


def _followed(follows: DataFrame, seeds) -> DataFrame:
    """``(seed, pos, followee)`` for the seeds' stored follow edges."""
    f = follows.filter(F.col("followee").isNotNull())
    s = _seed_names(seeds)
    if s is not None:
        f = f.join(s, "username", "left_semi")
    return f.select(F.col("username").alias("seed"), "pos", "followee")


def followee_edges(edges: DataFrame, follows: DataFrame, seeds: DataFrame) -> DataFrame:
    """The edges of users that the seeds follow: what a request for a few seeds passes
    on, so that other users' edges are gone before anything is aggregated. (For all
    users there is nothing to cut, so the operators here do not do it themselves.)"""
    followed = _followed(follows, seeds).select(F.col("followee").alias("username")).distinct()
    return edges.join(followed, "username", "left_semi")


def followee_repos(edges: DataFrame, label: str | None = None, parts=None, distinct_across: bool = False,
                   routing=None) -> DataFrame:
    """``(followee, repos)``: each user's repositories in the chosen parts, once
    per part (or once overall with ``distinct_across``), sorted by name.

    One shuffle: ``collect_set`` removes repeats map-side, so a user's group
    holds one entry per distinct (repository, part) pair.
    """
    e = select_parts(edges, label, parts, routing)
    item = F.struct("repo") if distinct_across else F.struct("repo", "part")
    g = e.groupBy(F.col("username").alias("followee")).agg(F.collect_set(item).alias("_s"))
    return g.select("followee", F.array_sort(F.transform("_s", lambda x: x["repo"])).alias("repos"))


def ego_nodes(follows: DataFrame, edges: DataFrame, seeds: DataFrame | None = None,
              label: str | None = None, parts=None, distinct_across: bool = False, routing=None,
              hot: DataFrame | None = None) -> DataFrame:
    """``(seed, pos, followee, repos)``: one row per stored follow edge with the
    followed user's repository list (null when none).

    Each user's list is built once and joined to every edge that points at
    the user, so the join emits one row per edge instead of one per edge and
    repository.
    """
    return join_nodes(_followed(follows, seeds), followee_repos(edges, label, parts, distinct_across, routing), hot)


def join_nodes(followed: DataFrame, lists: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """``followed(seed, pos, followee)`` left-join ``lists(followee, repos)``.

    When both inputs are tables bucketed and sorted by ``followee`` with the same
    bucket count (see ``plans.jobs.bucket_graph_tables``), the join reads matching
    buckets side by side: no shuffle on either side.
    """
    return skew_join(followed, lists, "followee", "left", hot).select("seed", "pos", "followee", "repos")


def follow_summary(follows: DataFrame) -> DataFrame:
    """``(username, n_following)`` per stored user (0 = follows no one); one
    partial aggregate, so a user with a huge list costs one row per task. A
    stored list entry without a name counts: the list is not empty."""
    return follows.groupBy("username").agg(F.count("pos").alias("n_following"))


def _answered(n_following) -> tuple:
    """Status and message of a seed by the length of its stored list (null: none stored)."""
    status = (F.when(n_following.isNull(), F.lit(STATUS_NOT_FOUND))
              .when(n_following == 0, F.lit(STATUS_NOT_FOLLOWING))
              .otherwise(F.lit(STATUS_OK)))
    message = (F.when(status == STATUS_NOT_FOUND, F.format_string(MSG_NOT_FOUND.replace("{user}", "%s"), "username"))
               .when(status == STATUS_NOT_FOLLOWING,
                     F.format_string(MSG_NOT_FOLLOWING.replace("{user}", "%s"), "username")))
    return status, message


def ego_status(seeds: DataFrame | None, follows: DataFrame) -> DataFrame:
    """``(username, status, message, n_following)`` for each seed: ``not_found``
    (no stored record), ``not_following`` (null or empty list) or ``ok``.

    The follow table is aggregated first, so only per-task partial counts are
    shuffled; a broadcast seed list filters it before that. ``seeds=None``
    reports every stored user.
    """
    j = follow_summary(follows)
    if seeds is not None:
        j = _seed_names(seeds).join(j, "username", "left")
    status, message = _answered(F.col("n_following"))
    return j.select("username", status.alias("status"), message.alias("message"), "n_following")


def missing_users(requests: DataFrame, follows: DataFrame) -> DataFrame:
    """Requested users without a stored follow record: the fetch worklist.
    Stored names are made distinct map-side before anything is shuffled."""
    return _seed_names(requests).join(follows.select("username").distinct(), "username", "left_anti")


def ego_json(follows: DataFrame, edges: DataFrame, seeds: DataFrame | None = None, label: str | None = None,
             parts=None, distinct_across: bool = False, routing=None, form: str = "api",
             hot: DataFrame | None = None) -> DataFrame:
    """The answer per seed as ``(username, json)``.

    ``form="api"``: ``{"username":u,"following":[{"username":f,"repositories":[..]}]}``;
    ``form="tree"``: ``{"name":u,"children":[{"name":f,"children":[{"name":r,"size":10000}]}]}``.
    Followed users keep their stored order (``pos``), duplicates included; the
    repositories key is absent for a followed user without repositories (null
    fields are omitted by ``to_json``). With ``seeds``, names without a stored
    record or with an empty list get ``{"Response": message}``; without, every
    stored user that follows someone is answered.

    The follow table is read once: joined to the repository lists, reduced to
    one row per stored user, and that row carries both the tree and the status.
    An answer is one document, so a seed's tree is one value by its nature.
    """
    if form not in ("api", "tree"):
        raise ValueError("form must be 'api' or 'tree'")
    f = follows if seeds is None else follows.join(_seed_names(seeds), "username", "left_semi")
    nodes = skew_join(f, followee_repos(edges, label, parts, distinct_across, routing), "followee", "left", hot)
    if form == "api":
        node = F.struct(F.col("pos"), F.col("followee").alias("username"), F.col("repos").alias("repositories"))
    else:
        leaves = F.transform("repos", lambda r: F.struct(r.alias("name"), F.lit(LEAF_SIZE).alias("size")))
        node = F.struct(F.col("pos"), F.col("followee").alias("name"), leaves.alias("children"))
    trees = nodes.groupBy("username").agg(
        F.array_sort(F.collect_list(F.when(F.col("followee").isNotNull(), node))).alias("kids"),
        F.count("pos").alias("n_following"))
    kids = F.transform("kids", lambda k: k.dropFields("pos"))
    if form == "api":
        doc = F.struct(F.col("username"), kids.alias("following"))
    else:
        doc = F.struct(F.col("username").alias("name"), kids.alias("children"))
    if seeds is None:
        return trees.filter("n_following > 0").select("username", F.to_json(doc).alias("json"))
    answers = _seed_names(seeds).join(trees, "username", "left")
    status, message = _answered(F.col("n_following"))
    return answers.select("username", F.when(status == STATUS_OK, F.to_json(doc)).otherwise(
        F.to_json(F.struct(message.alias("Response")))).alias("json"))


def tree_stats(follows: DataFrame, edges: DataFrame, seeds: DataFrame | None = None, label: str | None = None,
               parts=None, routing=None) -> DataFrame:
    """Layout statistics per seed tree: ``total_nodes`` (root + followed users +
    repository leaves), ``max_label_length`` over all node names, and the node
    count per level (``level1``: followed users, ``level2``: leaves).

    Two numbers per followed user are joined, not lists; the seeds' sums are
    combined map-side.
    """
    e = select_parts(edges, label, parts, routing).select(F.col("username").alias("followee"), "repo", "part").distinct()
    sizes = e.groupBy("followee").agg(F.count(F.lit(1)).alias("leaves"), F.max(F.length("repo")).alias("longest"))
    nodes = _followed(follows, seeds).join(sizes, "followee", "left")
    agg = nodes.groupBy("seed").agg(
        F.count(F.lit(1)).alias("level1"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("level2"),
        F.max(F.greatest(F.length("followee"), F.coalesce("longest", F.lit(0)))).alias("child_len"))
    return agg.select(
        F.col("seed").alias("username"),
        (F.lit(1) + F.col("level1") + F.col("level2")).alias("total_nodes"),
        F.greatest(F.length("seed"), F.col("child_len")).alias("max_label_length"),
        "level1", "level2")


def siblings_ranked(df: DataFrame, parent: str, name: str) -> DataFrame:
    """``(parent, name, n, first)``: each distinct child name with its count and the
    1-based place of its first occurrence in the tree's display order
    (case-insensitive, exact name as the tie-break). Repeats are counted map-side;
    places come from a range sort, so a hot parent's names lie over many tasks."""
    pairs = df.groupBy(F.col(parent).alias("parent"), F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    placed = preceded(pairs.withColumn("lower", F.lower("name")), ["parent"], ["lower", "name"], "n")
    return placed.select("parent", "name", "n", (F.col("before") + 1).alias("first"))


def siblings_sorted(df: DataFrame, parent: str, name: str) -> DataFrame:
    """``(parent, children)``: the ranked names as one list per parent, repeats written out."""
    arr = F.array_sort(F.collect_list(F.struct("first", "name", "n")))
    kids = F.flatten(F.transform(arr, lambda x: F.array_repeat(x["name"], x["n"].cast("int"))))
    return siblings_ranked(df, parent, name).groupBy(F.col("parent").alias(parent)).agg(kids.alias("children"))
