"""Batch jobs that build the keyed tables, one per reference batch script.

The serving queries read these tables instead of recomputing from raw input.

    yearly_edges_job   timeline files of one year  -> the year's edges, rejects and derived tables
    add_events_job     a later batch of events     -> the same tables, touched folders only
    follows_job        landed follow topics        -> userfollow (merged by precedence)
    user_ids_job       landed user topic / dumps   -> getuserid (keyed upsert)
    trends_job         day counts                  -> weekly trends + top 10

All of them commit (``sources.snapshots``): a job that fails changes nothing, and
of two jobs that change the same version one fails or is done again.

The edge jobs keep four tables under one root and commit them together:

    edges        by part and UTC day     every normalised edge
    user_repos   by part and bucket      distinct (username, repo), for lookups by user
    day_counts   by part and UTC day     counts per type and repository, which add up
    rejects      by part                 rows that could not be normalised, with the reason
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from egoline import schemas
from egoline.functions.constants import ACTIVITY_TYPES, TOP_K
from egoline.operators import follows as FL
from egoline.operators import lookup as L
from egoline.operators import trends as TR
from egoline.operators.normalize import normalize
from egoline.session import shared_path
from egoline.sources import readers as R
from egoline.sources import sinks as K
from egoline.sources.keyed import BUCKET, BUCKETS, bucket_of, upsert_table
from egoline.sources.snapshots import Conflict, Version, commit, current, key_values, publish, read_version, stage

EDGES, USER_REPOS, DAY_COUNTS, REJECTS = "edges", "user_repos", "day_counts", "rejects"
LAYOUT = {EDGES: ("part", "day"), USER_REPOS: ("part", BUCKET), DAY_COUNTS: ("part", "day"), REJECTS: ("part",)}


def _tables(rows: DataFrame, buckets: int) -> dict[str, DataFrame]:
    """The four tables of normalised rows (edges and rejects in one frame)."""
    edges = rows.filter("reason is null").select(*schemas.EDGE.names).withColumn("day", TR.day_of("ts"))
    return {EDGES: edges, USER_REPOS: edges.select("username", "repo", "part", bucket_of("username", buckets).alias(BUCKET)).distinct(),
            DAY_COUNTS: TR.day_counts(edges.filter("ts is not null")), REJECTS: rows.filter("reason is not null").select("reason", "raw", "part")}


def _stage(df: DataFrame, root: str, name: str, buckets: int):
    sort = ("username",) if name == USER_REPOS else ()
    return stage(df, root, name, LAYOUT[name], sort, buckets if name == USER_REPOS else None)


def _buckets(base: Version | None, buckets: int) -> int:
    """A table keeps the number of buckets that it was created with."""
    return base.tables[USER_REPOS]["buckets"] if base and USER_REPOS in base.tables else buckets


def yearly_edges_job(spark: SparkSession, src, variant: str, part: str, root: str, types=ACTIVITY_TYPES,
                     repartition: int | None = None, on_reject: str = "skip", buckets: int = BUCKETS) -> Version:
    """Normalise one year's timeline files and make them that part's content.

    The source is read once into a staged table. The part's folders of all four
    tables are replaced in one commit, whether they hold a row or not, so a
    re-run on corrected input leaves no stale reject and a job killed half-way
    changes nothing. Other parts stay untouched. ``on_reject="fail"`` stops the
    job before the commit when any row was rejected.
    """
    staged = shared_path(spark, "staged-edges")
    normalize(R.read_timeline(spark, src, repartition=repartition), variant, part, types).write.parquet(staged)
    return put_part(spark, spark.read.parquet(staged), part, root, on_reject, buckets)


def put_part(spark: SparkSession, rows: DataFrame, part: str, root: str, on_reject: str = "skip", buckets: int = BUCKETS) -> Version:
    """Normalised rows (edges, and rejects with a reason) become the content of ``part``."""
    base = current(spark, root)
    K.enforce_rejects(rows.filter("reason is not null"), on_reject)
    rows = rows.withColumn("part", F.lit(part))
    buckets = _buckets(base, buckets)
    files = {name: _stage(df, root, name, buckets) for name, df in _tables(rows, buckets).items()}
    return publish(spark, root, base, files, lambda _, key: key_values(key)["part"] == part)


def add_events_job(spark: SparkSession, rows: DataFrame, root: str, batch: str, retries: int = 3, buckets: int = BUCKETS) -> Version:
    """Add a batch of normalised rows (late ones too) to the tables.

    Edges and rejects are added as further files; day counts and user
    repositories are merged with the stored rows of the touched days and buckets
    only. ``batch`` names the batch: one that was committed before is not added
    again. When another writer commits first, the merge is done again.
    """
    staged = shared_path(spark, "staged-events")  # normalised once, however many tables and attempts read it
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    for attempt in range(retries + 1):
        base = current(spark, root)
        if base is not None and batch in base.batches:
            return base
        files, touched, n = {}, {}, _buckets(base, buckets)
        for name, df in _tables(rows, n).items():
            if name in (USER_REPOS, DAY_COUNTS):
                by = LAYOUT[name]
                keys = df.select(*[F.col(c).cast("string").alias(c) for c in by]).distinct().collect()  # folders, bounded by the layout
                touched[name] = {"/".join(f"{c}={v}" for c, v in zip(by, k)) for k in keys}
                old = read_version(spark, root, base, name, {c: sorted({k[i] for k in keys if k[i] is not None}) for i, c in enumerate(by)}) if base else None
                if old is not None:
                    # parts and days are told apart by column here; folders that only fit crosswise stay as they are
                    here = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in by])
                    old = old.filter(here.isin(*touched[name])) if touched[name] else old.limit(0)
                    df = TR.merge_day_counts(old, df) if name == DAY_COUNTS else old.unionByName(df).distinct()
            files[name] = _stage(df, root, name, n)
        try:
            return publish(spark, root, base, files, lambda name, key: key in touched.get(name, ()), batch)
        except Conflict:
            if attempt == retries:
                raise


def newest_lists(lists: DataFrame, key: str = "username") -> DataFrame:
    """One list per user: of the highest priority, then the latest time, then the greatest text."""
    told = lists.withColumn("_text", F.to_json(F.struct("following")))
    return FL.merge_prioritised(told, "priority", key=key, tie=("timestamp", "_text")).select(key, "following", "priority", "timestamp")


def merge_follows(old: DataFrame, new: DataFrame, key: str = "username") -> DataFrame:
    """Stored and new lists by precedence. A maximum, so batches in any order give
    the same table. Stored lists without a priority (plain tables) give way to any other."""
    if "priority" not in old.columns:
        old = old.select(key, "following", F.lit(None).cast("int").alias("priority"), F.lit(None).cast("timestamp").alias("timestamp"))
    return newest_lists(old.unionByName(new), key)


def follows_job(spark: SparkSession, topic_root: str, topics, userfollow_path: str) -> Version:
    """Parse follow records of several landed topics and merge them into the table.

    ``topics``: ``[(topic, variant), ...]`` in precedence order (later wins, as
    in the reference's insertion order), or ``(topic, variant, priority)`` where
    jobs read different topics; ``variant`` is ``"f1"`` (JSON texts) or ``"f2"``
    (structs). Priority and time are stored with each list, so a later batch of a
    lower topic does not overwrite a higher one. Within one topic the newest
    message wins, of equally new ones the list of the greatest text.
    """
    frames = []
    for place, (topic, variant, *given) in enumerate(topics):
        schema = schemas.FOLLOW_F1 if variant == "f1" else schemas.FOLLOW_F2
        msgs = R.read_topic(spark, topic_root, topic=topic, schema=schema)
        parse = FL.parse_follows_json if variant == "f1" else FL.parse_follows_struct
        parsed = parse(msgs, keep=("timestamp",)).select("username", "following", F.lit(given[0] if given else place).alias("priority"), "timestamp")
        frames.append(parsed)
    new = frames[0]
    for f in frames[1:]:
        new = new.unionByName(f)
    merged = shared_path(spark, "userfollow-batch")  # read once per attempt of the commit
    newest_lists(new).write.parquet(merged)
    return upsert_table(spark, userfollow_path, spark.read.parquet(merged), "username", merge=merge_follows)


def user_ids_job(spark: SparkSession, users: DataFrame, getuserid_path: str, lo=None, hi=None) -> Version:
    """Project ``(username, userid)`` from wide user records (a landed topic
    parsed with ``schemas.USER`` or :func:`read_user_dumps`), one row per name
    (highest id wins on repeats), upserted into the committed table."""
    ids = L.user_ids(users, lo=lo, hi=hi)
    batch = shared_path(spark, "userids-batch")
    ids.groupBy("username").agg(F.max("userid").alias("userid")).write.parquet(batch)
    return upsert_table(spark, getuserid_path, spark.read.parquet(batch), "username")


def bucket_graph_tables(spark: SparkSession, follows: DataFrame, edges: DataFrame, label: str | None = None,
                        buckets: int = 512, follows_table: str = "ego_follows",
                        lists_table: str = "ego_followee_repos", distinct_across: bool = False) -> None:
    """Write the two sides of the ego-graph join as tables bucketed and sorted by
    ``followee`` (same bucket count), so every later all-users ego query joins
    them bucket by bucket without shuffling either side.

    ``follows``: long follow table ``(username, pos, followee)``; stored as
    ``(seed, pos, followee)``. ``lists_table`` holds :func:`followee_repos` of
    the label. Needs a catalog that keeps tables (a metastore on a cluster).
    """
    from egoline.operators import graph as G
    f = follows.filter(F.col("followee").isNotNull()).select(
        F.col("username").alias("seed"), "pos", "followee")
    (f.write.mode("overwrite").bucketBy(buckets, "followee").sortBy("followee")
     .saveAsTable(follows_table))
    (G.followee_repos(edges, label=label, distinct_across=distinct_across)
     .write.mode("overwrite").bucketBy(buckets, "followee").sortBy("followee").saveAsTable(lists_table))


def weekly_trends(spark: SparkSession, root: str, as_of: str | None = None, days: int = 7) -> DataFrame:
    """The week's counts from the stored day counts; raw edges are read for the
    window's first and last day only. ``as_of`` (a UTC time) defaults to the
    latest edge, which the counts of the last stored day tell."""
    version = current(spark, root)
    stored = [key_values(k)["day"] for k in version.tables[DAY_COUNTS]["folders"]] if version else []
    known = sorted({d for d in stored if d[:1].isdigit()})
    empty = spark.createDataFrame([], "reponame string, watchcount long")
    if not known:
        return empty
    if as_of is None:
        last = read_version(spark, root, version, DAY_COUNTS, {"day": known[-1:]}).agg(F.max(F.unix_micros("latest"))).first()[0]
    else:
        last = spark.range(1).select(F.unix_micros(F.to_timestamp(F.concat(F.lit(str(as_of).rstrip("Z")), F.lit("+00:00"))))).first()[0]
    touched = [d.isoformat() for d in TR.week_days(last, days)]
    counts = read_version(spark, root, version, DAY_COUNTS, {"day": touched[1:-1]})
    edges = read_version(spark, root, version, EDGES, {"day": [touched[0], touched[-1]]})
    return TR.weekly_trends_from_days(counts, edges, last, days)


def trends_job(spark: SparkSession, edges_path: str, trends_path: str, top_path: str,
               as_of=None, days: int = 7, k: int = TOP_K) -> None:
    """Weekly star counts and the top ``k``, each committed as the whole table
    (repositories of past weeks do not linger)."""
    if current(spark, edges_path) is None:  # plain files
        trends = TR.weekly_trends(R.read_edges(spark, edges_path), as_of=as_of, days=days)
    else:
        trends = weekly_trends(spark, edges_path, as_of, days)
    commit(trends, trends_path)
    commit(TR.top_repos(R.read_table(spark, trends_path), k), top_path)
