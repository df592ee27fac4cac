"""The registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads whole driver tables through :mod:`egoline.plans.bindings`
and runs library operators on them. Compared outputs avoid array and map
columns (lists become joined strings, maps long form) and counts are BIGINT,
so the SQL oracle in :mod:`egoline.plans.oracle` can produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from egoline import schemas
from egoline.functions import columns as C
from egoline.functions.constants import ACTIVITY_TYPES, PROTOTYPE_TYPES
from egoline.operators import edges as E
from egoline.operators import follows as FL
from egoline.operators import graph as G
from egoline.operators import lookup as L
from egoline.operators import pages as PG
from egoline.operators import trends as TR
from egoline.operators.normalize import keep_types, normalize
from egoline.plans import bindings as B
from egoline.plans import jobs, serving
from egoline.session import shared_path
from egoline.sources import readers as R
from egoline.sources import sinks as K
from egoline.sources.keyed import upsert_table
from egoline.sources.snapshots import commit
from egoline.streaming import land_topics, topic_stream

LINK_PATTERN = r'<a href="(/[^"]*)">([^<]*)</a>'


def _ts_str(c):
    """An instant rendered as its UTC wall clock, whatever the session time zone
    (the timeline's times are UTC: "...Z")."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def _long(c):
    return c.cast("long")


def _joined(lst, sep=","):
    return F.when(lst.isNotNull(), F.array_join(lst, sep))


def _n(lst):
    return F.when(lst.isNotNull(), F.size(lst)).cast("long")


# --- S1, P1, P4, U1 ---------------------------------------------------------
def activity_filter(spark: SparkSession, sf: str) -> DataFrame:
    tl = keep_types(B.timeline(spark, sf, "v1"), ACTIVITY_TYPES, keep_corrupt=False)
    return tl.select("event_id", C.login_from_json("actor").alias("username"),
                     C.name_from_json("repo").alias("repo"), "type")


# --- A1, A2 -----------------------------------------------------------------
def user_repo_list(spark: SparkSession, sf: str) -> DataFrame:
    lists = E.user_repos(B.edges(spark, sf), by_part=False)
    return lists.select("username", _joined(F.col("repos")).alias("repos"), _n(F.col("repos")).alias("n_repos"))


def user_repo_segments(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2 in cells of at most eight entries."""
    seg = E.user_repo_segments(B.edges(spark, sf), by_part=False, size=8)
    return seg.select("username", "segment", F.array_join(F.transform("entries", lambda e: F.concat(e["repo"], F.lit("*"), e["n"])), ",").alias("repos"))


# --- A6 ----------------------------------------------------------------------
def user_repo_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return E.user_repo_distinct(B.edges(spark, sf))


# --- P5-P9, P12, rejects ------------------------------------------------------
def _normalized(tl: DataFrame, variant: str) -> DataFrame:
    n = normalize(tl, variant, part=F.col("part"), keep=("event_id",))
    return n.select("event_id", "username", "repo", "type", _ts_str("ts").alias("ts"), "part", "reason")


def normalize_v1(spark, sf):
    return _normalized(B.timeline(spark, sf, "v1", faults=True), "v1")


def normalize_v2(spark, sf):
    return _normalized(B.timeline(spark, sf, "v2", faults=True), "v2")


def normalize_v3(spark, sf):
    return _normalized(B.timeline(spark, sf, "v3", faults=True), "v3")


def normalize_all_variants(spark, sf):
    """P9, U2: the three variants normalised and unioned by column name, each
    labelled with the year table it stands for."""
    from egoline.operators.normalize import union_variants
    years = {"v1": "2015", "v2": "2012", "v3": "2013"}
    frames = [normalize(B.timeline(spark, sf, v, faults=True), v, part=years[v], keep=("event_id",))
              .select("event_id", "username", "repo", "part", "reason") for v in ("v1", "v2", "v3")]
    return union_variants(frames)


def _json_lines(tl: DataFrame, variant: str) -> DataFrame:
    """The binding's timeline as raw JSON lines of the given variant."""
    if variant == "v1":
        actor = F.from_json("actor", "login string")
        repo = F.from_json("repo", "name string")
        rec = F.struct("type", actor.alias("actor"), repo.alias("repo"), "created_at", "part", "event_id")
    elif variant == "v2":
        rec = F.struct("type", "actor", F.from_json("repo", "name string").alias("repo"), "created_at",
                       "part", "event_id")
    else:
        rec = F.struct("type", "actor", F.from_json("repository", "owner string, name string").alias("repository"),
                       "created_at", "part", "event_id")
    line = F.coalesce(F.col(schemas.CORRUPT_COL), F.to_json(rec))
    return tl.select(line.alias("value"))


def _timeline_json(spark, sf, variant):
    """S1: write the faulty timeline as JSON lines to the shared folder, read it
    back with the one explicit schema, normalise."""
    path = shared_path(spark, "timeline", variant)
    _json_lines(B.timeline(spark, sf, variant, faults=True), variant).write.mode("overwrite") \
        .option("compression", "gzip").text(path)
    read_schema = T.StructType(list(schemas.TIMELINE_READ.fields)).add("part", "string").add("event_id", "long")
    tl = R.read_timeline(spark, path, schema=read_schema)
    n = normalize(tl, variant, part=F.col("part"), keep=("event_id",))
    # a corrupt line keeps only its raw text: recover its id and part from it
    eid = F.coalesce(F.col("event_id"), F.regexp_extract("raw", r"(\d+)$", 1).cast("long"))
    return n.select(eid.alias("event_id"), "username", "repo", "type", _ts_str("ts").alias("ts"), "part", "reason")


def timeline_json_v1(spark, sf):
    return _timeline_json(spark, sf, "v1")


def timeline_json_v2(spark, sf):
    return _timeline_json(spark, sf, "v2")


def timeline_json_v3(spark, sf):
    return _timeline_json(spark, sf, "v3")


# --- S2, P2, A3, T1, T2, N3 ---------------------------------------------------
def weekly_trends(spark, sf):
    return TR.weekly_trends(B.edges(spark, sf))


def top10_weekly(spark, sf):
    return TR.top_repos(TR.weekly_trends(B.edges(spark, sf)))


def trending_json(spark, sf):
    return TR.trending_json(TR.top_repos(TR.weekly_trends(B.edges(spark, sf))))


def weekly_trends_by_day(spark, sf):
    """S2, A3: the week from stored day counts. Two batches are added; the second
    holds late events, which change the counts of their days only. Raw edges are read
    for the first and last day of the window."""
    root = shared_path(spark, "edges-by-day")
    for late in (False, True):
        jobs.add_events_job(spark, B.normalized_events(spark, sf, late), root, batch=f"late={late}", buckets=8)
    return jobs.weekly_trends(spark, root)


# --- A4, P3, P12 -------------------------------------------------------------
def repo_latest_map(spark, sf):
    e = B.edges(spark, sf, types=PROTOTYPE_TYPES)
    t = E.user_repo_times(e)
    return t.select("username", "repo", _ts_str("latest").alias("latest"))


def repo_map(spark, sf):
    """A4: the map itself, its entries written out in order of repository."""
    m = E.user_repo_map(B.edges(spark, sf, types=PROTOTYPE_TYPES))
    entries = F.array_sort(F.map_entries("repos"))
    return m.select("username", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), _ts_str(e["value"]))), ",").alias("repos"))


# --- S7: the trending answer from the stored table ---------------------------------
def trending_stored(spark, sf):
    path = shared_path(spark, "top10")
    commit(TR.top_repos(TR.weekly_trends(B.edges(spark, sf))), path)
    return TR.trending_json(R.read_table(spark, path))


# --- S4: a user list as gzip lines, cut by id ---------------------------------------
def user_list_gzip(spark, sf):
    path = shared_path(spark, "users-gz")
    B.user_records(spark, sf).write.option("compression", "gzip").json(path)
    return L.user_ids(R.read_user_dumps(spark, path, prefix="part", array_files=False), lo=30, hi=900)


def user_dumps_range(spark, sf):
    """S5, S6: numbered files of one JSON array each, those of a range of numbers, in splits."""
    path = shared_path(spark, "user-dumps")
    B.write_user_dumps(spark, sf, path)
    users = R.read_user_dumps(spark, path, lo=B.FIRST_DUMP + 1, hi=B.FIRST_DUMP + 2, split=True)
    return users.select(F.col("login").alias("username"), F.col("id").alias("userid"), "file_no")


# --- A5, P13 ------------------------------------------------------------------
def invert_follows(spark, sf):
    inv = FL.invert(B.follower_records(spark, sf), key="login", list_col="following", strip=1)
    return inv.select("username", _joined(F.col("following")).alias("following"),
                      _n(F.col("following")).alias("n_following"))


def invert_segments(spark, sf):
    """A5 in cells of at most five entries."""
    seg = FL.invert_segments(B.follower_records(spark, sf), size=5)
    return seg.select("username", "segment", F.array_join(F.transform("entries", lambda e: F.concat(e["follower"], F.lit("*"), e["n"])), ",").alias("followers"))


# --- P14, P15 -----------------------------------------------------------------
def _parsed(df):
    srt = F.array_sort("following")
    return df.select("record_id", "username", _joined(srt).alias("following"),
                     _n(F.col("following")).alias("n_following"), "status")


def follow_parse_f1(spark, sf):
    return _parsed(FL.parse_follows_json(B.follow_records(spark, sf, "f1"), keep=("record_id",)))


def follow_parse_f2(spark, sf):
    return _parsed(FL.parse_follows_struct(B.follow_records(spark, sf, "f2"), keep=("record_id",)))


def follow_parse_fetched(spark, sf):
    """Fetch-on-miss parsing: the prefix before the first bad element, in list order."""
    df = FL.parse_follows_fetched(B.fetched_follow_records(spark, sf), keep=("record_id",))
    return df.select("record_id", "username", F.array_join("following", ",").alias("following"),
                     _n(F.col("following")).alias("n_following"), "status")


# --- A7, K2 -------------------------------------------------------------------
def source_precedence(spark, sf):
    m = FL.merge_prioritised(B.topic_records(spark, sf), "priority", key="username", tie="event_id")
    return m.select("username", "event_id", "topic", _joined(F.col("following")).alias("following"))


def follows_pipeline(spark, sf):
    """S8, S3, P14, P15, A7, K2: three batches of follow messages, the topics of the
    highest precedence first; each is landed, read by topic, parsed and merged into
    the committed table. A later batch of a lower topic must not overwrite."""
    table = shared_path(spark, "userfollow")
    for k, topics in enumerate(B.FOLLOW_BATCHES):
        src, out, ckpt = (shared_path(spark, f"follows-{x}") for x in ("in", "landed", "ckpt"))
        B.follow_messages(spark, sf, k).write.json(src)
        land_topics(topic_stream(spark, "json", src), out, ckpt, allow=r"^following-").awaitTermination()
        jobs.follows_job(spark, out, [(f"following-{t}", "f1" if t % 2 else "f2", t) for t in topics], table)
    rows = R.read_table(spark, table)
    return rows.select("username", _joined(F.col("following")).alias("following"), "priority")


# --- J1, A6, P18, N4, U3, D10, R4 ----------------------------------------------
def ego_graph(spark, sf):
    g = G.ego_graph(B.follows(spark, sf), B.edges(spark, sf), label="2013")
    return g.select("seed", "followee", "repo", "part")


def ego_graph_multi_part(spark, sf):
    g = G.ego_part_counts(B.follows(spark, sf), B.edges(spark, sf), label="2014")
    return g.select("seed", "followee", "repo", "n_parts")


def ego_graph_all_years(spark, sf):
    g = G.ego_part_counts(B.follows(spark, sf), B.edges(spark, sf), label="All")
    return g.select("seed", "followee", "repo", "n_parts")


def ego_graph_distinct_across(spark, sf):
    g = G.ego_graph(B.follows(spark, sf), B.edges(spark, sf), label="All", distinct_across=True)
    return g.select("seed", "followee", "repo")


# --- J3, N5 -------------------------------------------------------------------
def ego_status(spark, sf):
    return G.ego_status(B.all_user_names(spark, sf), B.follows(spark, sf))


# --- N1, N2, N4, P16, P17 ---------------------------------------------------------
NAMED = ("s1", "s3", "s9999999", "c1", "n0", "nobody")


def ego_json(spark, sf):
    return G.ego_json(B.listed_follows(spark, sf), B.edges(spark, sf), seeds=B.all_user_names(spark, sf), label="2013")


def ego_tree_json(spark, sf):
    return G.ego_json(B.listed_follows(spark, sf), B.edges(spark, sf), label="2013", form="tree")


def ego_json_named(spark, sf):
    """P17: a few named users, as one request of the serving path asks for them, from
    tables dealt into buckets by user: only the buckets of the names and of the users
    they follow are opened."""
    follows, edges = shared_path(spark, "userfollow"), shared_path(spark, "edges")
    upsert_table(spark, follows, B.listed_follows(spark, sf), "username", buckets=8)
    jobs.add_events_job(spark, B.normalized_events(spark, sf), edges, batch="all", buckets=8)
    return serving.ego_answers(spark, follows, edges, NAMED, label="2014")


# --- R3 -------------------------------------------------------------------------
def tree_stats(spark, sf):
    s = G.tree_stats(B.follows(spark, sf), B.edges(spark, sf), label="All")
    return s.select("username", _long(F.col("total_nodes")).alias("total_nodes"),
                    _long(F.col("max_label_length")).alias("max_label_length"),
                    _long(F.col("level1")).alias("level1"), _long(F.col("level2")).alias("level2"))


# --- T3 -------------------------------------------------------------------------
def siblings_sorted(spark, sf):
    p = B.table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    s = G.siblings_sorted(p.select(F.col("p_brand").alias("parent"), name.alias("name")), "parent", "name")
    return s.select("parent", _joined(F.col("children"), "|").alias("children"),
                    _n(F.col("children")).alias("n_children"))


def siblings_ranked(spark, sf):
    p = B.table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return G.siblings_ranked(p.select(F.col("p_brand").alias("parent"), name.alias("name")), "parent", "name")


# --- J2, P10, J4, P11 -------------------------------------------------------------
def _requests(spark, sf):
    ev = B.table(spark, sf, "events").select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("username"))
    sup = B.table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("username"))
    return ev.unionByName(sup).distinct()


def userid_lookup(spark, sf):
    return L.lookup_ids(_requests(spark, sf), L.user_ids(B.user_records(spark, sf)))


def missing_users(spark, sf):
    return G.missing_users(B.all_user_names(spark, sf), B.follows(spark, sf))


def id_range(spark, sf):
    return L.user_ids(B.user_records(spark, sf), lo=200, hi=800)


# --- K1-K3 ------------------------------------------------------------------------
def upsert_snapshot(spark, sf):
    c = B.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    key = F.col("c_custkey")
    existing = c.filter((key % 2 == 0) | (key < 500))
    new = c.filter((key % 2 == 1) | (key < 500)).withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0))
    return K.upsert(existing, new, "c_custkey")


def upsert_buckets(spark, sf):
    """K2 on a stored table: the second batch rewrites the buckets that it touches and commits them."""
    root = shared_path(spark, "customers")
    c = B.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    key = F.col("c_custkey")
    upsert_table(spark, root, c.filter((key % 2 == 0) | (key < 500)), "c_custkey", buckets=16)
    upsert_table(spark, root, c.filter((key % 2 == 1) | (key < 500)).withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0)), "c_custkey")
    return R.read_table(spark, root).select("c_custkey", "c_name", "c_acctbal")


# --- R1, R2 -----------------------------------------------------------------------
def page_stitch(spark, sf):
    st = PG.stitch_pages(B.pages_table(spark, sf), fetched="fetched", keep=("id",))
    return st.select(F.col("login").alias("username"), "id", F.array_join("following", ",").alias("following"),
                     _long(F.col("n_following")).alias("n_following"))


def page_stitch_long(spark, sf):
    """R1 in long form: no user's pages are gathered."""
    st = PG.stitch_pages_long(B.pages_table(spark, sf), fetched="fetched")
    return st.select(F.col("login").alias("username"), "pos", "followee")


def extract_links(spark, sf):
    links = PG.extract_links(B.table(spark, sf, "pages"), LINK_PATTERN, key="page_id")
    return links.select("page_id", _long(F.col("pos")).alias("pos"), "slug", "text")


def follow_links_html(spark, sf):
    """R2 by the class rule, over six kinds of markup."""
    links = PG.extract_follow_links(B.marked_pages(spark, sf), key="page_id")
    return links.select("page_id", _long(F.col("pos")).alias("pos"), "slug", "text")


def follow_links_markup(spark, sf):
    """R2 by the tokenizer, over six kinds of harder markup."""
    links = PG.extract_follow_links(B.hard_pages(spark, sf), key="page_id")
    return links.select("page_id", _long(F.col("pos")).alias("pos"), "slug", "text")


def follow_pages_html(spark, sf):
    """R2 + R1: links of stored pages become page responses, then stitched."""
    pg = B.html_follow_pages(spark, sf)
    st = PG.follow_pages_from_html(pg, LINK_PATTERN)
    return st.select(F.col("login").alias("username"), F.array_join("following", ",").alias("following"),
                     _long(F.col("n_following")).alias("n_following"))


# --- K1, U3, P18: partitioned edge table, label read prunes folders ------------------
def edge_table_label(spark, sf):
    path = shared_path(spark, "edges")
    K.write_edges(B.edges(spark, sf), path)
    e = R.read_edges(spark, path, label="2014")
    return e.select("username", "repo", "type", _ts_str("ts").alias("ts"), "part")


# --- K3: reject report ------------------------------------------------------------------
def rejects_summary(spark, sf):
    from egoline.operators.normalize import edges_and_rejects
    _, rej = edges_and_rejects(B.timeline(spark, sf, "v1", faults=True), "v1", part=F.col("part"),
                               keep=("event_id",))
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


# --- S8, S3, K4, K5 ---------------------------------------------------------------
def land_topics_q(spark, sf):
    """Write events as topic messages, land them incrementally (second run adds
    nothing), read the landed hour folders back."""
    src = shared_path(spark, "topics-in")
    out = shared_path(spark, "topics-landed")
    ckpt = shared_path(spark, "topics-ckpt")
    K.write_messages(B.topic_messages(spark, sf), fmt="json", path=src)
    for _ in range(2):
        q = land_topics(topic_stream(spark, "json", src), out, ckpt, allow=r"^events-", deny=("events-error",))
        q.awaitTermination()
    landed = R.read_topic(spark, out)
    return landed.select("topic", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
                         _long(F.col("year")).alias("year"), _long(F.col("month")).alias("month"),
                         _long(F.col("day")).alias("day"), _long(F.col("hour")).alias("hour"))


QUERIES = {
    "activity_filter": activity_filter,
    "user_repo_list": user_repo_list,
    "user_repo_segments": user_repo_segments,
    "invert_segments": invert_segments,
    "siblings_ranked": siblings_ranked,
    "page_stitch_long": page_stitch_long,
    "user_repo_distinct": user_repo_distinct,
    "normalize_v1": normalize_v1,
    "normalize_v2": normalize_v2,
    "normalize_v3": normalize_v3,
    "normalize_all_variants": normalize_all_variants,
    "timeline_json_v1": timeline_json_v1,
    "timeline_json_v2": timeline_json_v2,
    "timeline_json_v3": timeline_json_v3,
    "weekly_trends": weekly_trends,
    "weekly_trends_by_day": weekly_trends_by_day,
    "top10_weekly": top10_weekly,
    "trending_json": trending_json,
    "repo_latest_map": repo_latest_map,
    "repo_map": repo_map,
    "trending_stored": trending_stored,
    "user_list_gzip": user_list_gzip,
    "follows_pipeline": follows_pipeline,
    "follow_links_html": follow_links_html,
    "follow_links_markup": follow_links_markup,
    "user_dumps_range": user_dumps_range,
    "ego_json_named": ego_json_named,
    "invert_follows": invert_follows,
    "follow_parse_f1": follow_parse_f1,
    "follow_parse_f2": follow_parse_f2,
    "follow_parse_fetched": follow_parse_fetched,
    "source_precedence": source_precedence,
    "ego_graph": ego_graph,
    "ego_graph_multi_part": ego_graph_multi_part,
    "ego_graph_all_years": ego_graph_all_years,
    "ego_graph_distinct_across": ego_graph_distinct_across,
    "ego_status": ego_status,
    "ego_json": ego_json,
    "ego_tree_json": ego_tree_json,
    "tree_stats": tree_stats,
    "siblings_sorted": siblings_sorted,
    "userid_lookup": userid_lookup,
    "missing_users": missing_users,
    "id_range": id_range,
    "upsert_snapshot": upsert_snapshot,
    "upsert_buckets": upsert_buckets,
    "page_stitch": page_stitch,
    "extract_links": extract_links,
    "follow_pages_html": follow_pages_html,
    "edge_table_label": edge_table_label,
    "rejects_summary": rejects_summary,
    "land_topics": land_topics_q,
}
