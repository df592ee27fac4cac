"""Batch jobs end to end on fixture files."""

import json

from pyspark.sql import functions as F

from egoline.plans import jobs
from egoline.sources import read_table
from egoline.streaming import land_topics, topic_stream
from tests.conftest import write_lines


def test_yearly_edges_job_idempotent_per_part(spark, tmp_path):
    v1 = write_lines(tmp_path / "2015" / "a.json", [
        json.dumps({"type": "WatchEvent", "actor": {"login": "a"}, "repo": {"name": "o/r1"}}),
        json.dumps({"type": "ForkEvent", "repo": {"name": "o/r2"}})])
    v3 = write_lines(tmp_path / "2013" / "a.json", [
        json.dumps({"type": "ForkEvent", "actor": "b", "repository": {"owner": "o", "name": "r2"}})])
    edges = str(tmp_path / "edges")
    jobs.yearly_edges_job(spark, v1, "v1", "2015", edges)
    jobs.yearly_edges_job(spark, v3, "v3", "2013", edges)
    jobs.yearly_edges_job(spark, v1, "v1", "2015", edges)   # re-run one year
    from egoline.sources import read_edges
    got = sorted((r.username, r.repo, r.part) for r in read_edges(spark, edges).collect())
    assert got == [("a", "o/r1", "2015"), ("b", "o/r2", "2013")]
    assert [r.reason for r in read_table(spark, edges, table="rejects").collect()] == ["null_user"]


def test_follows_job_precedence_and_upsert(spark, tmp_path):
    msgs = [
        ("scrap-following-3", {"login": "u", "following": [json.dumps({"login": "x"})]}, "2015-06-01T01:00:00Z"),
        ("scrap-following-3", {"login": "v", "following": [json.dumps({"login": "y"}), "oops"]}, "2015-06-01T01:00:00Z"),
        ("scrap-following-7", {"login": "u", "following": [{"login": "z"}]}, "2015-06-01T02:00:00Z"),
    ]
    src = tmp_path / "in"
    src.mkdir()
    (src / "m.json").write_text("\n".join(json.dumps({"topic": t, "value": json.dumps(v), "timestamp": ts})
                                          for t, v, ts in msgs) + "\n")
    root = str(tmp_path / "landed")
    land_topics(topic_stream(spark, "json", str(src)), root, str(tmp_path / "ck")).awaitTermination()
    topics = [("scrap-following-3", "f1"), ("scrap-following-7", "f2")]
    jobs.follows_job(spark, root, topics, str(tmp_path / "uf0"))
    got = {r.username: r.following for r in read_table(spark, str(tmp_path / "uf0")).collect()}
    assert got == {"u": ["z"], "v": None}
    prev = spark.createDataFrame([("w", ["q"]), ("u", ["old"])], "username string, following array<string>")
    prev.write.parquet(str(tmp_path / "uf1"))
    jobs.follows_job(spark, root, topics, str(tmp_path / "uf1"))
    got = {r.username: r.following for r in read_table(spark, str(tmp_path / "uf1")).collect()}
    assert got == {"u": ["z"], "v": None, "w": ["q"]}


def test_user_ids_and_trends_jobs(spark, tmp_path):
    users = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("b", 3, "y")], "login string, id long, extra string")
    jobs.user_ids_job(spark, users, str(tmp_path / "ids"))
    assert sorted(read_table(spark, str(tmp_path / "ids")).drop("bucket").collect()) == [("a", 1), ("b", 3)]
    e = spark.createDataFrame([("u1", "o/a", "WatchEvent", "2015"), ("u2", "o/a", "WatchEvent", "2015"),
                               ("u3", "o/b", "WatchEvent", "2015")], "username string, repo string, type string, part string") \
        .withColumn("ts", F.lit("2015-01-10 00:00:00").cast("timestamp"))
    e.write.partitionBy("part").parquet(str(tmp_path / "edges"))
    jobs.trends_job(spark, str(tmp_path / "edges"), str(tmp_path / "trends"), str(tmp_path / "top"), k=1)
    assert [tuple(r) for r in read_table(spark, str(tmp_path / "top")).collect()] == [("o/a", 2)]


def test_bucketed_graph_tables_join_without_shuffle(spark):
    from egoline.operators import graph as G
    follows = spark.createDataFrame([("u", 0, "a"), ("u", 1, "b"), ("v", 0, "a"), ("w", None, None)],
                                    "username string, pos long, followee string")
    edges = spark.createDataFrame([("a", "o/r1", "2015"), ("a", "o/r2", "2015"), ("b", "o/r3", "2013")],
                                  "username string, repo string, part string")
    jobs.bucket_graph_tables(spark, follows, edges, label="2015", buckets=4)
    prev = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in prev:
            spark.conf.set(k, "-1")  # force the sort-merge path the tables are laid out for
        nodes = G.join_nodes(spark.table("ego_follows"), spark.table("ego_followee_repos"))
        got = sorted((r.seed, r.pos, r.followee, tuple(r.repos or ())) for r in nodes.collect())
        plan = nodes._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == [("u", 0, "a", ("o/r1", "o/r2")), ("u", 1, "b", ()), ("v", 0, "a", ("o/r1", "o/r2"))]
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def _land(spark, tmp_path, name, msgs):
    src = tmp_path / f"{name}-in"
    src.mkdir()
    (src / "m.json").write_text("\n".join(json.dumps({"topic": t, "value": json.dumps(v), "timestamp": ts}) for t, v, ts in msgs) + "\n")
    root = str(tmp_path / name)
    land_topics(topic_stream(spark, "json", str(src)), root, str(tmp_path / f"{name}-ck")).awaitTermination()
    return root


def test_batches_add_up_and_ties_are_decided(spark, tmp_path):
    f = lambda *names: {"following": [{"login": n} for n in names]}
    ts = "2015-06-01T01:00:00Z"
    early = "2015-06-01T00:59:00Z"
    one = _land(spark, tmp_path, "one", [("t", {"login": "a", **f("x")}, ts), ("t", {"login": "b", **f("y")}, early)])
    two = _land(spark, tmp_path, "two", [("t", {"login": "b", **f("p")}, ts), ("t", {"login": "b", **f("q")}, ts), ("t", {"login": "c", **f("z")}, ts)])
    table = str(tmp_path / "uf")
    for root in (one, two):
        jobs.follows_job(spark, root, [("t", "f2")], table)
    got = {r.username: r.following for r in read_table(spark, table).collect()}
    assert got == {"a": ["x"], "b": ["q"], "c": ["z"]}


def test_unreadable_table_is_no_first_run(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    (tmp_path / "ids").mkdir()
    users = spark.createDataFrame([("a", 1)], "login string, id long")
    with pytest.raises(AnalysisException):
        jobs.user_ids_job(spark, users, str(tmp_path / "ids"))


def test_rerun_on_corrected_input_leaves_no_stale_reject(spark, tmp_path):
    bad = write_lines(tmp_path / "bad" / "a.json", [json.dumps({"type": "ForkEvent", "repo": {"name": "o/r2"}}),
                                                     json.dumps({"type": "WatchEvent", "actor": {"login": "b"}, "repo": {"name": "o/r2"}, "created_at": "noon"})])
    good = write_lines(tmp_path / "good" / "a.json", [json.dumps({"type": "ForkEvent", "actor": {"login": "b"}, "repo": {"name": "o/r2"}})])
    edges = str(tmp_path / "edges")
    jobs.yearly_edges_job(spark, bad, "v1", "2015", edges)
    assert sorted(r.reason for r in read_table(spark, edges, table="rejects").collect()) == ["bad_time", "null_user"]
    jobs.yearly_edges_job(spark, good, "v1", "2015", edges)
    assert read_table(spark, edges, table="rejects").count() == 0 and read_table(spark, edges, table="edges").count() == 1


def test_scratch_is_released(spark):
    import os
    from egoline.session import release_scratch, shared_path
    release_scratch(spark)
    path = shared_path(spark, "test-scratch")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    assert release_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
