"""Ego graph: order, duplicates, absent keys, per-part repeats, statuses, JSON, skew."""

import json

from pyspark.sql import types as T

from egoline.operators import graph as G
from egoline.operators.edges import parts_for_label
from egoline.operators.skew import hot_keys, skew_join

FOLLOW = T.StructType([T.StructField("username", T.StringType()), T.StructField("pos", T.LongType()),
                       T.StructField("followee", T.StringType())])
EDGE = T.StructType([T.StructField("username", T.StringType()), T.StructField("repo", T.StringType()),
                     T.StructField("part", T.StringType())])


def _fixture(spark):
    follows = spark.createDataFrame([
        ("u", 0, "b"), ("u", 1, "a"), ("u", 2, "z"), ("u", 3, "a"),   # stored order, repeat, no repos
        ("n", None, None),                                          # follows no one
    ], FOLLOW)
    edges = spark.createDataFrame([
        ("a", "o/r2", "2014_1"), ("a", "o/r1", "2014_1"), ("a", "o/r1", "2014_1"),
        ("a", "o/r1", "2014_2"), ("b", "o/r3", "2013"), ("b", "o/r4", "2014_2"),
    ], EDGE)
    return follows, edges


def test_ego_long_and_json(spark):
    follows, edges = _fixture(spark)
    long = G.ego_graph(follows, edges, label="2014")
    rows = sorted((r.pos, r.followee, r.repo or "", r.part or "") for r in long.collect())
    assert rows == [(0, "b", "o/r4", "2014_2"),
                    (1, "a", "o/r1", "2014_1"), (1, "a", "o/r1", "2014_2"), (1, "a", "o/r2", "2014_1"),
                    (2, "z", "", ""),
                    (3, "a", "o/r1", "2014_1"), (3, "a", "o/r1", "2014_2"), (3, "a", "o/r2", "2014_1")]
    seeds = spark.createDataFrame([("u",), ("n",), ("x",)], "username string")
    out = {r.username: json.loads(r.json) for r in G.ego_json(follows, edges, seeds=seeds, label="2014").collect()}
    assert out["u"] == {"username": "u", "following": [
        {"username": "b", "repositories": ["o/r4"]},
        {"username": "a", "repositories": ["o/r1", "o/r1", "o/r2"]},
        {"username": "z"},
        {"username": "a", "repositories": ["o/r1", "o/r1", "o/r2"]}]}
    assert out["n"] == {"Response": "n is not following anyone"}
    assert out["x"] == {"Response": "Records for x were not found"}


def test_distinct_across_parts(spark):
    follows, edges = _fixture(spark)
    long = G.ego_graph(follows, edges, label="All", distinct_across=True)
    a = sorted(r.repo for r in long.filter("pos = 1").collect())
    assert a == ["o/r1", "o/r2"]


def test_tree_form_and_stats(spark):
    follows, edges = _fixture(spark)
    tree = json.loads(G.ego_json(follows, edges, label="2013", form="tree").first().json)
    assert tree["name"] == "u"
    assert tree["children"][0] == {"name": "b", "children": [{"name": "o/r3", "size": 10000}]}
    assert tree["children"][1] == {"name": "a"}
    st = G.tree_stats(follows, edges, label="2013").first()
    assert (st.total_nodes, st.level1, st.level2, st.max_label_length) == (6, 4, 1, 4)


def test_seed_subset_and_missing(spark):
    follows, edges = _fixture(spark)
    seeds = spark.createDataFrame([("n",), ("x",)], "username string")
    assert G.ego_graph(follows, edges, seeds=seeds, label="2013").count() == 0
    assert sorted(r.username for r in G.missing_users(seeds, follows).collect()) == ["x"]


def test_unknown_label(spark):
    import pytest
    with pytest.raises(ValueError):
        parts_for_label("1999")


def test_skew_join_equals_plain_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "id long, k string")
    right = spark.createDataFrame([("hot", j) for j in range(5)] + [("k3", 9)], "k string, v long")
    salted = skew_join(left, right, "k", "left", hot_keys(left, "k", 5), buckets=4)
    plain = left.join(right, "k", "left")
    cols = ["id", "k", "v"]
    assert sorted(salted.select(cols).collect()) == sorted(plain.select(cols).collect())


def test_siblings_case_insensitive(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "A"), ("p", "a"), ("p", "C")], "parent string, name string")
    assert G.siblings_sorted(df, "parent", "name").first().children == ["A", "a", "b", "C"]


def test_ego_graph_salted_equals_plain(spark):
    follows, edges = _fixture(spark)
    cols = ["seed", "pos", "followee", "repo", "part"]
    salted = G.ego_graph(follows, edges, label="All", hot=edges.selectExpr("username AS followee"))
    plain = G.ego_graph(follows, edges, label="All")
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(salted.select(cols).collect(), key=key) == sorted(plain.select(cols).collect(), key=key)
    assert "_salt" in salted._jdf.queryExecution().executedPlan().toString()


def test_skew_join_with_given_hot_keys(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(20)], "id long, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k4", 3)], "k string, v long")
    hot = spark.createDataFrame([("hot",)], "k string")
    salted = skew_join(left, right, "k", "inner", buckets=3, hot=hot)
    plain = left.join(right, "k", "inner")
    assert sorted(salted.select("id", "k", "v").collect()) == sorted(plain.select("id", "k", "v").collect())


def test_skew_join_with_a_map_column(spark):
    left = spark.createDataFrame([(i, f"k{i % 4}", {"x": i}) for i in range(40)], "id long, k string, m map<string,long>")
    right = spark.createDataFrame([(f"k{j}", j) for j in range(4)], "k string, v long")
    hot = spark.createDataFrame([(f"k{j}",) for j in range(4)], "k string")
    salted = skew_join(left, right, "k", "left", buckets=3, hot=hot)
    plain = left.join(right, "k", "left")
    assert sorted(salted.select("id", "k", "v").collect()) == sorted(plain.select("id", "k", "v").collect())


def test_status_of_every_stored_user(spark):
    follows, _ = _fixture(spark)
    got = {r.username: (r.status, r.n_following) for r in G.ego_status(None, follows).collect()}
    assert got == {"u": ("ok", 4), "n": ("not_following", 0)}


def test_stored_list_of_one_null_login_is_a_list(spark):
    follows = spark.createDataFrame([("u", 0, None)], FOLLOW)
    seeds = spark.createDataFrame([("u",)], "username string")
    _, edges = _fixture(spark)
    assert G.ego_status(seeds, follows).first().status == "ok"
    assert json.loads(G.ego_json(follows, edges, seeds=seeds, label="2014").first().json) == {"username": "u", "following": []}


def test_part_counts_agree_with_the_long_form(spark):
    follows, edges = _fixture(spark)
    counts = sorted((r.pos, r.followee, r.repo or "", r.n_parts) for r in G.ego_part_counts(follows, edges, label="2014").collect())
    long = G.ego_graph(follows, edges, label="2014").groupBy("pos", "followee", "repo").agg({"part": "count"}).collect()
    assert counts == sorted((r[0], r[1], r[2] or "", r[3]) for r in long)


def test_building_an_answer_runs_no_job_and_reads_follows_once(spark, tmp_path):
    follows, edges = _fixture(spark)
    follows.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    plan = G.ego_json(stored, edges, seeds=edges.select("username"), label="2014")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [username") == 1
