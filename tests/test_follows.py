"""Follow records F1/F2, source precedence, inversion (FIXTURES.md)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from egoline import schemas
from egoline.operators import follows as FL


def _f1(spark, rows):
    return spark.createDataFrame(rows, schemas.FOLLOW_F1)


def test_f1_all_or_nothing(spark):
    df = _f1(spark, [("u1", ['{"login":"x"}', '{"login":"y"}']),
                     ("u2", ['{"login":"x"}', "oops"]),
                     ("u3", []),
                     ("u4", None)])
    got = {r.username: (r.following, r.status) for r in FL.parse_follows_json(df).collect()}
    assert got == {"u1": (["x", "y"], "ok"), "u2": (None, "not_following"),
                   "u3": ([], "not_following"), "u4": (None, "not_following")}


def test_f2_structs(spark):
    df = spark.createDataFrame([("u1", [("x",), ("y",)]), ("u2", [("x",), None]), ("u3", []), ("u4", None),
                                ("u5", [("x",), (None,)])], schemas.FOLLOW_F2)
    got = {r.username: r.following for r in FL.parse_follows_struct(df).collect()}
    assert got == {"u1": ["x", "y"], "u2": None, "u3": [], "u4": None, "u5": ["x", None]}


def test_last_writer_wins(spark):
    s = T.StructType([T.StructField("username", T.StringType()), T.StructField("following", T.ArrayType(T.StringType()))])
    t3 = spark.createDataFrame([("a", ["x"]), ("b", ["x"])], s)
    t7 = spark.createDataFrame([("a", ["y"]), ("b", None)], s)
    got = {r.username: r.following for r in FL.merge_sources([(3, t3), (7, t7)]).collect()}
    assert got == {"a": ["y"], "b": None}


def test_invert_strips_prefix(spark):
    df = spark.createDataFrame([("a", ["/b", "/c"]), ("d", ["/b"])], schemas.FOLLOW_F1)
    got = {r.username: r.following for r in FL.invert(df).collect()}
    assert got == {"b": ["a", "d"], "c": ["a"]}


def test_invert_twice_is_identity_on_edges(spark):
    rows = [("a", ["/b", "/c", "/c"]), ("d", ["/b"]), ("e", ["/a"])]
    df = spark.createDataFrame(rows, schemas.FOLLOW_F1)
    once = FL.invert(df)
    prefixed = once.selectExpr("username AS login", "transform(following, x -> concat('/', x)) AS following")
    twice = {r.username: sorted(r.following) for r in FL.invert(prefixed).collect()}
    assert twice == {"a": ["b", "c", "c"], "d": ["b"], "e": ["a"]}


def test_follow_edges_long_form(spark):
    s = T.StructType([T.StructField("username", T.StringType()), T.StructField("following", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", []), ("c", None)], s)
    got = sorted((r.username, r.pos, r.followee) for r in FL.follow_edges(df).collect())
    assert got == [("a", 0, "x"), ("a", 1, "y"), ("a", 2, "x"), ("b", None, None), ("c", None, None)]


def test_fetched_keeps_prefix_before_bad_element(spark):
    df = spark.createDataFrame([("u1", [("x",), None, ("y",)]), ("u2", [None, ("x",)]), ("u3", []),
                                ("u4", None), ("u5", [("x",), (None,), ("y",)])], schemas.FOLLOW_F2)
    got = {r.username: (r.following, r.status) for r in FL.parse_follows_fetched(df).collect()}
    assert got == {"u1": (["x"], "ok"), "u2": ([], "not_following"), "u3": ([], "not_following"),
                   "u4": ([], "not_following"), "u5": (["x", None, "y"], "ok")}


def test_f1_null_login_stays_and_junk_drops_the_list(spark):
    rows = [("a", ['{"login":"x"}', '{"login":null}']), ("b", ['{"login":"x"} junk']), ("c", ['{"name":"x"}']), ("d", ['{"login":"x"},{"login":"y"}']),
            ("e", ["[1]"]), ("f", [None]), ("g", ['{"login":"x","more":{"k":[1]}}'])]
    df = spark.createDataFrame(rows, "login string, following array<string>")
    got = {r.username: (r.following, r.status) for r in FL.parse_follows_json(df).collect()}
    bad = (None, "not_following")
    assert got == {"a": (["x", None], "ok"), "b": bad, "c": bad, "d": bad, "e": bad, "f": bad, "g": (["x"], "ok")}


def test_follower_records_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    from egoline.operators.skew import partitions_for
    from egoline.plans import bindings as B

    assert partitions_for(spark.range(1000), 10) == 100
    assert partitions_for(spark.range(5), 10) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(B, "partitions_for", lambda df: partitions_for(df, 10))
    li = spark.range(300).selectExpr("id div 3 AS l_orderkey", "id % 3 div 2 AS l_suppkey").unionByName(
        spark.createDataFrame([(None, 1), (999, 1)], "l_orderkey long, l_suppkey long"))
    o = spark.range(100).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey")
    monkeypatch.setattr(B, "table", lambda s, d, name: {"lineitem": li, "orders": o}[name])
    got = B.follower_records(spark, "")
    assert got.select(F.spark_partition_id()).distinct().count() > 10
    want = [(f"s{s}", [f"/c{i % 7}"] * n) for i in range(100) for s, n in ((0, 2), (1, 1))]
    assert sorted((r.login, r.following) for r in got.collect()) == sorted(want)


def test_inverted_lists_are_dealt_by_rows(spark, monkeypatch):
    from egoline.operators.skew import partitions_for

    monkeypatch.setattr(FL, "partitions_for", lambda df: partitions_for(df, 10), raising=False)
    rows = [(f"f{i}", [f"/m{j}" for j in (i, i, i + 1)]) for i in range(100)] + [(None, ["/m0", None]), ("e", []), ("n", None)]
    got = FL.invert(spark.createDataFrame(rows, schemas.FOLLOW_F1))
    assert got.select(F.spark_partition_id()).distinct().count() > 20
    want = {None: [None], "m0": [None, "f0", "f0"], "m100": ["f99"]} | {f"m{i}": sorted([f"f{i - 1}", f"f{i}", f"f{i}"]) for i in range(1, 100)}
    assert {r.username: r.following for r in got.collect()} == want
    counts, n = FL._follower_counts(spark.createDataFrame(rows, schemas.FOLLOW_F1), "login", "following", 1)
    assert n == 31 and counts.select(F.spark_partition_id()).distinct().count() > 20
