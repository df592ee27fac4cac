"""Topic landing (exactly once across runs), driver entry and plan checks."""

import datetime as dt
import json


from egoline.sources import read_topic
from egoline.streaming import land_topics, topic_stream


def test_landing_twice_adds_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    msgs = [{"topic": t, "value": json.dumps({"login": f"u{i}"}), "timestamp": f"2015-03-0{1 + i % 2}T0{i % 3}:00:00Z"}
            for i, t in enumerate(["scrap-following-3", "scrap-following-7", "other", "scrap-following-3"])]
    (src / "a.json").write_text("\n".join(json.dumps(m) for m in msgs) + "\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(2):
        land_topics(topic_stream(spark, "json", str(src)), out, ck, allow=r"^scrap-following-",
                    deny=("scrap-following-7",)).awaitTermination()
    landed = read_topic(spark, out)
    assert landed.count() == 2
    assert {r.topic for r in landed.collect()} == {"scrap-following-3"}
    one_hour = read_topic(spark, out, topic="scrap-following-3", since=dt.datetime(2015, 3, 2), until=dt.datetime(2015, 3, 3))
    assert one_hour.count() == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = one_hour._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pf = plan.split("PartitionFilters: ")[1].split(", PushedFilters")[0]
    # the topic and the hour range are partition filters: folders are pruned, not rows
    assert "= scrap-following-3)" in pf and ">= 2015030200)" in pf and "< 2015030300)" in pf
    parsed = read_topic(spark, out, schema="login string")
    assert sorted(r.login for r in parsed.collect()) == ["u0", "u3"]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["seed", "followee", "repo", "part"]
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_python_eval_in_any_plan(spark):
    from egoline.plans.catalog import QUERIES
    for name, fn in QUERIES.items():
        if name == "land_topics":  # its plan reads what the landing wrote
            continue
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_id_range_pushed_into_scan(spark):
    import __spark_entry__ as E
    plan = E.queries()["id_range"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_custkey), GreaterThanOrEqual(c_custkey,200)" in plan


def test_oracle_matches_on_smoke_data(spark):
    import duckdb
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ["nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ["ego_graph", "page_stitch", "follow_parse_f1", "normalize_v2", "tree_stats", "weekly_trends", "ego_json",
                 "ego_json_named", "ego_tree_json", "repo_map", "follow_links_html", "trending_stored", "source_precedence",
                 "weekly_trends_by_day", "follows_pipeline"]:
        df = E.queries()[name](spark, sf)
        cols = sorted(df.columns)
        srows = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
        cur = con.execute(E.oracle_sql()[name])
        dcols = [d[0] for d in cur.description]
        assert sorted(dcols) == cols, name
        idx = [dcols.index(c) for c in cols]
        drows = sorted((tuple(r[i] for i in idx) for r in cur.fetchall()), key=repr)
        assert srows == drows, name


def _hour(out, topic, hour):
    import os
    return os.path.join(out, f"topic={topic}", "year=2015", "month=3", "day=1", f"hour={hour}")


def _gz(folder):
    import os
    return [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".gz")]


def test_landing_is_sized_by_volume(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lines = [("hot", 5, i) for i in range(20_000)] + [("cold", h, h) for h in range(20)]
    for k in range(4):
        (src / f"{k}.json").write_text("\n".join(json.dumps({"topic": t, "value": json.dumps({"i": i, "pad": f"{i:0200d}"}),
                                                            "timestamp": f"2015-03-01T{h:02d}:00:00Z"}) for t, h, i in lines[k::4]) + "\n")
    out = str(tmp_path / "out")
    land_topics(topic_stream(spark, "json", str(src)), out, str(tmp_path / "ck"), task_bytes=100_000).awaitTermination()
    assert len(_gz(_hour(out, "hot", 5))) > 2  # split over tasks
    assert all(len(_gz(_hour(out, "cold", h))) == 1 for h in range(20))  # one file each, however many tasks there were
    assert read_topic(spark, out).count() == len(lines)


def test_replayed_batch_leaves_no_duplicate(spark, tmp_path):
    import os
    import shutil
    src, ck, out = tmp_path / "in", tmp_path / "ck", str(tmp_path / "out")
    src.mkdir()
    write = lambda name, h, n: (src / name).write_text("\n".join(json.dumps({"topic": "t", "value": str(i), "timestamp": f"2015-03-01T{h:02d}:00:00Z"}) for i in range(n)) + "\n")
    land = lambda: land_topics(topic_stream(spark, "json", str(src)), out, str(ck)).awaitTermination()
    write("a.json", 1, 30)
    land()
    write("b.json", 1, 20)
    land()
    assert read_topic(spark, out).count() == 50
    # the second batch was written, but the stream died before it noted that
    for log in os.listdir(ck / "commits"):
        if log.strip(".").split(".")[0] == "1":
            os.remove(ck / "commits" / log)
    half = sorted(_gz(_hour(out, "t", 1)), key=os.path.getmtime)[-1]
    shutil.copy(half, half.replace("part-", "part-9"))  # left by an attempt that was killed
    land()
    assert read_topic(spark, out).count() == 50


def test_entry_schema_is_stable(spark):
    import __spark_entry__ as E
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert [f.dataType.simpleString() for f in a.schema.fields] == ["string", "string", "string", "string"]


def test_messages_without_a_place_are_kept(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join([
        json.dumps({"topic": "t", "value": "{}", "timestamp": "2015-03-01T05:00:00Z"}),
        json.dumps({"topic": "t", "value": "v", "timestamp": "noon"}), "broken {"]) + "\n")
    out = str(tmp_path / "out")
    land_topics(topic_stream(spark, "json", str(src)), out, str(tmp_path / "ck"), allow="^t$").awaitTermination()
    assert read_topic(spark, out).count() == 1
    assert read_topic(spark, out, topic="_rejects").count() == 2
