"""Page stitching, link extraction, trends, upsert, user dumps, ids."""

import datetime as dt
import json

from pyspark.sql import functions as F

from egoline import schemas
from egoline.functions.constants import MAX_PAGES
from egoline.operators import lookup as L
from egoline.operators import pages as PG
from egoline.operators import trends as TR
from egoline.sources import read_user_dumps, sinks as K


def _stitch(spark, rows, **kw):
    df = spark.createDataFrame(rows, schemas.PAGES)
    return {r.login: r.following for r in PG.stitch_pages(df, **kw).collect()}


def test_stitch_rules(spark):
    rows = [("s", 1, ["a"]), ("s", 2, ["b"]), ("s", 3, []), ("s", 4, ["z"]),
            ("g", 1, ["a"]), ("g", 3, ["c"]),
            ("e", 1, []),
            ("m", 2, ["x"])]
    rows += [("c", p, [f"e{p}"]) for p in range(1, 12)]
    got = _stitch(spark, rows, max_pages=MAX_PAGES)
    assert _stitch(spark, rows)["c"] == [f"e{p}" for p in range(1, 12)]
    assert got["s"] == ["a", "b"]
    assert got["g"] == ["a"]
    assert got["e"] == []
    assert got["m"] == []
    assert got["c"] == [f"e{p}" for p in range(1, 10)]


def test_extract_links_from_follow_pages(spark):
    html = ('<div><h3 class="follow-list-name"><a href="/alice">Alice A</a></h3>'
            '<h3 class="follow-list-name"><a href="/bob">Bob</a></h3><a href="/other">x</a></div>')
    df = spark.createDataFrame([("u/following", html)], schemas.STORED_HTML)
    got = [(r.pos, r.slug, r.text) for r in PG.extract_follow_links(df).orderBy("pos").collect()]
    assert got == [(1, "alice", "Alice A"), (2, "bob", "Bob")]
    pages = spark.createDataFrame([("u", 1, html), ("u", 2, "<p>none</p>"), ("u", 3, html)],
                                  "login string, page int, html string")
    st = PG.follow_pages_from_html(pages).first()
    assert st.following == ["alice", "bob"]


def _edges(spark, rows):
    return spark.createDataFrame(rows, "username string, repo string, type string, ts timestamp, part string")


def test_weekly_trends_window_and_top(spark):
    t = dt.datetime(2015, 1, 10, 12, 0, 0)
    rows = [("u1", "o/a", "WatchEvent", t), ("u2", "o/a", "WatchEvent", t - dt.timedelta(days=3)),
            ("u3", "o/b", "WatchEvent", t - dt.timedelta(days=6, hours=23)),
            ("u4", "o/c", "WatchEvent", t - dt.timedelta(days=7)),       # outside (as_of - 7d, as_of]
            ("u5", "o/d", "ForkEvent", t)]
    e = _edges(spark, [r + ("2015",) for r in rows])
    got = {r.reponame: r.watchcount for r in TR.weekly_trends(e).collect()}
    assert got == {"o/a": 2, "o/b": 1}
    top = TR.top_repos(TR.weekly_trends(e), k=1)
    assert [r.reponame for r in top.collect()] == ["o/a"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    js = json.loads(TR.trending_json(TR.top_repos(TR.weekly_trends(e))).first().json)
    assert js == {"Trending": [{"reponame": "o/a", "watchcount": 2}, {"reponame": "o/b", "watchcount": 1}]}


def test_upsert_idempotent(spark):
    ex = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v long")
    once = K.upsert(ex, new, "k")
    twice = K.upsert(once, new, "k")
    assert sorted(once.collect()) == sorted(twice.collect()) == [("a", 1), ("b", 20), ("c", 30)]


def test_user_dumps_array_files_and_range(spark, tmp_path):
    d = tmp_path / "users_data"
    d.mkdir()
    for n, users in [(1499999, [("a", 1)]), (1500000, [("b", 2), ("c", 3)]), (2000000, [("d", 4)]),
                     (2000001, [("e", 5)])]:
        (d / f"users{n}").write_text(json.dumps([{"login": u, "id": i, "extra": "x"} for u, i in users]))
    (d / "other1").write_text(json.dumps([{"login": "zz", "id": 9}]))
    df = read_user_dumps(spark, str(d), lo=1500000, hi=2000000)
    ids = L.user_ids(df)
    assert sorted((r.username, r.userid) for r in ids.collect()) == [("b", 2), ("c", 3), ("d", 4)]


def test_lookup_and_range(spark):
    ids = spark.createDataFrame([("a", 1), ("b", 5)], "username string, userid long")
    req = spark.createDataFrame([("a",), ("q",)], "username string")
    got = {r.username: (r.userid, r.message) for r in L.lookup_ids(req, ids).collect()}
    assert got == {"a": (1, None), "q": (None, "q is not in the database")}
    assert L.id_range(ids, "userid", 1, 1).count() == 1


def test_messages(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "login string, id long")
    m = K.to_messages(df, "users", key="login")
    r = m.first()
    assert (r.topic, r.key, json.loads(r.value)) == ("users", "a", {"login": "a", "id": 1})
    K.write_messages(m, path=str(tmp_path / "msgs"))
    assert spark.read.json(str(tmp_path / "msgs")).count() == 1


def test_snapshot_partitions(spark, tmp_path):
    e = _edges(spark, [("u", "o/a", "WatchEvent", None, "2013"), ("u", "o/b", "WatchEvent", None, "2015")])
    K.write_edges(e, str(tmp_path / "edges"))
    back = spark.read.parquet(str(tmp_path / "edges")).filter(F.col("part") == "2013")
    assert [r.repo for r in back.collect()] == ["o/a"]
    assert "PartitionFilters: [isnotnull(part" in back._jdf.queryExecution().executedPlan().toString()


def test_cluster_conf_sizes():
    from egoline.session import cluster_conf
    c = cluster_conf(100 * (1 << 40))
    assert c["spark.sql.shuffle.partitions"] == "409600"
    assert cluster_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_read_edges_label_prunes_parts(spark, tmp_path):
    from egoline.sources import read_edges
    e = _edges(spark, [("u", "o/a", "WatchEvent", None, "2014_1"), ("u", "o/b", "WatchEvent", None, "2014_2"),
                       ("u", "o/c", "WatchEvent", None, "2015")])
    K.write_edges(e, str(tmp_path / "edges"))
    df = read_edges(spark, str(tmp_path / "edges"), label="2014")
    assert sorted(r.repo for r in df.collect()) == ["o/a", "o/b"]
    assert dict(df.dtypes)["part"] == "string"
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*IN \(2014_1,2014_2\)", plan)


def test_user_repo_map_latest_time(spark):
    from egoline.operators import edges as E
    t = dt.datetime(2015, 1, 1, 0, 0, 1)
    e = _edges(spark, [("a", "o/r1", "WatchEvent", t, "2015"),
                       ("a", "o/r1", "PushEvent", t + dt.timedelta(hours=1), "2015"),
                       ("a", "o/r2", "ForkEvent", t, "2015")])
    m = E.user_repo_map(e).first()
    assert m.username == "a" and m.repos == {"o/r1": t + dt.timedelta(hours=1)}


def test_weekly_trends_explicit_as_of(spark):
    t = dt.datetime(2015, 1, 10)
    e = _edges(spark, [("u", "o/a", "WatchEvent", t, "2015"), ("u", "o/b", "WatchEvent", t - dt.timedelta(days=10), "2015")])
    got = {r.reponame: r.watchcount for r in TR.weekly_trends(e, as_of=dt.datetime(2015, 1, 5)).collect()}
    assert got == {"o/b": 1}


def test_stitch_keeps_users_without_pages(spark):
    df = spark.createDataFrame([("a", 1, ["x"])], schemas.PAGES)
    users = spark.createDataFrame([("a",), ("b",)], "login string")
    got = {r.login: (r.following, r.n_following) for r in PG.stitch_pages(df, users=users).collect()}
    assert got == {"a": (["x"], 1), "b": ([], 0)}


def test_reject_policy(spark):
    import pytest
    rej = spark.createDataFrame([("null_user", "{}")], "reason string, raw string")
    K.enforce_rejects(rej, "skip")
    K.enforce_rejects(rej.limit(0), "fail")
    with pytest.raises(K.RejectedRows):
        K.enforce_rejects(rej, "fail")


def test_small_lookup_does_not_shuffle_id_table(spark, tmp_path):
    p = str(tmp_path / "ids")
    spark.range(200000).selectExpr("concat('u', id) AS username", "id AS userid").write.parquet(p)
    ids = spark.read.parquet(p)
    req = spark.createDataFrame([("u7",), ("nobody",)], "username string")
    out = L.lookup_ids(req, ids)
    assert sorted((r.username, r.userid) for r in out.collect()) == [("nobody", None), ("u7", 7)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan


def test_gzip_user_lines_and_id_shard(spark, tmp_path):
    import gzip
    d = tmp_path / "dump"
    d.mkdir()
    with gzip.open(d / "usernames.gz", "wt") as f:
        for login, i in [("a", 1999999), ("b", 2000000), ("c", 3500000), ("d", 4000000), ("e", 4000001)]:
            f.write(json.dumps({"login": login, "id": i, "site_admin": False}) + "\n")
    users = read_user_dumps(spark, str(d), prefix="usernames", array_files=False)
    ids = L.user_ids(users, lo=2000000, hi=4000000)
    assert sorted(r.username for r in ids.collect()) == ["b", "c", "d"]


def test_html_pages_have_no_cap(spark):
    html = '<h3 class="follow-list-name"><a href="/p{0}">P{0}</a></h3>'
    rows = [("u", p, html.format(p)) for p in range(1, 13)] + [("u", 13, "<p>end</p>"), ("u", 14, html.format(14))]
    pages = spark.createDataFrame(rows, "login string, page int, html string")
    st = PG.follow_pages_from_html(pages).first()
    assert st.following == [f"p{p}" for p in range(1, 13)]
    capped = PG.follow_pages_from_html(pages, max_pages=9).first()
    assert capped.n_following == 9


def test_stitch_duplicate_pages_failed_calls_and_ids(spark):
    rows = [("a", 7, 1, 1, ["old"]), ("a", 7, 1, 2, ["new"]), ("a", 7, 2, 1, ["x"]), ("a", 7, 3, 1, ["y"]),
            ("b", 8, 1, 1, ["p"]), ("b", 8, 2, 1, None), ("b", 8, 3, 1, ["q"])]
    df = spark.createDataFrame(rows, "login string, id long, page int, fetched int, response array<string>")
    got = {r.login: (r.id, r.following) for r in PG.stitch_pages(df, fetched="fetched", keep=("id",)).collect()}
    assert got == {"a": (7, ["new", "x", "y"]), "b": (8, ["p"])}


def test_follow_links_in_any_markup(spark):
    h = 'follow-list-name'
    cases = [f'<h3 class="{h}"><a href="/a">A &amp; B</a></h3>', f'<h3 class="{h}"><span class="x"><a href="/a">A</a></span></h3>',
             f'<h3 class="{h}"><a class="u" href="/a">A</a></h3>', f'<h3 class="{h}"><a href="/a"><b>A</b></a></h3>',
             f'<h3 id="i" class="css {h}"><a href="/a">A</a></h3>', f"<h3 class='{h}'><a href='/a'>A</a></h3>"]
    none = ['<h3 class="other"><a href="/a">A</a></h3>', f'<h3 class="{h}">no link</h3>', f'<h3 class="{h}-x"><a href="/a">A</a></h3>',
            '<a href="/a">A</a>', "", None]
    df = spark.createDataFrame(list(enumerate(cases + none)), "url long, html string")
    got = {r.url: (r.slug, r.text) for r in PG.extract_follow_links(df).collect()}
    assert got == {0: ("a", "A & B"), **{i: ("a", "A") for i in range(1, 6)}}
    pages = spark.createDataFrame([("u", 1, cases[0]), ("u", 2, cases[3]), ("u", 3, cases[5])], "login string, page int, html string")
    assert PG.follow_pages_from_html(pages).first().following == ["a", "a", "a"]


def test_times_of_the_timeline(spark):
    from egoline.functions import columns as C
    texts = ["2012-03-10T22:42:06Z", "2012-03-10T22:42:06.000Z", "2012-03-10T14:42:06-08:00", "2012/03/10 14:42:06 -0800", "noon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.date_format(C.parse_created_at("t"), "yyyy-MM-dd HH:mm:ss").alias("x"))
    assert [r.x for r in df.collect()] == ["2012-03-10 22:42:06"] * 4 + [None, None]


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from egoline.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(cluster)
