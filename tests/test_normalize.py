"""Timeline variants V1-V3 from JSON lines -> edges and rejects (FIXTURES.md)."""

import json

from pyspark.sql import functions as F

from egoline.operators.normalize import edges_and_rejects, keep_types, normalize
from egoline.sources import read_timeline
from tests.conftest import write_lines


def _edges(df):
    return sorted((r.username, r.repo) for r in df.collect())


def _reasons(df):
    return sorted(r.reason for r in df.collect())


def test_v1_edges_duplicates_and_rejects(spark, tmp_path):
    lines = [
        json.dumps({"type": "WatchEvent", "actor": {"login": "a"}, "repo": {"name": "o/r1"}}),
        json.dumps({"type": "WatchEvent", "actor": {"login": "a"}, "repo": {"name": "o/r1"}}),
        json.dumps({"type": "PushEvent", "actor": {"login": "a"}, "repo": {"name": "o/r9"}}),
        json.dumps({"type": "ForkEvent", "repo": {"name": "o/r2"}}),
        "{broken",
    ]
    tl = read_timeline(spark, write_lines(tmp_path / "v1.json", lines))
    e, rej = edges_and_rejects(tl, "v1", part="2015")
    assert _edges(e) == [("a", "o/r1"), ("a", "o/r1")]
    assert _edges(e.distinct()) == [("a", "o/r1")]
    assert _reasons(rej) == ["corrupt", "null_user"]
    corrupt = rej.filter(F.col("reason") == "corrupt").first()
    assert corrupt.raw == "{broken"


def test_prototype_types_keep_push(spark, tmp_path):
    lines = [json.dumps({"type": "PushEvent", "actor": {"login": "a"}, "repo": {"name": "o/r9"},
                         "created_at": "2015-01-01T00:00:01Z"})]
    tl = read_timeline(spark, write_lines(tmp_path / "p.json", lines))
    e, _ = edges_and_rejects(tl, "v1", types=("WatchEvent", "PushEvent"))
    row = e.first()
    assert (row.username, row.repo) == ("a", "o/r9")
    assert str(row.ts) == "2015-01-01 00:00:01"


def test_v2_actor_json_string(spark, tmp_path):
    lines = [
        json.dumps({"type": "CommitCommentEvent", "actor": json.dumps({"login": "c"}), "repo": {"name": "o/r3"}}),
        json.dumps({"type": "WatchEvent", "actor": "{bad", "repo": {"name": "o/r3"}}),
        json.dumps({"type": "WatchEvent", "actor": "plain", "repo": {"name": "o/r3"}}),
        json.dumps({"type": "WatchEvent", "actor": json.dumps({"login": "d"}), "repo": None}),
    ]
    tl = read_timeline(spark, write_lines(tmp_path / "v2.json", lines))
    e, rej = edges_and_rejects(tl, "v2", part="2012")
    assert _edges(e) == [("c", "o/r3")]
    assert _reasons(rej) == ["null_repo", "null_user", "null_user"]


def test_v3_owner_slash_name(spark, tmp_path):
    lines = [
        json.dumps({"type": "ForkEvent", "actor": "b", "repository": {"owner": "o", "name": "r2"}}),
        json.dumps({"type": "ForkEvent", "actor": "b", "repository": {"owner": "o"}}),
    ]
    tl = read_timeline(spark, write_lines(tmp_path / "v3.json", lines))
    e, rej = edges_and_rejects(tl, "v3", part="2013")
    assert _edges(e) == [("b", "o/r2")]
    assert _reasons(rej) == ["null_repo"]


def test_gzip_timeline(spark, tmp_path):
    import gzip
    p = tmp_path / "g" / "2015-01-01-0.json.gz"
    p.parent.mkdir()
    with gzip.open(p, "wt") as f:
        f.write(json.dumps({"type": "WatchEvent", "actor": {"login": "a"}, "repo": {"name": "o/r1"}}) + "\n")
    e, _ = edges_and_rejects(read_timeline(spark, str(p.parent)), "v1")
    assert _edges(e) == [("a", "o/r1")]


def test_isin_equals_union_of_three(spark, tmp_path):
    types = ["WatchEvent", "CommitCommentEvent", "ForkEvent", "PushEvent", "IssuesEvent"]
    lines = [json.dumps({"type": types[i % 5], "actor": {"login": f"u{i % 7}"}, "repo": {"name": f"o/r{i}"}})
             for i in range(50)]
    tl = read_timeline(spark, write_lines(tmp_path / "u.json", lines))
    one = keep_types(tl)
    three = (tl.filter("type = 'WatchEvent'").unionAll(tl.filter("type = 'CommitCommentEvent'"))
             .unionAll(tl.filter("type = 'ForkEvent'")))
    cols = ["type", "actor", "repo"]
    assert sorted(one.select(cols).collect()) == sorted(three.select(cols).collect())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_unknown_variant(spark, tmp_path):
    import pytest
    tl = read_timeline(spark, write_lines(tmp_path / "x.json", ["{}"]))
    with pytest.raises(ValueError):
        normalize(tl, "v9")
