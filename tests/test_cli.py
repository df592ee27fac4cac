"""The command line, run in-process on the test session."""

import json

from egoline.__main__ import main
from tests.conftest import write_lines


def test_cli_edges_ego_trends(spark, tmp_path):
    src = write_lines(tmp_path / "tl" / "a.json", [
        json.dumps({"type": "WatchEvent", "actor": {"login": "a"}, "repo": {"name": "o/r1"},
                    "created_at": "2015-01-02T00:00:00Z"}),
        json.dumps({"type": "WatchEvent", "actor": {"login": "b"}, "repo": {"name": "o/r1"},
                    "created_at": "2015-01-03T00:00:00Z"}),
        json.dumps({"type": "ForkEvent", "actor": {"login": "b"}, "repo": {"name": "o/r2"},
                    "created_at": "2015-01-03T00:00:00Z"})])
    edges = str(tmp_path / "edges")
    main(["edges", "--src", src, "--variant", "v1", "--part", "2015", "--edges", edges])
    uf = str(tmp_path / "userfollow")
    spark.createDataFrame([("u", ["b", "a", "z"]), ("n", [])], "username string, following array<string>") \
        .write.parquet(uf)
    out = str(tmp_path / "ego")
    main(["ego", "--edges", edges, "--userfollow", uf, "--year", "2015", "--user", "u", "--user", "n",
          "--user", "x", "--out", out])
    got = {r.username: json.loads(r.json) for r in spark.read.json(out).collect()}
    assert got["u"] == {"username": "u", "following": [
        {"username": "b", "repositories": ["o/r1", "o/r2"]}, {"username": "a", "repositories": ["o/r1"]},
        {"username": "z"}]}
    assert got["n"] == {"Response": "n is not following anyone"}
    assert got["x"] == {"Response": "Records for x were not found"}
    top = str(tmp_path / "top")
    main(["trends", "--edges", edges, "--trends", str(tmp_path / "trends"), "--top", top])
    main(["trending", "--top", top, "--out", str(tmp_path / "trending")])
    js = json.loads(spark.read.json(str(tmp_path / "trending")).first().json)
    assert js == {"Trending": [{"reponame": "o/r1", "watchcount": 2}]}
