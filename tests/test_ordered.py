"""Order inside a key by range sort, segmented lists, long page stitching, markup and array files."""

import json
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from egoline.operators import edges as E
from egoline.operators import follows as FL
from egoline.operators import graph as G
from egoline.operators import markup, ordered
from egoline.operators import pages as PG
from egoline.sources import read_user_dumps
from egoline.sources.arrays import read_json_arrays
from egoline import schemas


@pytest.fixture
def eager(spark):
    """Small range partitions, as a large table would have."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(4))
def test_places_match_a_running_sum(spark, eager, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "hot", "b", "c", None, f"k{i % 40}"]), i * 7919 % 1000, rng.randint(-3, 9)) for i in range(500 if seed else 0)]
    df = spark.createDataFrame(rows, "k string, o long, w long").repartition(5)
    got = {(r.k, r.o): (r.before, r.n) for r in ordered.preceded(ordered.preceded(df, ["k"], ["o"], "w"), ["k"], ["o"], name="n").collect()}
    want, total, n = {}, defaultdict(int), Counter()
    for k, o, w in sorted(rows, key=lambda r: r[1]):
        want[(k, o)] = (total[k], n[k])
        total[k] += w
        n[k] += 1
    assert got == want


def test_places_are_dealt_by_rows(spark, monkeypatch):
    from egoline.operators.skew import partitions_for

    monkeypatch.setattr(ordered, "partitions_for", lambda df: partitions_for(df, 10), raising=False)
    rows = [(k, o, (o * 7 + len(k or "")) % 11 - 3) for k, n in (("hot", 130), (None, 60), ("b", 9)) for o in range(n)] + [(f"k{i}", 0, 5) for i in range(101)]
    df = spark.createDataFrame(rows, "k string, o long, w long")
    got = ordered.preceded(df, ["k"], ["o"], "w")
    assert got.select(F.spark_partition_id()).distinct().count() > 12
    assert {(r.k, r.o): r.before for r in got.collect()} == {(k, o): sum(x for a, b, x in rows if a == k and b < o) for k, o, _ in rows}
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()  # nothing sorts what it has read to find a partition's ends
    seg = ordered.segments(df, ["k"], ["o"], F.col("o"), 4)
    assert seg.select(F.spark_partition_id()).distinct().count() > 12
    assert {(r.k, r.segment): r.entries for r in seg.collect()} == {(k, o // 4): [b for a, b, _ in sorted((x for x in rows if x[0] == k), key=lambda x: x[1]) if b // 4 == o // 4] for k, o, _ in rows}


def test_a_user_with_a_third_of_the_rows_spreads_over_tasks(spark, eager):
    rows = [("hot", f"r{i:04d}") for i in range(1200)] + [(f"u{i % 97}", f"r{i}") for i in range(2400)]
    e = spark.createDataFrame([(u, r, "2015") for u, r in rows] * 2, "username string, repo string, part string")
    seg = E.user_repo_segments(e, by_part=False, size=50)
    cells = {(r.username, r.segment): [(x.repo, x.n) for x in r.entries] for r in seg.collect()}
    assert max(map(len, cells.values())) <= 50
    got = defaultdict(list)
    for (u, s), cell in sorted(cells.items()):
        got[u] += cell
    n = Counter(rows)
    want = defaultdict(list)
    for (u, r), c in sorted(n.items()):
        want[u].append((r, 2 * c))
    assert got == want
    tasks = seg.filter("username = 'hot'").groupBy(F.spark_partition_id()).count().count()
    assert tasks >= 3  # segments of one user are put together in several tasks
    placed = ordered.preceded(e.distinct(), ["username"], ["repo"])
    assert placed.filter("username = 'hot'").select(F.spark_partition_id()).distinct().count() >= 2


def test_segments_of_nothing_and_inverted_lists(spark, eager):
    none = spark.createDataFrame([], "username string, repo string, part string")
    assert E.user_repo_segments(none).count() == 0
    df = spark.createDataFrame([(f"f{i:03d}", ["/star", f"/m{i % 5}", "/star"]) for i in range(130)] + [("e", []), ("n", None)], "login string, following array<string>")
    seg = FL.invert_segments(df, size=20)
    got = defaultdict(list)
    for r in sorted(seg.collect()):
        got[r.username] += [x.follower for x in r.entries for _ in range(x.n)]
    assert got == {r.username: r.following for r in FL.invert(df).collect()}


def test_rank_in_a_hot_parent(spark, eager):
    rng = random.Random(4)
    rows = [("p", "".join(rng.choices("aAbBcé", k=3))) for _ in range(900)] + [(f"q{i % 6}", f"n{i}") for i in range(300)]
    got = {(r.parent, r.name): (r.n, r.first) for r in G.siblings_ranked(spark.createDataFrame(rows, "p string, c string"), "p", "c").collect()}
    want = {}
    for parent in {p for p, _ in rows}:
        names = sorted((c.lower(), c) for p, c in rows if p == parent)
        for i, (_, c) in enumerate(names):
            want.setdefault((parent, c), (sum(1 for _, x in names if x == c), i + 1))
    assert got == want


def test_long_stitching_matches_lists(spark, eager):
    rng = random.Random(8)
    rows = [(f"u{i % 30}", rng.choice([0, 1, 2, 3, 4, 5, 6]), rng.choice([None, [], [f"a{i}"], [f"b{i}", "b", f"b{i}"]]), i) for i in range(220)]
    rows += [("hot", p, [f"x{p}", f"y{p}"], 1) for p in range(1, 200)] + [("hot", 120, [], 2), ("none", 2, ["z"], 1)]
    df = spark.createDataFrame(rows, "login string, page int, response array<string>, fetched int")
    for cap in (None, 3):
        lists = {r.login: r.following for r in PG.stitch_pages(df, cap, fetched="fetched").collect()}
        got = defaultdict(dict)
        for r in PG.stitch_pages_long(df, cap, fetched="fetched").collect():
            got[r.login][r.pos] = r.followee
        assert {u: [x for _, x in sorted(g.items())] for u, g in got.items()} == {u: x for u, x in lists.items() if x}
        assert all(sorted(g) == list(range(1, len(g) + 1)) for g in got.values())
    plan = PG.stitch_pages_long(df, fetched="fetched")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    assert PG.stitch_pages_long(df.limit(0)).count() == 0


REFERENCES = {"&": ["&amp;", "&#38;", "&#x26;"], "<": ["&lt;", "&#60;", "&LT;"], "é": ["é", "&eacute;", "&#233;"], " ": ["&nbsp;", "&#160;"]}


def random_page(rng):
    """Markup and the links that a reader sees in it."""
    out, want = [], []

    def text(decoy=False):
        letters = rng.choices(["a", "b", " ", "&", "<", "é", " ", "\n", ">"], k=rng.randint(0, 6))
        return "".join(letters), "".join(rng.choice(REFERENCES.get(c, [c])) for c in letters)

    def attr(name, value):
        name = rng.choice([name, name.upper()])
        kinds = [f'{name}="{value}"', f"{name} = '{value}'"] + ([f"{name}={value}"] if " " not in value else [])
        return rng.choice(kinds)

    for i in range(rng.randint(0, 12)):
        kind = rng.random()
        decoy = f'<h3 class="follow-list-name"><a href="/no{i}">no</a></h3>'
        if kind < 0.15:
            out.append(rng.choice([f"<!-- {decoy} -->", f"<script>x = '{decoy}'</script>", f"<style>{decoy}</style>", f"<p title='{decoy}'>t</p>",
                                   decoy.replace("follow-list-name", "follow-list-names"), decoy.replace("h3", "h2"), decoy.replace("href", "hrefs")]))
            continue
        plain, coded = text()
        inner, inner_coded = text()
        cls = rng.choice(["follow-list-name", "x follow-list-name", "follow-list-name  y"])
        tag, a = rng.choice([("h3", "a"), ("H3", "A")])
        extra = rng.choice(["", " data-x='a>b'", " hidden", ' title="<a href=/no>"'])
        before = rng.choice(["", "<br>", "text", "<span></span>", "<i>z</i>", "<!-- c -->"])
        after = rng.choice(["", '<a href="/second">no</a>', "tail", "<br/>"])
        out.append(f"<{tag} {attr('class', cls)}{extra}>{before}<{a}{extra} {attr('href', f'/u{i}')}>{coded}<b>{inner_coded}</b><!-- no --></{a}>{after}</{tag}>")
        want.append({"slug": f"u{i}", "text": plain + inner})
    return "".join(f"<li>{x}</li>" if rng.random() < 0.5 else x for x in out), want


def test_links_of_random_markup(spark):
    rng = random.Random(12)
    pages = [random_page(rng) for _ in range(400)]
    assert sum(len(w) for _, w in pages) > 1000
    for html, want in pages:
        assert markup.links_of(html) == want, html
    df = spark.createDataFrame([(i, html, "kept") for i, (html, _) in enumerate(pages)] + [(-1, None, None)], "id long, html string, links0 string")
    got = {r.id: [(x.slug, x.text) for x in r.links] for r in markup.with_follow_links(df).collect()}
    assert got == {-1: [], **{i: [(x["slug"], x["text"]) for x in want] for i, (_, want) in enumerate(pages)}}


def test_broken_markup_ends(spark):
    assert markup.links_of('<h3 class="follow-list-name"><a href="/a">x') == [{"slug": "a", "text": "x"}]
    assert markup.links_of('</h3></a><h3 class="follow-list-name"></h3><a href="/a">x</a><h3 class><a>') == []
    assert markup.links_of("<h3 class=follow-list-name><a>no target</a><a href=/b>b</a></h3>") == []
    assert markup.links_of("<" * 2000 + "&#xFFFFFFFF; <h3") == []
    link = "<h3 class=follow-list-name><a href=/b>b</a></h3>"
    assert markup.links_of(link + "<![odd one]> <!bad <![CDATA[x") == [{"slug": "b", "text": "b"}]
    deep = markup.links_of("<p>" * 50_000 + link + "<i></i>" * 50_000 + link * 3_000)  # linear in the page
    assert len(deep) == 3_001


def dump(n, seed):
    rng = random.Random(seed)
    odd = ["}", "{", "},", '"', "\\", "]", "[", '},{"login":"no"}', "é😀", "\n", '\\"}']
    users = []
    for i in range(n):
        u = {"login": "".join(rng.choices(odd, k=rng.randint(0, 3))) + f"u{i}", "id": i}
        if rng.random() < 0.6:
            u["more"] = {"a": {"b": "".join(rng.choices(odd, k=4))}, "l": [{"c": "}"}, [{}]]}
        users.append(u)
    return users


def test_array_files_in_many_splits(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    want = {}
    for k, (n, indent) in enumerate([(0, None), (1, None), (300, None), (200, 2), (3, 4)]):
        users = dump(n, k)
        sep = (",", ":") if k == 2 else None
        (folder / f"users{k}").write_text(json.dumps(users, indent=indent, separators=sep, ensure_ascii=k % 2 == 0))
        want.update({(f"users{k}", i): (u["login"], u["id"]) for i, u in enumerate(users)})
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = spark.read.option("lineSep", "}").text(str(folder))
        assert scan.rdd.getNumPartitions() > 8  # more splits than files
        got = {(r.file_name, r.element): (r.login, r.id) for r in read_json_arrays(spark, str(folder), schemas.USER).collect()}
        ranged = read_user_dumps(spark, str(folder), lo=2, hi=3, split=True)
        assert sorted(ranged.groupBy("file_no").count().collect()) == [(2, 300), (3, 200)]
        assert read_user_dumps(spark, str(folder), lo=50, split=True).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want
    whole = read_user_dumps(spark, str(folder))
    assert sorted(map(tuple, whole.select("login", "id").collect())) == sorted(want.values())
    assert os.path.exists(folder)
