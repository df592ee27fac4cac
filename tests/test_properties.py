"""Property tests: operators against brute force on random small fixtures."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from egoline import schemas
from egoline.operators import edges as E
from egoline.operators import follows as FL
from egoline.operators import pages as PG
from egoline.operators.skew import hot_keys, skew_join

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

users = st.sampled_from([f"u{i}" for i in range(6)])
repos = st.sampled_from([f"o/r{i}" for i in range(5)])
pages_rows = st.lists(st.tuples(users, st.integers(0, 12),
                                st.lists(st.sampled_from(["a", "b", "c"]), max_size=3)), max_size=30)


def brute_stitch(rows, max_pages):
    """Page after page until one is empty or missing; of a page fetched twice the greater response."""
    best = {}
    for login, page, resp in rows:
        best[login, page] = max(resp, best.get((login, page), []))
    out = {}
    for login in {r[0] for r in rows}:
        out[login], page = [], 1
        while page <= max_pages and best.get((login, page)):
            out[login] += best[login, page]
            page += 1
    return out


@SETTINGS
@given(pages_rows)
def test_stitch_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, schemas.PAGES)
    for cap in (None, 9):
        got = {r.login: r.following for r in PG.stitch_pages(df, cap).collect()}
        assert got == brute_stitch(rows, cap or 99)


@SETTINGS
@given(st.lists(st.tuples(users, repos, st.sampled_from(["2013", "2015"])), max_size=40))
def test_list_view_explodes_back_to_edges(spark, rows):
    df = spark.createDataFrame(rows, "username string, repo string, part string")
    lists = E.user_repos(df, by_part=True)
    back = Counter((r.username, repo, r.part) for r in lists.collect() for repo in r.repos)
    assert back == Counter((u, r, p) for u, r, p in rows)
    dl = E.user_repos(df, by_part=False, distinct=True)
    assert {r.username: r.repos for r in dl.collect()} == \
        {u: sorted({r for uu, r, _ in rows if uu == u}) for u in {u for u, _, _ in rows}}


@SETTINGS
@given(st.lists(st.tuples(users, st.lists(users.map(lambda u: "/" + u), max_size=4)), max_size=15))
def test_invert_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, schemas.FOLLOW_F1)
    got = {r.username: r.following for r in FL.invert(df).collect()}
    want = defaultdict(list)
    for login, members in rows:
        for m in members:
            want[m[1:]].append(login)
    assert got == {k: sorted(v) for k, v in want.items()}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([3, 4, 5, 7]), users, st.integers(0, 50),
                          st.one_of(st.none(), st.lists(users, max_size=2))), max_size=25))
def test_merge_sources_matches_brute_force(spark, rows):
    schema = "username string, event_id long, following array<string>"
    srcs = [(p, spark.createDataFrame([(u, e, f) for pp, u, e, f in rows if pp == p], schema)) for p in (3, 4, 5, 7)]
    got = {r.username: (r.event_id, r.following) for r in FL.merge_sources(srcs, tie=("event_id", "following")).collect()}
    best = {}
    for p, u, e, f in rows:
        best[u] = max(best.get(u, ((), None)), ((p, e, f is not None, f or []), (e, f)), key=lambda x: x[0])
    assert got == {u: v[1] for u, v in best.items()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from(["h", "h", "h", "a", "b"])), max_size=60),
       st.lists(st.tuples(st.sampled_from(["h", "a", "c"]), st.integers(0, 9)), max_size=10),
       st.integers(1, 5), st.integers(2, 6))
def test_skew_join_matches_plain(spark, left_rows, right_rows, min_rows, buckets):
    left = spark.createDataFrame(left_rows, "id long, k string")
    right = spark.createDataFrame(right_rows, "k string, v long")
    for how in ("left", "inner"):
        salted = skew_join(left, right, "k", how, hot_keys(left, "k", min_rows), buckets)
        plain = left.join(right, "k", how)
        key = lambda r: tuple(-1 if x is None else x for x in r)
        assert sorted(salted.select("id", "k", "v").collect(), key=key) == \
            sorted(plain.select("id", "k", "v").collect(), key=key)


@SETTINGS
@given(st.lists(st.tuples(users, st.integers(0, 5), users), max_size=25),
       st.lists(st.tuples(users, repos, st.sampled_from(["2011", "2014_1", "2014_2"])), max_size=30),
       st.sampled_from(["2014", "All", "Dec. 2011"]), st.booleans())
def test_node_form_agrees_with_long_form(spark, follow_rows, edge_rows, label, across):
    from egoline.operators import graph as G
    follows = spark.createDataFrame(follow_rows, "username string, pos long, followee string")
    edges = spark.createDataFrame(edge_rows, "username string, repo string, part string")
    long = G.ego_graph(follows, edges, label=label, distinct_across=across)
    nodes = G.ego_nodes(follows, edges, label=label, distinct_across=across)
    dup = Counter((u, p, f) for u, p, f in follow_rows if f is not None)
    per_edge = defaultdict(list)
    for r in long.collect():
        per_edge[(r.seed, r.pos, r.followee)] += [r.repo] if r.repo is not None else []
    want = Counter()
    for k, reps in per_edge.items():
        n = dup[k]
        # the long form repeats each of a duplicated edge's rows n times
        want[(k[0], k[1], k[2], tuple(sorted(reps)[::n] if n > 1 else sorted(reps)))] += n
    got = Counter((r.seed, r.pos, r.followee, tuple(r.repos or ())) for r in nodes.collect())
    assert got == want


def _expected(variant, rec):
    """Brute-force statement of the normalisation rules for one record:
    ``(reason, username, repo)``, or None when the type is filtered out."""
    import json as _json
    if rec is None:
        return "corrupt", None, None
    if rec.get("type") not in ("WatchEvent", "CommitCommentEvent", "ForkEvent"):
        return None  # filtered out
    if variant in ("v1", "v2"):
        actor = rec.get("actor")
        if variant == "v2" and isinstance(actor, str):
            try:
                actor = _json.loads(actor)
            except ValueError:
                actor = None
        user = actor.get("login") if isinstance(actor, dict) else None
        repo = rec.get("repo")
        name = repo.get("name") if isinstance(repo, dict) else None
    else:
        user = rec.get("actor")
        r = rec.get("repository") or {}
        name = f"{r['owner']}/{r['name']}" if r.get("owner") is not None and r.get("name") is not None else None
    # rejects keep whatever did parse, for the report
    if user is None:
        return "null_user", None, name
    if name is None:
        return "null_repo", user, None
    return None, user, name


actor_v1 = st.one_of(st.none(), st.fixed_dictionaries({"login": users}), st.just({}))
actor_v2 = st.one_of(actor_v1.map(lambda a: None if a is None else __import__("json").dumps(a)),
                     st.just("{bad"), st.just("plain"))
repo_obj = st.one_of(st.none(), st.fixed_dictionaries({"name": repos}), st.just({}))
types = st.sampled_from(["WatchEvent", "CommitCommentEvent", "ForkEvent", "PushEvent"])
rec_v1 = st.fixed_dictionaries({"type": types, "actor": actor_v1, "repo": repo_obj})
rec_v2 = st.fixed_dictionaries({"type": types, "actor": actor_v2, "repo": repo_obj})
rec_v3 = st.fixed_dictionaries({"type": types, "actor": st.one_of(st.none(), users),
                                "repository": st.one_of(st.none(), st.fixed_dictionaries(
                                    {"owner": st.one_of(st.none(), st.just("o")),
                                     "name": st.one_of(st.none(), st.just("r"))}))})


@SETTINGS
@given(st.sampled_from(["v1", "v2", "v3"]), st.data())
def test_normalize_matches_rules(spark, tmp_path_factory, variant, data):
    import json as _json
    from egoline.operators.normalize import normalize
    from egoline.sources import read_timeline
    strat = {"v1": rec_v1, "v2": rec_v2, "v3": rec_v3}[variant]
    recs = data.draw(st.lists(st.one_of(strat, st.none()), min_size=1, max_size=25))
    lines = ["{broken" if r is None else _json.dumps(r) for r in recs]
    path = tmp_path_factory.mktemp("tl") / "t.json"
    path.write_text("\n".join(lines) + "\n")
    got = Counter((r.reason, r.username, r.repo)
                  for r in normalize(read_timeline(spark, str(path)), variant, part="p").collect())
    want = Counter(e for e in (_expected(variant, r) for r in recs) if e is not None)
    assert got == want
