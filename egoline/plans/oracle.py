"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement recomputes the query's result straight from the driver's
tables, reproducing the bindings' rules (name prefixes, type mapping, fault
rules) in plain SQL; JSON answers are put together as text.
"""

ACT = "('view', 'purchase', 'signup')"

EV = """ev AS (
  SELECT event_id, user_id, event_type, ts,
         'c' || user_id AS username,
         'r/' || json_extract_string(props, '$.k') AS repo,
         CASE event_type WHEN 'view' THEN 'WatchEvent' WHEN 'purchase' THEN 'CommitCommentEvent'
              WHEN 'signup' THEN 'ForkEvent' WHEN 'click' THEN 'PushEvent' ELSE 'IssuesEvent' END AS type,
         strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_s,
         date_trunc('second', ts) AS ts_sec,
         CASE WHEN day(ts) <= 5 THEN '2011' WHEN day(ts) <= 10 THEN '2012' WHEN day(ts) <= 15 THEN '2013'
              WHEN day(ts) <= 20 THEN '2014_1' WHEN day(ts) <= 25 THEN '2014_2' ELSE '2015' END AS part
  FROM events)"""

FL = """fl AS (
  SELECT DISTINCT 's' || l_suppkey AS seed, 'c' || o_custkey AS followee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FL_ALL = """fl2 AS (
  SELECT DISTINCT 's' || l_suppkey AS username, 'c' || o_custkey AS followee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL
  SELECT 'n' || n_nationkey AS username, NULL AS followee FROM nation)"""

NAMES = """names AS (
  SELECT 'c' || c_custkey AS username FROM customer
  UNION ALL SELECT 's' || s_suppkey AS username FROM supplier
  UNION ALL SELECT 'n' || n_nationkey AS username FROM nation)"""

WEEK = f"""e AS (SELECT * FROM ev WHERE event_type IN {ACT}),
m AS (SELECT max(ts_sec) AS as_of FROM e),
wk AS (
  SELECT repo AS reponame, count(*)::BIGINT AS watchcount FROM e, m
  WHERE type = 'WatchEvent' AND ts_sec > as_of - INTERVAL 7 DAY AND ts_sec <= as_of
  GROUP BY repo)"""

TOP10 = "top AS (SELECT * FROM wk ORDER BY watchcount DESC, reponame LIMIT 10)"

LINK = '<a href="(/[^"]*)">([^<]*)</a>'


def _ego(parts: str) -> str:
    return f"""eg AS (
  SELECT DISTINCT username, repo, part FROM ev
  WHERE event_type IN {ACT} AND part IN {parts})"""


def _ego_json(parts: str, form: str, seeds: str) -> str:
    """The answers as text: a followed user without repositories has no list, seeds
    without a stored or filled list (where seeds are named) a response."""
    name, kids, leaf = (("username", "following", "repositories") if form == "api" else ("name", "children", "children"))
    item = "'\"' || repo || '\"'" if form == "api" else "'{\"name\":\"' || repo || '\",\"size\":10000}'"
    answers = f"""'{{"{name}":"' || s.username || '","{kids}":[' || k || ']}}'"""
    sql = f"""WITH {EV}, {NAMES}, {_ego(parts)},
li AS (SELECT 's' || l_suppkey AS seed, l_orderkey * 8 + l_linenumber AS pos, 'c' || o_custkey AS followee
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lists AS (SELECT username, string_agg({item}, ',' ORDER BY repo) AS r FROM eg GROUP BY username),
kids AS (
  SELECT seed, string_agg('{{"{name}":"' || followee || '"' || CASE WHEN r IS NULL THEN '' ELSE ',"{leaf}":[' || r || ']' END
                          || '}}', ',' ORDER BY pos, followee) AS k
  FROM li LEFT JOIN lists ON followee = username GROUP BY seed),
stored AS (SELECT seed, k FROM kids UNION ALL SELECT 'n' || n_nationkey, NULL FROM nation),
s AS ({seeds})
"""
    if form == "tree":
        return sql + f"SELECT s.username, {answers} AS json FROM s JOIN stored ON s.username = seed WHERE k IS NOT NULL"
    return sql + f"""SELECT s.username,
       CASE WHEN seed IS NULL THEN '{{"Response":"Records for ' || s.username || ' were not found"}}'
            WHEN k IS NULL THEN '{{"Response":"' || s.username || ' is not following anyone"}}'
            ELSE {answers} END AS json
FROM s LEFT JOIN stored ON s.username = seed"""


def _norm_v1(json_source: bool) -> str:
    part = "CASE WHEN event_id % 10 = 2 THEN NULL ELSE part END" if json_source else "part"
    return f"""WITH {EV}
SELECT event_id,
       CASE WHEN event_id % 10 IN (0, 2) THEN NULL ELSE username END AS username,
       CASE WHEN event_id % 10 IN (1, 2) THEN NULL ELSE repo END AS repo,
       CASE WHEN event_id % 10 = 2 THEN NULL ELSE type END AS type,
       CASE WHEN event_id % 10 = 2 THEN NULL ELSE ts_s END AS ts,
       {part} AS part,
       CASE event_id % 10 WHEN 2 THEN 'corrupt' WHEN 0 THEN 'null_user' WHEN 1 THEN 'null_repo' END AS reason
FROM ev WHERE event_type IN {ACT} OR event_id % 10 = 2"""


NORM_V2 = f"""WITH {EV}
SELECT event_id,
       CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE username END AS username,
       CASE WHEN event_id % 10 = 2 THEN NULL ELSE repo END AS repo,
       type, ts_s AS ts, part,
       CASE WHEN event_id % 10 IN (0, 1) THEN 'null_user' WHEN event_id % 10 = 2 THEN 'null_repo' END AS reason
FROM ev WHERE event_type IN {ACT}"""

NORM_V3 = f"""WITH {EV}
SELECT event_id, username,
       CASE WHEN event_id % 10 = 3 THEN NULL ELSE repo END AS repo,
       type, ts_s AS ts, part,
       CASE WHEN event_id % 10 = 3 THEN 'null_repo' END AS reason
FROM ev WHERE event_type IN {ACT}"""

NORM_ALL = f"""WITH {EV}
SELECT event_id,
       CASE WHEN event_id % 10 IN (0, 2) THEN NULL ELSE username END AS username,
       CASE WHEN event_id % 10 IN (1, 2) THEN NULL ELSE repo END AS repo,
       '2015' AS part,
       CASE event_id % 10 WHEN 2 THEN 'corrupt' WHEN 0 THEN 'null_user' WHEN 1 THEN 'null_repo' END AS reason
FROM ev WHERE event_type IN {ACT} OR event_id % 10 = 2
UNION ALL
SELECT event_id,
       CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE username END,
       CASE WHEN event_id % 10 = 2 THEN NULL ELSE repo END,
       '2012',
       CASE WHEN event_id % 10 IN (0, 1) THEN 'null_user' WHEN event_id % 10 = 2 THEN 'null_repo' END
FROM ev WHERE event_type IN {ACT}
UNION ALL
SELECT event_id, username,
       CASE WHEN event_id % 10 = 3 THEN NULL ELSE repo END,
       '2013',
       CASE WHEN event_id % 10 = 3 THEN 'null_repo' END
FROM ev WHERE event_type IN {ACT}"""

FOLLOW_PARSE = """WITH r AS (
  SELECT o_orderkey, o_custkey,
         bool_or(o_custkey % 7 = 0 AND l_suppkey % 10 = 0) AS has_bad,
         string_agg('s' || l_suppkey, ',' ORDER BY 's' || l_suppkey) AS lst,
         count(*) AS n
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_custkey)
SELECT o_orderkey AS record_id, 'c' || o_custkey AS username,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN '' WHEN has_bad THEN NULL
            ELSE lst END AS following,
       (CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 0 WHEN has_bad THEN NULL
            ELSE n END)::BIGINT AS n_following,
       CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 9 = 0 OR has_bad THEN 'not_following'
            ELSE 'ok' END AS status
FROM r"""

ORACLE = {
    "activity_filter": f"""WITH {EV}
SELECT event_id, username, repo, type FROM ev WHERE event_type IN {ACT}""",

    "user_repo_list": f"""WITH {EV}
SELECT username, string_agg(repo, ',' ORDER BY repo) AS repos, count(*)::BIGINT AS n_repos
FROM ev WHERE event_type IN {ACT} GROUP BY username""",

    "user_repo_segments": f"""WITH {EV},
c AS (SELECT username, repo, count(*) AS n FROM ev WHERE event_type IN {ACT} GROUP BY ALL),
r AS (SELECT *, (row_number() OVER (PARTITION BY username ORDER BY repo) - 1) // 8 AS segment FROM c)
SELECT username, segment::BIGINT AS segment, string_agg(repo || '*' || n, ',' ORDER BY repo) AS repos FROM r GROUP BY ALL""",

    "invert_segments": """WITH c AS (
  SELECT 'c' || o_custkey AS username, 's' || l_suppkey AS follower, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
r AS (SELECT *, (row_number() OVER (PARTITION BY username ORDER BY follower) - 1) // 5 AS segment FROM c)
SELECT username, segment::BIGINT AS segment, string_agg(follower || '*' || n, ',' ORDER BY follower) AS followers FROM r GROUP BY ALL""",

    "siblings_ranked": """WITH p AS (
  SELECT p_brand AS parent, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part),
c AS (SELECT parent, name, count(*) AS n FROM p GROUP BY ALL)
SELECT parent, name, n::BIGINT AS n,
       (1 + coalesce(sum(n) OVER (PARTITION BY parent ORDER BY lower(name), name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS first
FROM c""",

    "page_stitch_long": """WITH p AS (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page,
         CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 0 ELSE 1 END AS nonempty
  FROM orders),
r AS (SELECT *, min(nonempty) OVER (PARTITION BY o_custkey ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS all_ok FROM p)
SELECT 'c' || o_custkey AS username, page::BIGINT AS pos, 'o' || o_orderkey AS followee FROM r WHERE all_ok = 1""",

    "user_repo_distinct": f"""WITH {EV}
SELECT DISTINCT username, repo, part FROM ev WHERE event_type IN {ACT}""",

    "normalize_v1": _norm_v1(False),
    "normalize_v2": NORM_V2,
    "normalize_v3": NORM_V3,
    "normalize_all_variants": NORM_ALL,
    "timeline_json_v1": _norm_v1(True),
    "timeline_json_v2": NORM_V2,
    "timeline_json_v3": NORM_V3,

    "weekly_trends": f"""WITH {EV}, {WEEK}
SELECT reponame, watchcount FROM wk""",

    "weekly_trends_by_day": f"""WITH {EV}, {WEEK}
SELECT reponame, watchcount FROM wk""",

    "top10_weekly": f"""WITH {EV}, {WEEK}, {TOP10}
SELECT reponame, watchcount FROM top""",

    "trending_json": f"""WITH {EV}, {WEEK}, {TOP10}
SELECT '{{"Trending":[' || string_agg('{{"reponame":"' || reponame || '","watchcount":' || watchcount || '}}', ','
       ORDER BY watchcount DESC, reponame) || ']}}' AS json
FROM top""",

    "trending_stored": f"""WITH {EV}, {WEEK}, {TOP10}
SELECT '{{"Trending":[' || string_agg('{{"reponame":"' || reponame || '","watchcount":' || watchcount || '}}', ','
       ORDER BY watchcount DESC, reponame) || ']}}' AS json
FROM top""",

    "repo_map": f"""WITH {EV},
l AS (SELECT username, repo, strftime(max(ts_sec), '%Y-%m-%d %H:%M:%S') AS latest
      FROM ev WHERE event_type IN ('view', 'click') GROUP BY username, repo)
SELECT username, string_agg(repo || '=' || latest, ',' ORDER BY repo) AS repos FROM l GROUP BY username""",

    "user_list_gzip": """SELECT 'c' || c_custkey AS username, c_custkey AS userid
FROM customer WHERE c_custkey BETWEEN 30 AND 900""",

    "follow_links_html": f"""WITH x AS (
  SELECT page_id,
         regexp_extract_all(html, '{LINK}', 1) AS h,
         regexp_extract_all(html, '{LINK}', 2) AS t
  FROM pages),
y AS (SELECT page_id, unnest(generate_series(1, len(h))) AS pos, unnest(h) AS hh, unnest(t) AS tt FROM x)
SELECT page_id, pos::BIGINT AS pos, substr(hh, 2) AS slug, tt AS text FROM y""",

    "follow_links_markup": f"""WITH x AS (
  SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS h, regexp_extract_all(html, '{LINK}', 2) AS t FROM pages),
y AS (SELECT page_id, unnest(generate_series(1, len(h))) AS pos, unnest(h) AS hh, unnest(t) AS tt FROM x)
SELECT page_id, pos::BIGINT AS pos, substr(hh, 2) AS slug,
       CASE page_id % 6 WHEN 3 THEN '<' || tt || '> éA©' WHEN 4 THEN ' ' || tt || ' ' WHEN 5 THEN tt || '!' ELSE tt END AS text
FROM y""",

    "user_dumps_range": """SELECT 'c' || c_custkey AS username, c_custkey AS userid, (c_custkey % 4 + 1499999)::BIGINT AS file_no
FROM customer WHERE c_custkey % 4 IN (1, 2)""",

    "follows_pipeline": """WITH r AS (
  SELECT 'c' || user_id AS username, CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 4 WHEN 'purchase' THEN 5
           WHEN 'signup' THEN 6 WHEN 'error' THEN 7 END AS priority,
         date_trunc('millisecond', ts) AS sent, CASE WHEN event_type <> 'error' THEN 'c' || json_extract_string(props, '$.k') END AS following
  FROM events),
w AS (SELECT *, row_number() OVER (PARTITION BY username ORDER BY priority DESC, sent DESC, following DESC) AS rn FROM r)
SELECT username, following, priority FROM w WHERE rn = 1""",

    "repo_latest_map": f"""WITH {EV}
SELECT username, repo, strftime(max(ts_sec), '%Y-%m-%d %H:%M:%S') AS latest
FROM ev WHERE event_type IN ('view', 'click') GROUP BY username, repo""",

    "invert_follows": """SELECT 'c' || o_custkey AS username,
       string_agg('s' || l_suppkey, ',' ORDER BY 's' || l_suppkey) AS following,
       count(*)::BIGINT AS n_following
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey""",

    "follow_parse_f1": FOLLOW_PARSE,
    "follow_parse_f2": FOLLOW_PARSE,

    "follow_parse_fetched": """WITH r AS (
  SELECT o_orderkey, o_custkey, l_suppkey, (o_custkey % 7 = 0 AND l_suppkey % 10 = 0) AS bad,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey) AS rn
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
fb AS (SELECT o_orderkey, min(CASE WHEN bad THEN rn END) AS first_bad FROM r GROUP BY o_orderkey),
k AS (
  SELECT r.*, (o_orderkey % 11 <> 0 AND o_orderkey % 9 <> 0 AND (first_bad IS NULL OR rn < first_bad)) AS keep
  FROM r JOIN fb USING (o_orderkey))
SELECT o_orderkey AS record_id, 'c' || o_custkey AS username,
       coalesce(string_agg(CASE WHEN keep THEN 's' || l_suppkey END, ',' ORDER BY rn), '') AS following,
       count(CASE WHEN keep THEN 1 END)::BIGINT AS n_following,
       CASE WHEN count(CASE WHEN keep THEN 1 END) = 0 THEN 'not_following' ELSE 'ok' END AS status
FROM k GROUP BY o_orderkey, o_custkey""",

    "source_precedence": """WITH r AS (
  SELECT 'c' || user_id AS username, event_id, event_type, json_extract_string(props, '$.k') AS k,
         CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 4 WHEN 'purchase' THEN 5
              WHEN 'signup' THEN 6 WHEN 'error' THEN 7 END AS prio
  FROM events),
w AS (SELECT *, row_number() OVER (PARTITION BY username ORDER BY prio DESC, event_id DESC) AS rn FROM r)
SELECT username, event_id, 'following-' || prio AS topic,
       CASE WHEN event_type = 'error' THEN NULL ELSE 'c' || k END AS following
FROM w WHERE rn = 1""",

    "ego_graph": f"""WITH {EV}, {FL}, {_ego("('2013')")}
SELECT fl.seed, fl.followee, eg.repo, eg.part FROM fl LEFT JOIN eg ON fl.followee = eg.username""",

    "ego_graph_multi_part": f"""WITH {EV}, {FL}, {_ego("('2014_1', '2014_2')")}
SELECT fl.seed, fl.followee, eg.repo, count(eg.part)::BIGINT AS n_parts
FROM fl LEFT JOIN eg ON fl.followee = eg.username
GROUP BY fl.seed, fl.followee, eg.repo""",

    "ego_graph_all_years": f"""WITH {EV}, {FL}, {_ego("('2011', '2012', '2013', '2014_1', '2014_2', '2015')")}
SELECT fl.seed, fl.followee, eg.repo, count(eg.part)::BIGINT AS n_parts
FROM fl LEFT JOIN eg ON fl.followee = eg.username
GROUP BY fl.seed, fl.followee, eg.repo""",

    "ego_graph_distinct_across": f"""WITH {EV}, {FL},
eg AS (SELECT DISTINCT username, repo FROM ev WHERE event_type IN {ACT})
SELECT fl.seed, fl.followee, eg.repo FROM fl LEFT JOIN eg ON fl.followee = eg.username""",

    "ego_json": _ego_json("('2013')", "api", "SELECT DISTINCT username FROM names"),
    "ego_tree_json": _ego_json("('2013')", "tree", "SELECT seed AS username FROM stored"),
    "ego_json_named": _ego_json("('2014_1', '2014_2')", "api",
                                "SELECT unnest(['s1', 's3', 's9999999', 'c1', 'n0', 'nobody']) AS username"),

    "ego_status": f"""WITH {FL_ALL}, {NAMES},
c AS (SELECT username, count(followee) AS n FROM fl2 GROUP BY username),
s AS (SELECT DISTINCT username FROM names)
SELECT s.username,
       CASE WHEN c.n IS NULL THEN 'not_found' WHEN c.n = 0 THEN 'not_following' ELSE 'ok' END AS status,
       CASE WHEN c.n IS NULL THEN 'Records for ' || s.username || ' were not found'
            WHEN c.n = 0 THEN s.username || ' is not following anyone' END AS message,
       c.n::BIGINT AS n_following
FROM s LEFT JOIN c ON s.username = c.username""",

    "tree_stats": f"""WITH {EV}, {FL},
eg AS (SELECT DISTINCT username, repo, part FROM ev WHERE event_type IN {ACT}),
lf AS (SELECT fl.seed, fl.followee, eg.repo FROM fl LEFT JOIN eg ON fl.followee = eg.username),
node AS (SELECT seed, followee, count(repo) AS leaves, coalesce(max(length(repo)), 0) AS leaf_len
         FROM lf GROUP BY seed, followee)
SELECT seed AS username,
       (1 + count(*) + sum(leaves))::BIGINT AS total_nodes,
       greatest(length(seed), max(greatest(length(followee), leaf_len)))::BIGINT AS max_label_length,
       count(*)::BIGINT AS level1,
       sum(leaves)::BIGINT AS level2
FROM node GROUP BY seed""",

    "siblings_sorted": """WITH p AS (
  SELECT p_brand AS parent, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part)
SELECT parent, string_agg(name, '|' ORDER BY lower(name), name) AS children, count(*)::BIGINT AS n_children
FROM p GROUP BY parent""",

    "userid_lookup": """WITH r AS (
  SELECT DISTINCT username FROM (
    SELECT 'c' || user_id AS username FROM events
    UNION ALL SELECT 's' || s_suppkey AS username FROM supplier)),
ids AS (SELECT 'c' || c_custkey AS username, c_custkey AS userid FROM customer)
SELECT r.username, ids.userid,
       CASE WHEN ids.userid IS NULL THEN r.username || ' is not in the database' END AS message
FROM r LEFT JOIN ids ON r.username = ids.username""",

    "missing_users": f"""WITH {FL_ALL}, {NAMES}
SELECT DISTINCT username FROM names WHERE username NOT IN (SELECT username FROM fl2)""",

    "id_range": """SELECT 'c' || c_custkey AS username, c_custkey AS userid
FROM customer WHERE c_custkey BETWEEN 200 AND 800""",

    "upsert_snapshot": """WITH ex AS (
  SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey < 500),
nw AS (
  SELECT c_custkey, c_name, c_acctbal + 1.0 AS c_acctbal FROM customer WHERE c_custkey % 2 = 1 OR c_custkey < 500)
SELECT * FROM ex WHERE c_custkey NOT IN (SELECT c_custkey FROM nw)
UNION ALL SELECT * FROM nw""",

    "upsert_buckets": """WITH ex AS (
  SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey < 500),
nw AS (
  SELECT c_custkey, c_name, c_acctbal + 1.0 AS c_acctbal FROM customer WHERE c_custkey % 2 = 1 OR c_custkey < 500)
SELECT * FROM ex WHERE c_custkey NOT IN (SELECT c_custkey FROM nw)
UNION ALL SELECT * FROM nw""",

    "page_stitch": """WITH p AS (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page,
         CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 0 ELSE 1 END AS nonempty
  FROM orders),
r AS (
  SELECT *, min(nonempty) OVER (PARTITION BY o_custkey ORDER BY page
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS all_ok
  FROM p)
SELECT 'c' || o_custkey AS username, o_custkey AS id,
       coalesce(string_agg(CASE WHEN all_ok = 1 THEN 'o' || o_orderkey END, ',' ORDER BY page), '') AS following,
       count(CASE WHEN all_ok = 1 THEN 1 END)::BIGINT AS n_following
FROM r GROUP BY o_custkey""",

    "extract_links": f"""WITH x AS (
  SELECT page_id,
         regexp_extract_all(html, '{LINK}', 1) AS h,
         regexp_extract_all(html, '{LINK}', 2) AS t
  FROM pages),
y AS (SELECT page_id, unnest(generate_series(1, len(h))) AS pos, unnest(h) AS hh, unnest(t) AS tt FROM x)
SELECT page_id, pos::BIGINT AS pos, substr(hh, 2) AS slug, tt AS text FROM y""",

    "follow_pages_html": f"""WITH x AS (
  SELECT 'p' || page_id AS login,
         coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER), 1) AS page,
         regexp_extract_all(html, '{LINK}', 1) AS h
  FROM pages)
SELECT login AS username,
       CASE WHEN page = 1 THEN array_to_string(list_transform(h, lambda x: substr(x, 2)), ',') ELSE '' END AS following,
       (CASE WHEN page = 1 THEN len(h) ELSE 0 END)::BIGINT AS n_following
FROM x""",

    "edge_table_label": f"""WITH {EV}
SELECT username, repo, type, ts_s AS ts, part FROM ev
WHERE event_type IN {ACT} AND part IN ('2014_1', '2014_2')""",

    "rejects_summary": f"""WITH {EV}
SELECT CASE event_id % 10 WHEN 2 THEN 'corrupt' WHEN 0 THEN 'null_user' ELSE 'null_repo' END AS reason,
       count(*)::BIGINT AS n_rows
FROM ev WHERE (event_type IN {ACT} OR event_id % 10 = 2) AND event_id % 10 IN (0, 1, 2)
GROUP BY 1""",

    "land_topics": """SELECT 'events-' || event_type AS topic, event_id,
       year(ts)::BIGINT AS year, month(ts)::BIGINT AS month,
       day(ts)::BIGINT AS day, hour(ts)::BIGINT AS hour
FROM events WHERE event_type <> 'error'""",
}
