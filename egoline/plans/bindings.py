"""Stand-in inputs built from the driver's tables.

The driver's tables are not a developer timeline, so each input of the
library is derived, inside Spark, from columns of the same shape:

* timeline event  <- ``events``: event type -> timeline type, ``c<user_id>``
  as the actor login, ``r/<props.k>`` as the repository, ``ts`` as the
  ``...Z`` creation time, day of month -> per-year part.
* follow edge     <- ``orders JOIN lineitem``: supplier ``s<l_suppkey>``
  follows customer ``c<o_custkey>``; each nation ``n<nationkey>`` is stored
  with an empty list (exercises the "follows no one" answer).
* paged responses <- ``orders``: the n-th order of a customer is page n.
* stored HTML     <- ``pages``.

Fault injection (bad JSON, plain strings, null parts, empty and null lists)
uses fixed rules on the row ids so that the oracle SQL can reproduce them; it
replaces values and never drops rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from egoline import schemas
from egoline.operators.skew import partitions_for
from egoline.session import table_path

# --- fixed values of the bindings --------------------------------------------
# events.event_type -> timeline event type
EVENT_TYPE_MAP = {
    "view": "WatchEvent",
    "purchase": "CommitCommentEvent",
    "signup": "ForkEvent",
    "click": "PushEvent",
    "error": "IssuesEvent",
}
# day of month -> part: days 1-5, 6-10, 11-15, 16-20, 21-25, 26-31
DAY_PARTS = ("2011", "2012", "2013", "2014_1", "2014_2", "2015")
# follow-record sources (topics) and their precedence, by events.event_type
TOPIC_PRIORITY = {"click": 3, "view": 4, "purchase": 5, "signup": 6, "error": 7}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name in schemas.DRIVER_TABLES:
        r = r.schema(schemas.DRIVER_TABLES[name])
    return r.parquet(table_path(sf_dir, name))


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k")


def _type_case() -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_TYPE_MAP.items()) + " END"


def _part_case(ts: str = "ts") -> str:
    parts = ", ".join(f"'{p}'" for p in DAY_PARTS)
    return f"element_at(array({parts}), least(CAST(floor((dayofmonth({ts}) - 1) / 5) AS INT) + 1, {len(DAY_PARTS)}))"


_LOGIN = "concat('c', CAST(user_id AS STRING))"
_ACTOR_JSON = f"to_json(named_struct('login', {_LOGIN}))"
_REPO_JSON = "to_json(named_struct('name', concat('r/', get_json_object(props, '$.k'))))"
_CREATED = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
_NULL = "CAST(NULL AS STRING)"


def timeline(spark: SparkSession, sf_dir: str, variant: str = "v1", faults: bool = False) -> DataFrame:
    """Events shaped like a timeline file read with the all-string schema,
    plus ``event_id`` and ``part``. Written as SQL expressions: one planner
    call instead of one per column operation."""
    typ, actor, repo, repository, created, corrupt = _type_case(), _ACTOR_JSON, _REPO_JSON, _NULL, _CREATED, _NULL
    if variant == "v1":
        if faults:
            corrupt = "CASE WHEN event_id % 10 = 2 THEN concat('{broken ', CAST(event_id AS STRING)) END"
            bad = "event_id % 10 = 2"
            typ = f"CASE WHEN {bad} THEN NULL ELSE {typ} END"
            actor = f"CASE WHEN event_id % 10 IN (0, 2) THEN NULL ELSE {actor} END"
            repo = f"CASE WHEN event_id % 10 IN (1, 2) THEN NULL ELSE {repo} END"
            created = f"CASE WHEN {bad} THEN NULL ELSE {created} END"
    elif variant == "v2":
        if faults:
            actor = (f"CASE WHEN event_id % 10 = 0 THEN substring({_ACTOR_JSON}, 1, 6) "
                     f"WHEN event_id % 10 = 1 THEN {_LOGIN} ELSE {_ACTOR_JSON} END")
            repo = f"CASE WHEN event_id % 10 = 2 THEN '{{}}' ELSE {_REPO_JSON} END"
    elif variant == "v3":
        actor, repo = _LOGIN, _NULL
        owner = "CASE WHEN event_id % 10 = 3 THEN NULL ELSE 'r' END" if faults else "'r'"
        repository = f"to_json(named_struct('owner', {owner}, 'name', get_json_object(props, '$.k')))"
    else:
        raise ValueError(variant)
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(
        "event_id", f"{typ} AS type", f"{actor} AS actor", f"{repo} AS repo",
        f"{repository} AS repository", f"{created} AS created_at",
        f"{corrupt} AS {schemas.CORRUPT_COL}", f"{_part_case()} AS part")


def edges(spark: SparkSession, sf_dir: str, types=None) -> DataFrame:
    """Clean edge table ``(username, repo, type, ts, part)`` from the V1 timeline."""
    from egoline.functions.constants import ACTIVITY_TYPES
    from egoline.operators.normalize import edges_and_rejects
    tl = timeline(spark, sf_dir, "v1")
    e, _ = edges_and_rejects(tl, "v1", part=F.col("part"), types=types or ACTIVITY_TYPES)
    return e


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long follow table ``(username, pos, followee)``; ``pos`` orders a user's list.

    Every (supplier, customer) pair of ``orders JOIN lineitem`` is a follow edge.
    Each nation ``n<nationkey>`` is stored with an empty list (one row with null
    ``pos`` and ``followee``), which exercises the "follows no one" answer
    without dropping any edge."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    # dedupe the numeric key pair first (a cheaper shuffle), then build names
    pairs = (li.join(o, li.l_orderkey == o.o_orderkey)
             .select("l_suppkey", "o_custkey").distinct()
             .select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("username"),
                     F.col("o_custkey").alias("pos"),
                     F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("followee")))
    empty = (table(spark, sf_dir, "nation")
             .select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("username"),
                     F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("followee")))
    return pairs.unionByName(empty)


def all_user_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, supplier and nation name: the seed / request list."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("username"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("username"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("username"))
    return c.unionByName(s).unionByName(n)


def follower_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follower lists ``(login, following)`` where ``following`` holds *followers*
    with a one-character prefix: per (order, supplier), the order's customer once
    per line item. Both sides are dealt by order into partitions that follow the
    rows: the join and the lists of an order stay in one task of bounded memory."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    n = partitions_for(li)
    li, o = li.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy("l_orderkey", "l_suppkey")
            .agg(F.collect_list(F.concat(F.lit("/c"), F.col("o_custkey").cast("string"))).alias("following"))
            .select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("login"), "following"))


def follow_records(spark: SparkSession, sf_dir: str, variant: str) -> DataFrame:
    """Per-order follow records ``(record_id, login, following)`` of variant F1
    (JSON texts) or F2 (structs), with a bad element where the customer key is a
    multiple of 7 and the supplier key a multiple of 10, an empty list where the
    order key is a multiple of 9 and a null list where it is a multiple of 11."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    bad = (F.col("o_custkey") % 7 == 0) & (F.col("l_suppkey") % 10 == 0)
    name = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    if variant == "f1":
        elem = F.when(bad, F.lit("oops")).otherwise(F.to_json(F.struct(name.alias("login"))))
        empty = F.array().cast("array<string>")
    else:
        # carry the bad flag through collect_list, then turn bad entries into null elements
        elem = F.struct(name.alias("login"), bad.alias("bad"))
        empty = F.array().cast("array<struct<login:string>>")
    g = (li.join(o, li.l_orderkey == o.o_orderkey)
         .groupBy("o_orderkey", "o_custkey").agg(F.collect_list(elem).alias("lst")))
    if variant == "f2":
        g = g.withColumn("lst", F.transform(
            "lst", lambda x: F.when(~x["bad"], F.struct(x["login"].alias("login")))))
    lst = (F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast(g.schema["lst"].dataType))
           .when(F.col("o_orderkey") % 9 == 0, empty).otherwise(F.col("lst")))
    return g.select(F.col("o_orderkey").alias("record_id"),
                    F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("login"),
                    lst.alias("following"))


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow records of several topics in one table ``(username, event_id, topic,
    following, priority)``; records of the ``error`` topic carry a null list."""
    prio = F.lit(None).cast("int")
    for etype, p in TOPIC_PRIORITY.items():
        prio = F.when(F.col("event_type") == etype, p).otherwise(prio)
    lst = F.when(F.col("event_type") != "error", F.array(F.concat(F.lit("c"), _k())))
    return table(spark, sf_dir, "events").withColumn("priority", prio).select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("username"), "event_id",
        F.concat(F.lit("following-"), F.col("priority").cast("string")).alias("topic"), lst.alias("following"), "priority")


def listed_follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long follow table ``(username, pos, followee)`` in stored order with repeats:
    supplier ``s<l_suppkey>`` follows the customer of each of its line items, in
    the order of order key and line number. Nations have empty lists."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("username"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("pos"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("followee"))
    empty = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("username"),
        F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("followee"))
    return rows.unionByName(empty)


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged responses ``(login, id, page, fetched, response)``: the n-th order of a
    customer (by order key) is page n; orders with key multiple of 13 are failed
    calls (null response), with key multiple of 11 empty pages (end of list).
    Pages of orders with key multiple of 7 were fetched twice: the older fetch
    has another answer, which must not count."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    resp = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("array<string>"))
            .when(F.col("o_orderkey") % 11 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))))
    p = o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("login"), F.col("o_custkey").alias("id"),
                 F.row_number().over(w).alias("page"), F.lit(2).alias("fetched"), resp.alias("response"), "o_orderkey")
    again = p.filter(F.col("o_orderkey") % 7 == 0).withColumn("fetched", F.lit(1)).withColumn("response", F.array(F.lit("zz")))
    return p.unionByName(again).drop("o_orderkey")


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide user records ``(login, id, ...)`` from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("login"),
                    F.col("c_custkey").alias("id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic messages ``(topic, value, timestamp)``, one topic per event type."""
    from egoline.sources.sinks import to_messages
    ev = table(spark, sf_dir, "events")
    m = to_messages(ev, F.concat(F.lit("events-"), F.col("event_type")),
                    value_cols=("event_id", "user_id", "value", "props"), timestamp="ts")
    return m.select("topic", "value", "timestamp")


def html_follow_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored follow pages ``(login, page, html)`` from ``pages``: each stored page
    belongs to user ``p<page_id>``; its page number is the URL's ``page=``
    parameter (1 when absent), so a page-2-only user has a gap before it."""
    pg = table(spark, sf_dir, "pages")
    num = F.regexp_extract("url", r"[?&]page=([0-9]+)", 1)
    page = F.when(num != "", num.cast("int")).otherwise(F.lit(1))
    return pg.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("login"),
                     page.alias("page"), "html")


def fetched_follow_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order fetched follow lists ``(record_id, login, following)`` as
    structs, in line order (line number, then supplier); a null element marks a
    bad entry (customer key multiple of 7 and supplier key multiple of 10);
    order key multiple of 9 gives an empty list, multiple of 11 a null list."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    bad = (F.col("o_custkey") % 7 == 0) & (F.col("l_suppkey") % 10 == 0)
    g = (li.join(o, li.l_orderkey == o.o_orderkey)
         .groupBy("o_orderkey", "o_custkey")
         .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", bad.alias("bad")))).alias("lines")))
    lst = F.transform("lines", lambda x: F.when(~x["bad"], F.struct(
        F.concat(F.lit("s"), x["l_suppkey"].cast("string")).alias("login"))))
    typ = "array<struct<login:string>>"
    lst = (F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast(typ))
           .when(F.col("o_orderkey") % 9 == 0, F.array().cast(typ)).otherwise(lst))
    return g.select(F.col("o_orderkey").alias("record_id"),
                    F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("login"),
                    lst.alias("following"))


#: Markup of a follow link by page id modulo 6; all are the same link to a reader.
LINK_MARKUP = (
    '<h3 class="follow-list-name"><a href="$1">$2</a></h3>',
    '<h3 class="follow-list-name"><span><a href="$1">$2</a></span></h3>',
    '<h3 class="follow-list-name"><a class="u" href="$1">$2</a></h3>',
    '<h3 class="follow-list-name"><a href="$1"><b>$2</b></a></h3>',
    '<h3 class="css-truncate follow-list-name"><a href="$1">$2</a></h3>',
    "<h3 class='follow-list-name'><a href='$1'>$2</a></h3>",
)


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored follow pages ``(page_id, html)``: the links of ``pages`` written as
    headings of the follow list, in six kinds of markup by page id."""
    html = F.col("html")
    for k, markup in enumerate(LINK_MARKUP):
        html = F.when(F.col("page_id") % 6 == k, F.regexp_replace("html", r'<a href="(/[^"]*)">([^<]*)</a>', markup)).otherwise(html)
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


#: Follow topics of the three batches, those of the highest precedence first.
FOLLOW_BATCHES = ((6, 7), (4, 5), (3,))


#: Harder markup of a follow link by page id modulo 6, and what text its reader sees.
HARD_MARKUP = (
    "<h3 class=follow-list-name><a href=$1>$2</a></h3>",
    '<!-- <h3 class="follow-list-name"><a href="/no">no</a></h3> --><H3 CLASS="follow-list-name"><A HREF="$1">$2</A></H3>',
    "<script>var s = '<h3 class=\"follow-list-name\"><a href=\"/no\">no</a></h3>';</script><h3 class=\"follow-list-name\"><a href=\"$1\">$2</a></h3>",
    '<h3 class="follow-list-name"><a href="$1">&lt;$2&gt; &eacute;&#x41;&copy</a></h3>',
    '<h3 data-x="a>b" class="x follow-list-name y"><i></i><a title=\'<a href="/no">\' href="$1"> $2 </a><a href="/second">no</a></h3>',
    '<h3 class="follow-list-name"><a href="$1">$2<b>!<!-- no --></b></a> no</h3><h3 class="follow-list-names"><a href="/no">no</a></h3>',
)


def hard_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored follow pages ``(page_id, html)``: the links of ``pages`` in six kinds of
    markup that patterns miss (no quotes, comments, scripts, references)."""
    html = F.col("html")
    for k, markup in enumerate(HARD_MARKUP):
        html = F.when(F.col("page_id") % 6 == k, F.regexp_replace("html", r'<a href="(/[^"]*)">([^<]*)</a>', markup)).otherwise(html)
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


#: Number of the first of the user dump files, and how many there are.
FIRST_DUMP, DUMPS = 1499999, 4


def write_user_dumps(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Customers as numbered files of one JSON array each (``users<N>`` by customer
    key); every user has a nested object and strings with braces, quotes and commas."""
    user = F.to_json(F.struct(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("login"), F.col("c_custkey").alias("id"),
        F.struct(F.concat(F.lit('}, {"login": "x'), F.col("c_name"), F.lit('\\')).alias("bio"), F.lit("]").alias("end")).alias("more")))
    number = (F.col("c_custkey") % DUMPS + FIRST_DUMP).alias("number")
    made = (table(spark, sf_dir, "customer").select(number, user.alias("u")).groupBy("number")
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("u"), ",\n "), F.lit("]")).alias("value")))
    made.write.partitionBy("number").text(path + "-parts")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for k in range(DUMPS):  # Spark's writers choose file names; dump files are numbered
        folder = fs.Path(f"{path}-parts/number={FIRST_DUMP + k}")
        store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if store.exists(folder):
            store.mkdirs(fs.Path(path))
            store.rename(next(s.getPath() for s in store.listStatus(folder)), fs.Path(f"{path}/users{FIRST_DUMP + k}"))


def follow_messages(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Landed follow messages ``(topic, value, timestamp)`` of one of three batches.
    Every event is a follow record of its type's topic (``TOPIC_PRIORITY``): odd
    topics hold F1 records (lists of JSON texts), even ones F2 records (structs),
    and those of ``error`` events have no list."""
    prio = F.lit(None).cast("int")
    for etype, p in TOPIC_PRIORITY.items():
        prio = F.when(F.col("event_type") == etype, p).otherwise(prio)
    ev = table(spark, sf_dir, "events").withColumn("prio", prio).filter(F.col("prio").isin(*FOLLOW_BATCHES[batch]))
    login = F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("login")
    followee = F.struct(F.concat(F.lit("c"), _k()).alias("login"))
    listed = F.col("event_type") != "error"
    f1 = F.to_json(F.struct(login, F.when(listed, F.array(F.to_json(followee))).alias("following")))
    f2 = F.to_json(F.struct(login, F.when(listed, F.array(followee)).alias("following")))
    return ev.select(F.concat(F.lit("following-"), F.col("prio").cast("string")).alias("topic"),
                     F.when(F.col("prio") % 2 == 1, f1).otherwise(f2).alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


def normalized_events(spark: SparkSession, sf_dir: str, late: bool | None = None) -> DataFrame:
    """Normalised timeline rows (edges, and rejects with a reason); ``late`` picks
    the events whose id is a multiple of five (which came late) or the others."""
    from egoline.functions.constants import ACTIVITY_TYPES
    from egoline.operators.normalize import normalize
    tl = timeline(spark, sf_dir, "v1")
    if late is not None:
        tl = tl.filter((F.col("event_id") % 5 == 0) == F.lit(late))
    return normalize(tl, "v1", part=F.col("part"), types=ACTIVITY_TYPES)
