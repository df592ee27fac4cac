"""Explicit schemas. Nothing is inferred: inference is an extra full read and
its answer drifts with the data (the timeline changed shape by year)."""

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

# One physical read schema covers all timeline variants: the JSON reader keeps
# an object as its raw JSON text when the field is declared STRING, and keeps a
# plain string unquoted, so each variant's normaliser picks fields from text.
TIMELINE_READ = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("repo", T.StringType()),
    T.StructField("repository", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField(CORRUPT_COL, T.StringType()),
])

USER = T.StructType([
    T.StructField("login", T.StringType()),
    T.StructField("id", T.LongType()),
])

FOLLOW_F1 = T.StructType([
    T.StructField("login", T.StringType()),
    T.StructField("following", T.ArrayType(T.StringType())),
])

FOLLOW_F2 = T.StructType([
    T.StructField("login", T.StringType()),
    T.StructField("following", T.ArrayType(
        T.StructType([T.StructField("login", T.StringType())]))),
])

PAGES = T.StructType([
    T.StructField("login", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("response", T.ArrayType(T.StringType())),
])

STORED_HTML = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

TOPIC_ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Canonical edge table: one row per (user, repository) activity, partitioned
# by the per-year table the row belongs to. Declared, so that part names like
# "2013" are not read back as integers by partition type inference.
EDGE_COLUMNS = ("username", "repo", "type", "ts", "part")
EDGE = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("repo", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("part", T.StringType()),
])

# Schemas of the driver's test tables, declared so a read never infers them
# from file footers (one footer read per query and table otherwise).
DRIVER_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
}
