"""Keyed tables: rows dealt into buckets by a hash of the key, one folder per bucket.

A lookup opens the buckets of its keys only. An upsert reads and rewrites the
buckets that its batch touches and commits them (``sources.snapshots``); all
other buckets stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from egoline.sources.sinks import upsert
from egoline.sources.snapshots import DATA, Conflict, Version, current, exists, publish, read_version, stage

BUCKET = "bucket"
#: Buckets of a new table; a table keeps the number it was created with.
BUCKETS = 64


def bucket_of(key, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(buckets)).cast("int")


def buckets_of(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that a table's keys fall into: at most ``buckets`` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of the batch replace stored rows of the same key."""
    return upsert(old, new, key)


def upsert_table(spark: SparkSession, root: str, new: DataFrame, key: str, table: str = DATA, merge=replace_rows,
                 buckets: int = BUCKETS, retries: int = 3) -> Version:
    """Merge a batch into the committed table and commit the buckets it touches.

    ``merge(old, new, key)`` gets the touched buckets' stored rows and the batch,
    both without the bucket column. ``new`` is read once per attempt and must give
    the same rows each time. When another writer commits first, the merge is done
    again on its version, up to ``retries`` times; then :class:`Conflict` is raised.
    A plain table found at ``root`` is taken over whole by the first commit.
    """
    plain = spark.read.parquet(root) if current(spark, root) is None and exists(spark, root) else None
    for attempt in range(retries + 1):
        base = current(spark, root)
        stored = (base.tables.get(table) if base else None) or {"buckets": buckets}
        n = stored["buckets"]
        if base is None and plain is not None:
            old, touched = plain, range(n)
        else:
            touched = buckets_of(new, key, n)
            old = read_version(spark, root, base, table, {BUCKET: touched}) if base and touched else None
        rows = new if old is None else merge(old.drop(BUCKET), new, key)
        staged = stage(rows.withColumn(BUCKET, bucket_of(key, n)), root, table, by=(BUCKET,), sort=(key,), buckets=n)
        hit = {f"{BUCKET}={b}" for b in touched}
        try:
            return publish(spark, root, base, {table: staged}, lambda _, k: k in hit)
        except Conflict:
            if attempt == retries:
                raise


def lookup(spark: SparkSession, root: str, keys: DataFrame, key: str, table: str = DATA, where: dict | None = None) -> DataFrame | None:
    """The committed rows of the wanted keys (``keys``: one column of names, a
    request's size): only their buckets are opened, and the rest of those
    buckets is left by a semi join before anything is shuffled or aggregated."""
    base = current(spark, root)
    if base is None or table not in base.tables:
        return None
    wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    buckets = buckets_of(wanted, key, base.tables[table]["buckets"])
    rows = read_version(spark, root, base, table, {**(where or {}), BUCKET: buckets} if buckets else {BUCKET: [-1]})
    return rows.drop(BUCKET).join(wanted, key, "left_semi")
