"""Readers for the timeline, landed topics, user dumps and keyed tables.

All readers take an explicit schema, so the scan never runs an inference
pass and Catalyst can prune columns and push filters into it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from egoline import schemas
from egoline.functions.constants import REJECTS
from egoline.sources.snapshots import DATA, current, listed, read_version


def read_timeline(spark: SparkSession, path, schema: T.StructType = schemas.TIMELINE_READ,
                  repartition: int | None = None) -> DataFrame:
    """Scan JSON-lines timeline files (plain or gzip; the codec is picked from
    the file suffix) with one all-string schema covering every variant.

    Malformed lines are kept in ``_corrupt_record`` (PERMISSIVE mode) so they can
    go to the rejects table instead of failing the job. Gzip files do not split;
    with many hourly files pass ``repartition`` to spread the rows after the scan.
    """
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", schemas.CORRUPT_COL)
          .json(path))
    if repartition:
        df = df.repartition(repartition)
    return df


def read_topic(spark: SparkSession, root: str, topic: str | None = None,
               schema: T.StructType | None = None, since=None, until=None) -> DataFrame:
    """Scan topic messages landed under ``topic=/year=/month=/day=/hour=``.

    Partition columns are discovered from the folder names, so a filter on
    ``topic`` or on the hour range prunes whole folders before any file opens.
    ``schema`` parses the message value; without it the raw JSON text is kept.
    Messages that could not be placed are only read by their own topic.
    """
    df = spark.read.option("basePath", root).json(root, schema=_landed_schema()).select(*_landed_schema().names)
    df = df.filter(F.col("topic") == topic if topic is not None else F.col("topic") != REJECTS)
    hour_key = (F.col("year") * 1000000 + F.col("month") * 10000
                + F.col("day") * 100 + F.col("hour"))
    if since is not None:
        df = df.filter(hour_key >= _hour_key(since))
    if until is not None:
        df = df.filter(hour_key < _hour_key(until))
    if schema is not None:
        df = df.select("*", F.from_json("value", schema).alias("msg")).select("*", "msg.*").drop("msg")
    return df


def _landed_schema() -> T.StructType:
    return T.StructType([
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
    ])


def _hour_key(t) -> int:
    return t.year * 1000000 + t.month * 10000 + t.day * 100 + t.hour


def _file_numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    names = [s.getPath().getName() for s in listed(spark, path)]
    found = (re.fullmatch(re.escape(prefix) + r"(\d+)(\.[a-z0-9]+)*", n) for n in names)
    return sorted({int(m[1]) for m in found if m})


def read_user_dumps(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None,
                    prefix: str = "users", array_files: bool = True, split: bool = False) -> DataFrame:
    """Scan user dumps: files named ``<prefix><N>``, each one JSON array of users
    (``array_files``) or JSON lines. ``lo``/``hi`` keep files whose numeric suffix
    lies in the inclusive range, as the scraper selected its share of files.
    With ``split``, array files are read in many splits (``sources.arrays``)
    instead of one task each.

    Returns ``(login, id, file_no)``.
    """
    if array_files and split:
        from egoline.sources.arrays import read_json_arrays
        numbers = [n for n in _file_numbers(spark, path, prefix) if (lo is None or n >= lo) and (hi is None or n <= hi)]
        if not numbers:
            return spark.createDataFrame([], T.StructType([*schemas.USER.fields, T.StructField("file_no", T.LongType())]))
        names = ",".join(f"{prefix}{n}{{,.*}}" for n in numbers)
        df = read_json_arrays(spark, path, schemas.USER, f"{{{names}}}")
        return df.select(*schemas.USER.names, F.regexp_extract("file_name", prefix + r"(\d+)", 1).cast("long").alias("file_no"))
    r = spark.read.schema(schemas.USER).option("pathGlobFilter", f"{prefix}*")
    if array_files:
        r = r.option("multiLine", True)
    df = r.json(path)
    # the file's name is metadata: a filter on it drops whole files before they are opened
    file_no = F.regexp_extract(F.col("_metadata.file_name"), prefix + r"(\d+)(\.[a-z0-9]+)*$", 1)
    df = df.withColumn("file_no", F.when(file_no != "", file_no.cast("long")))
    if lo is not None:
        df = df.filter(F.col("file_no") >= lo)
    if hi is not None:
        df = df.filter(F.col("file_no") <= hi)
    return df


def read_edges(spark: SparkSession, path: str, label: str | None = None) -> DataFrame:
    """The edge table (a committed one, or plain files under ``part=`` folders); a
    year ``label`` becomes a partition filter, so only that label's folders are
    listed and read."""
    from egoline.operators.edges import parts_for_label, select_parts
    version = current(spark, path)
    if version is None:
        return select_parts(spark.read.schema(schemas.EDGE).parquet(path), label)
    where = {"part": parts_for_label(label)} if label is not None else None
    return read_version(spark, path, version, "edges", where).select(*schemas.EDGE.names)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", table: str = DATA, where: dict | None = None) -> DataFrame:
    """A keyed table: its committed version (``where``: of these partition values
    only), or the files at ``path`` where it was written as plain files."""
    version = current(spark, path)
    return spark.read.format(fmt).load(path) if version is None else read_version(spark, path, version, table, where)
