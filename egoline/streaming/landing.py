"""Incremental topic landing with Structured Streaming.

Messages ``(topic, value, timestamp)`` are written as compressed JSON lines
under ``topic=/year=/month=/day=/hour=/batch=`` folders. The checkpoint remembers
the source offsets, so a second run over the same input adds nothing. A batch
overwrites its own ``batch=`` folders only, so one that died half-way and is
replayed leaves no duplicate. Allow and deny lists pick the topics.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from egoline import schemas
from egoline.functions.constants import REJECTS
from egoline.sources.snapshots import read_text

FOLDER = ("topic", "year", "month", "day", "hour")
#: Bytes of shuffled rows that a task writes at most, whatever the number of folders.
TASK_BYTES = 64 << 20


def topic_stream(spark: SparkSession, fmt: str = "json", path: str | None = None,
                 options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of ``(topic, value, timestamp)`` messages.

    ``fmt="kafka"`` needs the Kafka connector on the classpath and takes the
    usual ``kafka.bootstrap.servers`` / ``subscribePattern`` options; the file
    formats read envelopes already written as JSON lines.
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        df = r.load()
        return df.select(F.col("topic"), F.col("value").cast("string").alias("value"), F.col("timestamp"))
    r = r.schema(schemas.TOPIC_ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def write_batch(batch: DataFrame, out: str, name: str, compression: str = "gzip", task_bytes: int = TASK_BYTES) -> None:
    """Write one batch into its hour folders, replacing what an earlier attempt of the same name left.

    Rows are rebalanced by folder: cold hours share a task, which writes one
    file for each, and a hot hour is split over as many tasks as its bytes need.
    """
    conf = batch.sparkSession.conf  # the stream's own copy of the session
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(task_bytes))
    conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")  # many small files are written by several tasks
    conf.set("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    (batch.withColumn("batch", F.lit(name)).hint("rebalance", *[F.col(c) for c in FOLDER])
     .write.format("json").option("compression", compression).partitionBy(*FOLDER, "batch")
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").save(out))


def land_topics(stream: DataFrame, out: str, checkpoint: str, allow: str | None = None,
                deny=(), compression: str = "gzip", available_now: bool = True,
                processing_time: str | None = None, task_bytes: int = TASK_BYTES) -> StreamingQuery:
    """Land a message stream into hourly topic folders.

    ``allow`` is a regular expression over topic names (all when None);
    ``deny`` a list of names to drop. Hour folders come from the message
    timestamp in the session time zone (UTC by default). Messages without a
    topic or a readable timestamp have no folder: they go to the same tree under
    ``topic=_rejects`` with the hour zero of the year zero, and their value is
    the whole message. Within an hour, a micro-batch has a folder of its own,
    named by the stream's id and the batch's number.
    """
    s = stream
    if allow is not None:
        s = s.filter(F.coalesce(F.col("topic").rlike(allow), F.lit(True)))
    if deny:
        s = s.filter(F.coalesce(~F.col("topic").isin(list(deny)), F.lit(True)))
    good = F.col("topic").isNotNull() & F.col("timestamp").isNotNull()
    part = lambda f: F.when(good, f("timestamp")).otherwise(0)
    s = s.select(F.when(good, F.col("topic")).otherwise(REJECTS).alias("topic"),
                 F.when(good, F.col("value")).otherwise(F.to_json(F.struct("topic", "value"))).alias("value"), "timestamp",
                 part(F.year).alias("year"), part(F.month).alias("month"),
                 part(F.dayofmonth).alias("day"), part(F.hour).alias("hour"))

    def land(batch: DataFrame, number: int) -> None:
        stream_id = json.loads(read_text(batch.sparkSession, f"{checkpoint.rstrip('/')}/metadata").splitlines()[-1])["id"]
        write_batch(batch, out, f"{stream_id}-{number}", compression, task_bytes)
    w = s.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).outputMode("append")
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
