"""Sinks: snapshot writes, keyed upsert, rejects, topic messages.

The reference wrote one row at a time from the driver into a keyed store.
Here every write is a distributed DataFrame write; the keyed upsert is a
join over the whole table and the result is written as a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, partition_by=(), fmt: str = "parquet",
                   mode: str = "overwrite") -> None:
    """Create-or-replace a table snapshot (partition columns become folders)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_edges(edges: DataFrame, path: str) -> None:
    """The canonical edge table, one folder per year part so that a year label
    prunes partitions when the table is read back."""
    write_snapshot(edges, path, partition_by=("part",))


def upsert(existing: DataFrame, new: DataFrame, key) -> DataFrame:
    """Keyed upsert: rows of ``new`` replace rows of ``existing`` with the same
    key; other existing rows stay. Applying it twice gives the same table.

    ``new`` must hold one row per key (dedupe with merge_sources first).
    The anti join shuffles both sides on the key once; when ``new`` is a small
    batch AQE turns it into a broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = existing.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new.select(*existing.columns))


class RejectedRows(ValueError):
    """Raised by :func:`enforce_rejects` in ``fail`` mode."""


def enforce_rejects(rejects: DataFrame, mode: str = "skip") -> None:
    """Reject policy before a write: ``skip`` keeps going (the rejects table is
    the report), ``fail`` stops the job when any row was rejected. The check is
    one bounded action (is there at least one row), not a count or a collect."""
    if mode not in ("skip", "fail"):
        raise ValueError("mode must be 'skip' or 'fail'")
    if mode == "fail" and not rejects.isEmpty():
        raise RejectedRows("rows were rejected; see the rejects table (reason, raw)")


def to_messages(df: DataFrame, topic, key: str | None = None, value_cols=None,
                timestamp: str | None = None) -> DataFrame:
    """Rows as topic messages ``(topic, key, value[, timestamp])``.

    ``topic`` is a name or a Column (a topic per row); ``value`` is the row
    (or ``value_cols``) as JSON; ``timestamp`` names a column to carry as the
    message time.
    """
    cols = [(topic if isinstance(topic, Column) else F.lit(topic)).alias("topic")]
    cols.append(F.col(key).cast("string").alias("key") if key else F.lit(None).cast("string").alias("key"))
    vals = list(value_cols) if value_cols else list(df.columns)
    cols.append(F.to_json(F.struct(*[F.col(c) for c in vals])).alias("value"))
    if timestamp:
        cols.append(F.col(timestamp).cast("timestamp").alias("timestamp"))
    return df.select(*cols)


def write_messages(messages: DataFrame, fmt: str = "json", path: str | None = None,
                   options: dict | None = None, mode: str = "append") -> None:
    """Write messages to a sink. With the ``kafka`` package on the classpath use
    ``fmt="kafka"`` and bootstrap options; otherwise files (one JSON per line)."""
    w = messages.write.format(fmt).mode(mode).options(**(options or {}))
    if path is not None:
        w.save(path)
    else:
        w.save()
