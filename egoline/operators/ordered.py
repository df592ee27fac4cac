"""Order inside a key without a group per key.

Rows are range-sorted by key and order, so a key with a third of all rows lies
over many partitions. What comes before a row of the same key is the sum inside
its partition plus that of the key's earlier partitions; only a partition's first
key has any, so these offsets are one row per partition at most. The rows are stored
and counted first, and every exchange of them has partitions that follow their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from egoline.operators.skew import partitions_for
from egoline.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its row order and values are fixed."""
    path = shared_path(df.sparkSession, "ordered", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def preceded(rows: DataFrame, keys, order, weight: str | None = None, name: str = "before") -> DataFrame:
    """``rows`` with ``name``: the weight (rows where none is named) of the rows of the
    same key that come earlier in ``order``.

    Key and order columns together should tell rows apart: rows that agree in all of
    them come in any order, each with a place of its own. Null keys are a key.
    """
    return _preceded(rows, keys, order, weight, name)[0]


def _preceded(rows: DataFrame, keys, order, weight: str | None, name: str) -> tuple[DataFrame, int]:
    """:func:`preceded` and the number of partitions it lies in."""
    keys, order = list(keys), list(order)
    by = [*keys, *[o for o in order if o not in keys]]
    w = F.lit(1) if weight is None else F.col(weight)
    rows = stored(rows, "rows")
    n = partitions_for(rows)
    placed = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("_part", F.shiftright("_at", 33).cast("int")).withColumn("_w", w.cast("long")).withColumn("_key", F.struct(*keys)), "placed")
    last = placed.groupBy("_part").agg(F.max("_at").alias("_last"))  # of numbers: a minimum of keys would sort all rows
    ends = (placed.join(F.broadcast(last), "_part").filter("_at = _last OR _at % 8589934592 = 0")  # a partition's first row has number 0
            .select("_part", "_key").distinct())  # two rows per partition at most
    of_ends = placed.join(F.broadcast(ends), ["_part", "_key"]).groupBy("_part", "_key").agg(F.sum("_w").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # at most a row per partition
    offsets = of_ends.withColumn("_offset", F.sum("_n").over(earlier)).filter("_offset IS NOT NULL").select("_part", "_key", "_offset")
    inside = Window.partitionBy("_part", "_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    here = placed.repartitionById(n, "_part").withColumn("_in", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    here = here.join(F.broadcast(offsets.withColumnsRenamed({"_part": "_p", "_key": "_k"})),
                     (F.col("_part") == F.col("_p")) & (F.col("_key") == F.col("_k")), "left")
    return here.select(*rows.columns, (F.col("_in") + F.coalesce("_offset", F.lit(0))).alias(name)), n


def segments(rows: DataFrame, keys, order, entry, size: int = 10_000) -> DataFrame:
    """``(*keys, segment, entries)``: each key's rows in ``order`` as arrays of ``entry``
    (a Column) with at most ``size`` entries, numbered from 0.

    The long form is canonical; a segment is the largest cell there is, whatever a
    key holds. Concatenating a key's segments gives its whole list.
    """
    place, n = _preceded(rows, keys, order, None, "_place")
    cut = place.select(*keys, F.floor(F.col("_place") / size).cast("long").alias("segment"), F.col("_place"), entry.alias("_e"))
    grouped = cut.repartition(n, *keys, "segment").groupBy(*keys, "segment").agg(F.array_sort(F.collect_list(F.struct("_place", "_e"))).alias("_l"))
    return grouped.select(*keys, "segment", F.transform("_l", lambda x: x["_e"]).alias("entries"))
