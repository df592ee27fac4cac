"""Equi-join with the known hot keys of the big side salted.

Adaptive execution already splits skewed partitions of an inner or left join
whose left side is the skewed one, so the plain join is the default. A caller
that maintains a hot-key table (say, users with millions of followers) may pass
it: rows of a hot key are spread over ``buckets`` salts by a hash of the row and
the other side's rows of hot keys are repeated once per salt. The salt is a pure
function of the row, so a lost task recomputes the same assignment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKETS = 32
#: Rows of a task where the partitions follow the rows.
TASK_ROWS = 200_000


def partitions_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """As many partitions as ``df`` needs for about ``rows`` rows each, one per core at least.

    Counts ``df``, so it should be a table read from files. Adaptive execution
    leaves a partition count that is asked for as it is, so what a task sorts
    or hashes does not grow with the table.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def hot_keys(df: DataFrame, on, min_rows: int) -> DataFrame:
    """All keys with at least ``min_rows`` rows: what a hot-key table is built from."""
    on = [on] if isinstance(on, str) else list(on)
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows).select(*on)


def skew_join(left: DataFrame, right: DataFrame, on, how: str = "left", hot: DataFrame | None = None,
              buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``left.join(right, on, how)``; keys listed in ``hot`` (key columns only) are salted.

    ``how`` is ``inner`` or ``left`` (the left side is the one split).
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("skew_join splits the left side; use how='inner' or 'left'")
    if hot is None or buckets <= 1:
        return left.join(right, on, how)
    hot = hot.select(*on).distinct().withColumn("_hot", F.lit(True))
    # the salt hashes the whole row (map columns cannot be hashed and are
    # skipped); exact duplicate rows share a salt, distinct rows spread
    hashable = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    row_hash = F.xxhash64(*[F.col(c) for c in hashable])
    l2 = (left.join(hot, on, "left")
          .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0)))
          .drop("_hot"))
    r2 = (right.join(hot, on, "left")
          .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1)))
                                         .otherwise(F.array(F.lit(0)))))
          .drop("_hot"))
    return l2.join(r2, on + ["_salt"], how).drop("_salt")
