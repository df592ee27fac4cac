"""Sharding by minimax contiguous partition (DataFrame functions only).

Documents are ordered by the 64-bit hash of their text, so equal texts are
neighbours. Texts whose hashes share the top ``UNIT_BITS`` bits form one atomic
unit; a unit is never cut, hence equal texts always meet in one shard. At most
2**UNIT_BITS unit sizes (a fixed bound, whatever the table holds) reach the
driver, which binary-searches the smallest shard capacity for which the ordered
units fit greedily into the wanted number of shards, and cuts there. Among the
cuts within that capacity each shard is closed as near as it can to the mean of
what is left, so one huge group of copies does not leave other shards empty.

Slots come from the position in one global range sort: a partition's row number
plus the rows of the shard in earlier partitions. The sort key ends with the
document id, so the copies of one text spread over many tasks.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from egoline.llm.common import id_text, written

UNIT_BITS = 16


def needed(prefix: list[int], start: int, capacity: int, limit: int) -> int:
    """Shards that a greedy fill from unit ``start`` takes, counted up to ``limit + 1``."""
    n, i, end = 0, start, len(prefix) - 1
    while i < end and n <= limit:
        i = bisect_right(prefix, prefix[i] + capacity) - 1
        n += 1
    return n


def minimax_cuts(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """``(capacity, ends)``: the smallest capacity, and the exclusive end of each shard.

    ``ends`` has ``shards`` entries; trailing shards are empty when there are
    fewer units than shards.
    """
    if not sizes:
        return 0, [0] * shards
    prefix = [0, *accumulate(sizes)]
    lo, hi = max(max(sizes), -(-prefix[-1] // shards)), prefix[-1]
    while lo < hi:
        mid = (lo + hi) // 2
        if needed(prefix, 0, mid, shards) <= shards:
            hi = mid
        else:
            lo = mid + 1
    ends, at = [], 0
    for k in range(shards):
        left = shards - k
        last = bisect_right(prefix, prefix[at] + lo) - 1  # the greedy cut is always feasible
        if left > 1 and at < len(sizes):
            want = prefix[at] + (prefix[-1] - prefix[at]) / left
            near = bisect_right(prefix, want) - 1
            if near < last and want - prefix[near] > prefix[near + 1] - want:
                near += 1
            cut = min(last, max(near, at + 1))
            while cut < last and needed(prefix, cut, lo, left - 1) > left - 1:
                cut += 1
            last = cut
        ends.append(last)
        at = last
    return lo, ends


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``.

    Size is the UTF-8 bytes of the text (null: none) plus 1; the law is
    ``bytes``. Null and empty texts are one group. Repeated rows and repeated
    ids are separate rows with slots of their own. An empty table gives an
    empty result. Columns other than the id and the text are ignored.
    """
    d = id_text(docs, id_col, text_col)
    slim = d.select("doc_id", (F.octet_length("text") + F.lit(1)).cast("long").alias("size"),
                    F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("h"))
    order = ["h", "doc_id", "size"]
    rows = written(slim.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("pos", F.monotonically_increasing_id())
                   .withColumn("unit", F.shiftright("h", 64 - UNIT_BITS)).drop("h"), "shards")
    units = sorted(tuple(r) for r in rows.groupBy("unit").agg(F.sum("size")).collect())  # at most 2**UNIT_BITS rows
    _, ends = minimax_cuts([size for _, size in units], shards)
    firsts = [units[e][0] if e < len(units) else 1 << UNIT_BITS for e in ends[:-1]]
    shard = F.lit(0)
    for first in firsts:
        shard = shard + (F.col("unit") >= F.lit(first)).cast("int")
    rows = rows.withColumn("shard", shard).withColumn("part", F.shiftright("pos", 33))
    # one row per partition and shard; a partition holds a contiguous range, so at
    # most partitions + shards rows: small enough to broadcast at any input size
    runs = rows.groupBy("part", "shard").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "shard", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (rows.join(F.broadcast(runs), ["part", "shard"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                    (F.col("pos") - F.col("first") + F.col("offset")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
