"""Hard negatives by full exact scores from subset-sum tables (the method of the Four Russians).

Vectors become integers. The query rows ("anchors") come in batches of bounded
bytes, each broadcast, and every batch is held against all rows in blocks:

* an anchor's components are cut into groups of eight; for each group a table
  gives the sum of every one of its 256 subsets;
* a row's components are cut into bit planes (two's complement) and each plane
  is packed, eight components to a byte;
* the bytes index the tables, the looked-up sums of a plane are added, and the
  planes are joined by shift and add from the sign plane down. This is the
  exact inner product.

A first pass finds each anchor's positives, a second one the negatives within
each positive's band of scores. A task keeps no more than the wanted number of
rows for each anchor or positive, so what is shuffled does not depend on how many
rows tie or share a label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from egoline.llm.common import written
from egoline.session import shared_path

#: Bytes of one broadcast batch of anchors (as 32-bit integers), anchors whose tables are in memory at a time, rows of a block.
BATCH_BYTES, ANCHORS, ROWS = 8 << 20, 256, 1024
FOUND = "anchor long, positive int, id long, score long"


def whole_numbers(x: np.ndarray) -> np.ndarray:
    whole = np.floor(256.0 * x.astype(np.float64))
    if len(whole) and np.abs(whole).max() >= 1 << 53:
        raise ValueError("scores of these vectors do not fit in 64 bits")
    return whole.astype(np.int64)


def matrix(column: pa.Array, scale=whole_numbers) -> np.ndarray:
    """A list column as integers, shorter vectors filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.diff(np.asarray(column.offsets))
    values = scale(np.asarray(column.flatten()))
    out = np.zeros((len(n), int(n.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = values
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def planes(rows: np.ndarray) -> np.ndarray:
    """``(plane, group, row)`` bytes: bit ``i`` of a byte is that plane's bit of the group's component ``i``; the last plane holds the signs."""
    bits = int(max(int(rows.max(initial=0)), ~int(rows.min(initial=0)))).bit_length() + 1
    return np.stack([np.packbits((rows >> k & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(bits)])


def tables(anchors: np.ndarray, kind) -> np.ndarray:
    """``(group, subset, anchor)``: the sum of each subset of eight components, by doubling."""
    groups = widened(anchors, -(-anchors.shape[1] // 8) * 8).astype(kind).T.reshape(-1, 8, len(anchors))
    out = np.zeros((len(groups), 256, len(anchors)), kind)
    for i in range(8):
        out[:, 1 << i:2 << i] = out[:, :1 << i] + groups[:, i, None]
    return out


def scores(packed: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``(row, anchor)`` inner products: lookups added within a plane, planes joined by shift and add."""
    out = np.zeros((packed.shape[2], table.shape[2]), table.dtype)
    for k in range(len(packed) - 1, -1, -1):
        out <<= 1
        for g in range(len(table)):
            out += table[g].take(packed[k, g], axis=0)
        if k == len(packed) - 1:
            np.negative(out, out=out)  # the sign plane counts negative
    return out


def kind_of(rows: np.ndarray, anchors: np.ndarray):
    """The integer type that holds every sum on the way."""
    size = lambda m: 2 << int(max(int(m.max(initial=0)), -int(m.min(initial=0)))).bit_length()
    most = size(rows) * size(anchors) * max(rows.shape[1], 1)
    if most >= 1 << 62:
        raise ValueError("scores of these vectors do not fit in 64 bits")
    return np.int32 if most < 1 << 31 else np.int64


class Best:
    """The first ``most`` rows by score, then id, for each of ``n`` slots."""

    def __init__(self, n: int, most: int):
        self.most = most
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)  # below this no row can enter

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.concatenate([[True], slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(first, np.arange(len(slot)), 0))
        kept = rank < self.most
        full = rank == self.most - 1
        self.least[slot[full]] = score[full]
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]


def blocks(batches):
    """``ids, labels, integers`` of at most ``ROWS`` rows at a time."""
    for b in batches:
        for first in range(0, b.num_rows, ROWS):
            part = b.slice(first, ROWS)
            yield np.asarray(part.column(0)), np.asarray(part.column(1)), matrix(part.column(2))


def positives_task(batches, labels: np.ndarray, anchors: np.ndarray, most: int):
    """Each anchor's best rows of its own label, itself among them."""
    best = Best(len(anchors), most)
    by_label = {int(x): np.flatnonzero(labels == x) for x in np.unique(labels)}
    for ids, row_labels, rows in blocks(batches):
        wide = max(rows.shape[1], anchors.shape[1])
        kind = kind_of(rows, anchors)
        for x in np.unique(row_labels):
            mine = by_label.get(int(x))
            if mine is None:
                continue
            here = np.flatnonzero(row_labels == x)
            packed = planes(widened(rows[here], wide))
            for at in range(0, len(mine), ANCHORS):
                who = mine[at:at + ANCHORS]
                s = scores(packed, tables(widened(anchors[who], wide), kind))
                r, a = np.nonzero(s >= best.least[who])
                best.add(who[a], s[r, a].astype(np.int64), ids[here][r])
    yield found(best.slot, np.zeros(len(best.slot), np.int32), best.id, best.score)


def negatives_task(batches, labels: np.ndarray, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, most: int):
    """For each anchor and positive the best rows of other labels whose score lies in its band (``low`` to ``high``, anchor by positive)."""
    n = low.shape[1]
    best = [Best(len(anchors), most) for _ in range(n)]
    for ids, row_labels, rows in blocks(batches):
        wide = max(rows.shape[1], anchors.shape[1])
        kind = kind_of(rows, anchors)
        packed = planes(widened(rows, wide))
        for at in range(0, len(anchors), ANCHORS):
            who = np.arange(at, min(at + ANCHORS, len(anchors)))
            s = scores(packed, tables(widened(anchors[who], wide), kind))
            other = row_labels[:, None] != labels[who]
            for j in range(n):
                r, a = np.nonzero((s >= np.maximum(low[who, j], best[j].least[who])) & (s <= high[who, j]) & other)
                best[j].add(who[a], s[r, a].astype(np.int64), ids[r])
    for j, b in enumerate(best):
        yield found(b.slot, np.full(len(b.slot), j, np.int32), b.id, b.score)


def found(anchor, positive, ids, score) -> pa.RecordBatch:
    return pa.record_batch([pa.array(anchor, pa.int64()), pa.array(positive, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
                           ["anchor", "positive", "id", "score"])


def first(df: DataFrame, most: int) -> DataFrame:
    """The tasks' best rows, reduced to the best of all; ``rank`` from 1."""
    w = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id, label, vector`` of the rows that take part."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(fine))


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``every`` divides; all rows are searched. A
    negative's score lies between ``low`` and ``high`` percent of the positive's.
    Rows with a null id, label, vector or component, or a component that is not
    finite, take no part. A shorter vector counts as filled up with zeros, an
    empty one scores 0. Repeated rows count each, also as anchors. Equal scores
    come in order of id. An empty table gives an empty result. Components so
    large that a score could leave 64 bits raise an error. Other columns are
    ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, F.col("label") if label is None else label)
    anchors = written(rows.filter(F.col("id") % every == 0).withColumn("at", F.monotonically_increasing_id()), "anchors")
    n, wide = anchors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    batches = -(-n * max(wide or 1, 1) * 4 // BATCH_BYTES)
    out = shared_path(spark, "llm", "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for k in range(batches):
        batch = anchors.filter(F.pmod(F.xxhash64("at"), F.lit(batches)) == k).select("id", "label", "vector").toArrow()
        if batch.num_rows:
            one_batch(rows, batch, positives, negatives, low, high).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def one_batch(rows: DataFrame, batch: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result for one batch of anchors, held against all rows."""
    spark = rows.sparkSession
    ids, labels, m = np.asarray(batch.column(0)), np.asarray(batch.column(1)), matrix(batch.column(2))
    shared = spark.sparkContext.broadcast((labels, m))
    near = first(rows.mapInArrow(lambda it: positives_task(it, *shared.value, positives + 1), FOUND), positives + 1).orderBy("anchor", "rank").toArrow()
    own = (m * m).sum(axis=1)
    # an anchor is not its own positive: one row with its id and its score with itself goes (another such row would read the same)
    taken: list[list[tuple[int, int]]] = [[] for _ in ids]
    dropped = np.zeros(len(ids), bool)
    for a, i, s in zip(*(near.column(c).to_pylist() for c in ("anchor", "id", "score"))):
        if not dropped[a] and i == ids[a] and s == own[a]:
            dropped[a] = True
        elif len(taken[a]) < positives:
            taken[a].append((i, s))
    flat = [(int(ids[a]), a, j, i, s) for a, got in enumerate(taken) for j, (i, s) in enumerate(got)]
    bottom, top = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)  # an empty band
    for _, a, j, _, s in flat:
        bottom[a, j], top[a, j] = -(-low * s // 100), high * s // 100
    bands = spark.sparkContext.broadcast((bottom, top))
    hard = first(rows.mapInArrow(lambda it: negatives_task(it, *shared.value, *bands.value, negatives), FOUND), negatives)
    named = spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*flat) if flat else [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                           ["anchor_id", "anchor", "positive", "positive_id", "positive_score"]))
    return (hard.join(F.broadcast(named), ["anchor", "positive"])  # at most the batch's anchors times the positives
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
