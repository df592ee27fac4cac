"""Removal of repeated byte strings by external induced suffix sorting.

A string of ``LENGTH`` bytes that starts at two places is removed at both. To
sort the suffixes of a corpus larger than any task, it is first cut into
contexts such that equal strings are always found in one shard:

1. Each window of ``LENGTH`` bytes has an anchor, its ``GRAM``-byte string of
   least hash (the first of equals). Equal windows have equal anchors at equal
   offsets. The windows of one anchor stand side by side; their bytes are the
   anchor's context.
2. Anchors are counted by key. A key that occurs once holds no repeated window.
   Contexts that repeat as a whole are repeated in all of their windows and
   count once from there on.
3. The distinct contexts of a key that has several meet in one shard, whose
   suffixes are sorted by induction (``induced``); neighbours in suffix order
   that begin windows and share ``LENGTH`` bytes are repeated. A key with more
   than ``HOT`` distinct contexts is split into bands of offsets and, in each, by
   the bytes that all windows of the band have in common. Where these bytes
   come with more than ``HOT`` surroundings too, the band's windows are counted
   one by one by a 128-bit hash, so that no shard holds a group that grows.
4. Each occurrence takes over the windows found in its context.

Only keys, hashes and positions are shuffled for all text; bytes are read
again only for documents that hold a distinct context or something to remove.
Everything between the steps is written to the shared folder.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from egoline.llm import induced
from egoline.llm.common import id_text, small, written
from egoline.llm.jaccard_join import MULTIPLY, U, mix

LENGTH, GRAM = 200, 64
#: Window starts hashed at a time; bytes of a shard (a key's contexts stay together; sorting takes some 40 bytes of memory for each); distinct contexts from which a key is split; width of a band.
CHUNK, SHARD, HOT, BAND = 1 << 19, 2 << 20, 2_000, 16
#: Most ids for which the rows to re-read are picked by a broadcast; beyond, by a shuffle.
PICKED = 1_000_000
POSITION = U((1 << 24) - 1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    for k in range(max(1, (n - 1).bit_length())):
        step = 1 << k
        out[step:2 * step] = out[:min(step, max(0, n - step))] * U(pow(base, step, 1 << 64))
    return out


class Hasher:
    """Sums of byte weights times powers: the hash of any stretch is a difference, shifted back."""

    def __init__(self):
        n, base = CHUNK + 2 * LENGTH, int(MULTIPLY[1])
        self.weight = mix(np.arange(1, 257, dtype=U) * MULTIPLY[2])
        self.up, self.down = powers(base, n), powers(pow(base, -1, 1 << 64), n)

    def sums(self, a: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, U), np.cumsum(self.weight[a] * self.up[:len(a)], dtype=U)])

    def stretch(self, sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[first]) * self.down[first]


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window: prefix and suffix minima of blocks of that width."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(U).max, U)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def anchors(h: Hasher, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per run of windows with one anchor: its key, its context's hash, first and end of the starts, and the anchor's place."""
    a = np.frombuffer(data, np.uint8)
    out: list[tuple] = []
    for base in range(0, len(a) - LENGTH + 1, CHUNK):
        seg = a[base:base + CHUNK + LENGTH - 1]
        n = len(seg) - LENGTH + 1
        sums = h.sums(seg)
        grams = len(seg) - GRAM + 1
        key = mix((sums[GRAM:] - sums[:-GRAM]) * h.down[:grams])
        at = (least_in_windows((key & ~POSITION) | np.arange(grams, dtype=U), LENGTH - GRAM + 1) & POSITION).astype(np.int64)
        change = np.flatnonzero(at[1:] != at[:-1]) + 1
        first, end = np.concatenate([[0], change]), np.append(change, n)
        place = at[first]
        size = (end - first).astype(U)
        context = mix(h.stretch(sums, first, end + LENGTH - 1) + mix(size * MULTIPLY[0] + (place - first).astype(U)))
        out.append((key[place], context, first + base, end + base, place + base))
    if not out:
        return tuple(np.zeros(0, U if k < 2 else np.int64) for k in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def profiled(batches):
    """A row per document with its runs; ``m``: how often the context occurs in the batch, at its first run, else 0."""
    h = Hasher()
    for b in batches:
        texts = [t.encode() for t in b.column("text").to_pylist()]
        runs = [anchors(h, t) for t in texts]
        sizes = np.array([len(r[0]) for r in runs], np.int64)
        key, context, first, end = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.int64) for k in range(4))
        _, at, count = np.unique(context, return_index=True, return_counts=True)
        m = np.zeros(len(context), np.int32)
        m[at] = count
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in
                 (key.astype(np.int64), context.astype(np.int64), first.astype(np.int32), end.astype(np.int32), m)]
        yield pa.record_batch([b.column("doc_id"), b.column("ref"), pa.array([len(t) for t in texts], pa.int64()),
                               pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), *lists],
                              ["doc_id", "ref", "n_bytes", "sha", "key", "ctx", "first", "end", "m"])


PROFILE = "doc_id long, ref long, n_bytes long, sha string, key array<long>, ctx array<long>, first array<int>, end array<int>, m array<int>"
PIECE = "g long, key long, ctx long, m long, off int, bytes binary"


def pieces(batches, hot: int):
    """The bytes of the wanted contexts: whole, or for hot keys one per band of offsets from the anchor."""
    from xxhash import xxh3_64_intdigest

    h = Hasher()
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for b in small(batches):
        rows: list[list] = [[] for _ in range(6)]
        for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
            data = text.encode()
            place = None
            for w in wanted:
                first, end = w["first"], w["end"]
                if w["n"] <= hot:
                    parts = [(w["key"], 0, data[first:end + LENGTH - 1])]
                else:
                    if place is None:
                        runs = anchors(h, data)
                        place = dict(zip(runs[2].tolist(), runs[4].tolist()))
                    parts = []
                    band = (place[first] - first) // BAND
                    while band >= 0 and (x := max(first, place[first] - band * BAND - BAND + 1)) < end:
                        y = min(end, place[first] - band * BAND + 1)
                        # bytes in every window of the band, whatever part of it this context has
                        core = data[place[first] - band * BAND:place[first] - band * BAND - BAND + 1 + LENGTH]
                        parts.append((signed(xxh3_64_intdigest(core, seed=(w["key"] + band) & (1 << 64) - 1)), x - first, data[x:y + LENGTH - 1]))
                        band -= 1
                for g, off, part in parts:
                    for column, x in zip(rows, (g, w["key"], w["ctx"], w["m"], off, part)):
                        column.append(x)
        yield pa.record_batch([*(pa.array(c, pa.int64()) for c in rows[:4]), pa.array(rows[4], pa.int32()), pa.array(rows[5], pa.binary())],
                              ["g", "key", "ctx", "m", "off", "bytes"])


WINDOW = "h binary, key long, ctx long, m long, off int"


def windows(batches):
    """A row per window of the pieces: its hash and its start in the context."""
    from xxhash import xxh3_128_digest

    for b in small(batches):
        rows: list[list] = [[] for _ in range(5)]
        for key, ctx, m, off, data in zip(*(b.column(c).to_pylist() for c in ("key", "ctx", "m", "off", "bytes"))):
            for i in range(len(data) - LENGTH + 1):
                for column, x in zip(rows, (xxh3_128_digest(data[i:i + LENGTH]), key, ctx, m, off + i)):
                    column.append(x)
        yield pa.record_batch([pa.array(rows[0], pa.binary()), *(pa.array(c, pa.int64()) for c in rows[1:4]), pa.array(rows[4], pa.int32())],
                              ["h", "key", "ctx", "m", "off"])


def repeated(strings: list[bytes]) -> list[np.ndarray]:
    """For distinct strings of at least ``LENGTH`` bytes: which of their windows occur elsewhere, as flags per start."""
    sizes = np.array([len(x) for x in strings], np.int64)
    s = np.empty(int(sizes.sum()) + len(strings) + 1, np.uint16)
    raw = np.frombuffer(b"".join(x + b"\0" for x in strings), np.uint8)
    s[:-1] = raw
    s[:-1] += 2
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    s[begins + sizes] = 1  # between strings
    s[-1] = 0
    real = np.zeros(len(s) + 1, np.int32)
    real[begins] += 1
    real[begins + sizes - LENGTH + 1] -= 1
    real = np.cumsum(real)[:-1] > 0
    flags = np.zeros(len(s), bool)
    last = None
    offsets = np.arange(LENGTH)
    for block in induced.suffix_order(s, 258, LENGTH):
        block = block[real[block]]
        if last is not None:
            block = np.concatenate([[last], block])
        # neighbours that agree in their last byte and in the middle are compared in full
        one, two = block[:-1], block[1:]
        near = np.flatnonzero((s[one + LENGTH - 1] == s[two + LENGTH - 1]) & (s[one + LENGTH // 2] == s[two + LENGTH // 2]) & (s[one] == s[two]))
        for part in np.array_split(near, len(near) // 20_000 + 1):
            same = (s[one[part][:, None] + offsets] == s[two[part][:, None] + offsets]).all(axis=1)
            flags[one[part][same]] = True
            flags[two[part][same]] = True
        last = block[-1] if len(block) else None
    return [flags[a:a + n - LENGTH + 1] for a, n in zip(begins.tolist(), sizes.tolist())]


def stretches(flags: np.ndarray) -> np.ndarray:
    """First and end of each run of true flags."""
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))


def sorted_shards(batches, shard: int):
    """Rows arrive sorted by group: shards are cut between groups, strings that repeat are sorted once."""
    group, size, rows = None, 0, []

    def flush():
        at: dict[tuple, int] = {}
        strings, times = [], []
        where = []
        for g, key, ctx, m, off, data in rows:
            k = at.get((g, data))
            if k is None:
                k = at[g, data] = len(strings)
                strings.append(data)
                times.append(0)
            times[k] += 1
            where.append(k)
        flags = repeated(strings)
        out: list[list] = [[], [], []]
        for (_, key, ctx, m, off, _), k in zip(rows, where):
            if m > 1:
                continue  # the whole context repeats; it was here for the others
            found = stretches(flags[k] if times[k] == 1 else np.ones(len(flags[k]), bool))
            if len(found):
                for column, x in zip(out, (key, ctx, (found + off).tolist())):
                    column.append(x)
        return pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32()))], ["key", "ctx", "found"])

    for b in small(batches):
        for row in zip(*(b.column(c).to_pylist() for c in ("g", "key", "ctx", "m", "off", "bytes"))):
            if row[0] != group and size >= shard:
                yield flush()
                size, rows = 0, []
            group = row[0]
            rows.append(row)
            size += len(row[5])
    if rows:
        yield flush()


def cut(batches):
    """The documents without their marked bytes; ``found`` holds first and end of repeated window starts."""
    for b in small(batches):
        out: list[list] = [[], [], []]
        for text, found in zip(b.column("text").to_pylist(), b.column("found").to_pylist()):
            data = text.encode()
            kept, at, removed, spans, last = [], 0, 0, 0, -1
            for a, e in sorted((x["a"], x["e"] + LENGTH - 1) for x in found):
                if a > last:
                    spans += 1
                    kept.append(data[at:a])
                    last = a
                removed += max(0, e - max(a, last))
                last = max(last, e)
                at = last
            kept.append(data[at:])
            for column, x in zip(out, (removed, spans, hashlib.sha256(b"".join(kept)).hexdigest())):
                column.append(x)
        yield pa.record_batch([b.column("ref"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                              ["ref", "removed", "spans", "kept"])


def of_documents(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (one per text) with the texts; only texts that are asked for are shuffled while their references can be broadcast."""
    rows = written(rows, "asked")
    picked = rows.select("ref")
    picked = F.broadcast(picked) if rows.count() <= PICKED else picked
    return docs.join(picked, "ref", "left_semi").dropDuplicates(["ref"]).join(rows, "ref")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    Null texts are empty. Rows that repeat are documents of their own, so all
    windows of such texts are removed. Texts of fewer than ``LENGTH`` bytes
    stay whole, long ones are taken whole. A null id is given back as null.
    Columns other than the id and the text are ignored, whatever their names. An
    empty table gives an empty result.
    """
    docs = id_text(docs, id_col, text_col).withColumn("ref", F.xxhash64("doc_id", "text"))
    profile = written(docs.mapInArrow(profiled, PROFILE), "anchors")
    runs = profile.select("ref", F.explode(F.arrays_zip("key", "ctx", "first", "end", "m")).alias("r")).select("ref", "r.*")
    # repeats inside a task's batches are combined already; one shuffle by key serves contexts and keys
    keyed = runs.filter("m > 0").repartition("key").groupBy("key", "ctx").agg(F.sum("m").alias("m"), F.min(F.struct("ref", "first", "end")).alias("at"))
    keyed = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    shared = written(keyed.filter("n > 1 or m > 1").select("key", "ctx", "m", "n", "at.*"), "shared")
    def read(keys: DataFrame) -> DataFrame:
        wanted = keys.groupBy("ref").agg(F.collect_list(F.struct("key", "ctx", "m", "n", "first", "end")).alias("wanted"))
        return of_documents(docs, wanted).select("text", "wanted").mapInArrow(partial(pieces, hot=hot), PIECE)

    bands = written(read(shared.filter((F.col("n") > 1) & (F.col("n") > hot))), "bands")
    crowded = written(bands.groupBy("g").count().filter(F.col("count") > hot).select("g"), "crowded")
    crowded = F.broadcast(crowded) if crowded.count() <= PICKED else crowded
    parts = read(shared.filter((F.col("n") > 1) & (F.col("n") <= hot))).unionByName(bands.join(crowded, "g", "left_anti"))
    found = parts.repartition("g").sortWithinPartitions("g").mapInArrow(partial(sorted_shards, shard=shard), "key long, ctx long, found array<int>")
    single = written(bands.join(crowded, "g", "left_semi").select("key", "ctx", "m", "off", "bytes").mapInArrow(windows, WINDOW), "windows")
    # written first: an aggregate by the same key in the same stage would keep a common window's rows on the left in one task
    twice = written(single.groupBy("h").count().filter("count > 1").select("h"), "twice")
    single = single.filter("m = 1").join(twice, "h").select("key", "ctx", F.array(F.col("off"), F.col("off") + 1).alias("found"))
    found = found.unionByName(single)
    found = found.groupBy("key", "ctx").agg(F.flatten(F.collect_list("found")).alias("found"))
    whole = shared.filter("m > 1").select("key", "ctx", F.array(F.lit(0), F.col("end") - F.col("first")).alias("found"))
    marks = written(found.unionByName(whole), "marks")
    hits = runs.select("ref", "key", "ctx", "first").join(marks, ["key", "ctx"])
    hits = hits.select("ref", "first", F.posexplode("found").alias("k", "x"), "found").filter("k % 2 = 0")
    hits = hits.groupBy("ref").agg(F.collect_set(F.struct((F.col("first") + F.col("x")).alias("a"), (F.col("first") + F.get("found", F.col("k") + 1)).alias("e"))).alias("found"))
    cuts = of_documents(docs, hits).select("ref", "text", "found").mapInArrow(cut, "ref long, removed long, spans long, kept string")
    rows = profile.select("ref", "doc_id", "n_bytes", "sha").join(cuts, "ref", "left")
    return rows.select("doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).alias("n_removed"),
                       F.coalesce("spans", F.lit(0)).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"))
