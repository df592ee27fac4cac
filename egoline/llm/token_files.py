"""Token-id files: a concatenated id array with Elias-Fano encoded document boundaries.

A file set is one Parquet file per sorted range of document ids (a shard),
written by Spark's committer, so a lost task leaves nothing behind. Its rows
are blocks: the ids of consecutive documents, end ids included, as one array of
little-endian integers (16 bits where the vocabulary allows, else 32), and two
Elias-Fano sequences, the documents' ends in that array and their document ids.
``EliasFano.select`` finds one boundary from the upper bits' directory; no
table of 64-bit offsets is stored.

Documents are range-partitioned by id before they are encoded, so text is
shuffled once and ids never are. A document's place in the whole corpus is its
shard's offset plus its block's plus its own; only one row per shard is summed
up to find the first.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from operator import itemgetter
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from egoline.llm.common import Aging
from egoline.llm.token_count import byte_alphabet, sure_parts

#: Ids in a block.
BLOCK = 1 << 20
#: Marks that end a word: a run of them after letters is a pre-token of its own (an apostrophe may begin one with letters).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
FILE = "shard int, block int, first long, n_docs long, n_ids long, width int, n_null long, base long, doc_ids binary, ends binary, ids binary"


class EliasFano:
    """A non-decreasing sequence of integers from 0 on: ``low_bits`` of each value plainly, the rest in unary.

    ``EVERY`` ones lie between two entries of the directory that ``select``
    starts from; it is derived from the bits when first needed.
    """

    EVERY = 256

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.directory: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shift = np.uint64(low_bits)
        upper = (values >> shift).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(upper[-1]) + 1, np.uint8)
        bits[upper] = 1
        low = b""
        if low_bits:
            below = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)[None, :]) & np.uint64(1)
            low = np.packbits(below.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little").tobytes())

    def to_bytes(self) -> bytes:
        return np.array([self.n, self.low_bits, len(self.low)], "<i8").tobytes() + self.low + self.high

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, size = (int(x) for x in np.frombuffer(data, "<i8", 3))
        return cls(n, low_bits, data[24:24 + size], data[24 + size:])

    def values(self) -> np.ndarray:
        """The whole sequence."""
        if not self.n:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[:self.n * self.low_bits]
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out += (bits.reshape(self.n, self.low_bits) * weights).sum(axis=1, dtype=np.uint64)
        return out

    def select(self, k: int) -> int:
        """The ``k``-th value alone, from the directory entry before it."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        high = np.frombuffer(self.high, np.uint8)
        if self.directory is None:
            counts = np.cumsum(np.bitwise_count(high), dtype=np.int64)
            self.directory = np.searchsorted(counts, np.arange(0, self.n, self.EVERY) + 1)  # bytes that hold every EVERY-th one
        at = int(self.directory[k // self.EVERY])
        last = int(self.directory[k // self.EVERY + 1]) if k // self.EVERY + 1 < len(self.directory) else len(high) - 1
        window = np.unpackbits(high[at:last + 1], bitorder="little")
        ones = np.flatnonzero(window)
        before = int(np.bitwise_count(high[:at]).sum()) if at else 0
        one = at * 8 + int(ones[k - before])
        low = 0
        for b in range(self.low_bits):
            i = k * self.low_bits + b
            low |= (self.low[i >> 3] >> (i & 7) & 1) << b
        return (one - k) << self.low_bits | low


class Encoder(Aging):
    """Marked word (without its space) -> its ids as bytes, from the library.

    ``words`` holds pre-tokens without a space before them: marks, and the first words of lines.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(0.75)
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.model, self.symbols = self.tokenizer.model, byte_alphabet()
        self.code = "H" if self.kind == "<u2" else "I"
        self.words = Aging(0.25)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # no special string may lie in a word of letters and marks
        self.marks = MARKS if not any(t.rstrip(MARKS).isalpha() or not t.rstrip(MARKS) for t in added) else ""

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def pre_token(self, text: str) -> bytes:
        """One pre-token: the library's model alone gives its ids."""
        symbols = "Ġ" + text[1:] if text[0] == " " and text.isascii() else text.encode().decode("latin-1").translate(self.symbols)
        ids = [t.id for t in self.model.tokenize(symbols)]
        return pack(f"<{len(ids)}{self.code}", *ids)

    def word(self, text: str) -> bytes:
        got = self.words.get(text)
        if got is None:
            got = self.words.keep(text, self.words.old.get(text) or self.pre_token(text))
        return got

    def plain(self, word: str, lead: str) -> bytes | None:
        """The ids of a word of letters, perhaps with marks at its end; None for any other."""
        letters = word.rstrip(self.marks)
        if not letters.isalpha():
            return None
        ids = self[letters] if lead else self.word(letters)
        return ids if len(letters) == len(word) else ids + self.word(word[len(letters):])

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            if word.isalpha():
                got = self.pre_token(" " + word)
            elif (got := self.plain(word, " ")) is None:
                # the last word of a line and the first of the next: the line's end is a pre-token of its own
                last, end, first = word.partition("\n")
                if end and (a := self.plain(last, " ")) is not None and (b := self.plain(first, "")) is not None:
                    return a + self.word("\n") + b
                got = self.ids(" " + word)
        return self.keep(word, got)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text: cut only where a pre-token ends whatever surrounds it."""
        first, *rest = sure_parts(text)
        return self.ids(first) + b"".join(itemgetter(*rest, "")(self)[:-1] if rest else ()) if text else b""


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer; later tasks of the process find its table filled."""
    return Encoder(path)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          block_ids: int = BLOCK) -> None:
    """Write the file set of ``docs``, in ascending order of id, below ``path``.

    Null texts count as empty and hold the end id alone. Null ids come first.
    Rows of one id stand together, by text.
    """
    def work(batches):
        enc, shard, block, first = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], enc.kind).tobytes()
        width = len(end)
        ids, parts, n_ids = [], [], 0

        def flush():
            nonlocal ids, parts, n_ids, block, first
            known = [i for i in ids if i is not None]
            base = known[0] if known else 0
            row = [shard, block, first, len(ids), n_ids, width, len(ids) - len(known), base,
                   EliasFano.of(np.array([i - base for i in known], np.uint64)).to_bytes(),
                   EliasFano.of(np.cumsum([len(p) // width for p in parts])).to_bytes(), b"".join(parts)]
            block, first = block + 1, first + n_ids
            ids, parts, n_ids = [], [], 0
            return pa.record_batch([pa.array([x], kind) for x, kind in zip(row, KINDS)], NAMES)

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = enc.encode(text or "") + end
                if ids and n_ids + len(got) // width > block_ids:
                    yield flush()
                ids.append(i)
                parts.append(got)
                n_ids += len(got) // width
        if ids:
            yield flush()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranged = slim.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(work, FILE).write.parquet(path)


NAMES = re.findall(r"(\w+) \w+", FILE)
KINDS = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t] for t in re.findall(r"\w+ (\w+)", FILE)]


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone."""
    blocks = spark.read.schema(FILE).parquet(path)
    # one row per shard, as many as the writer had partitions: summed up in one task and small enough to broadcast
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = blocks.join(F.broadcast(starts), "shard").select(
        (F.col("offset") + F.col("first")).alias("at"), "n_docs", "width", "n_null", "base", "doc_ids", "ends", "ids")

    def work(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], f"<u{r['width']}")
                ends = EliasFano.from_bytes(r["ends"]).values().astype(np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                known = [r["base"] + int(v) for v in EliasFano.from_bytes(r["doc_ids"]).values()]
                crc = [zlib.crc32(ids[a:e].astype("<u4").tobytes()) for a, e in zip(begins.tolist(), ends.tolist())]
                yield pa.record_batch([pa.array([None] * r["n_null"] + known, pa.int64()), pa.array(begins + r["at"], pa.int64()),
                                       pa.array(ends - begins, pa.int64()), pa.array(crc, pa.int64())],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")
