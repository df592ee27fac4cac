"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the model holds a whitespace marker after another character
(checked when the model is loaded), so no piece crosses from a word into the
marker of the next: a text falls apart into marked words that the library
segments independently. Each task segments a distinct marked word once, keeps
the ids in a table, and joins them back by position. The library's dummy prefix
stands for the marker, hence ``encode(word)`` is the segmentation of the marked
word, and its ``decode`` takes the marker off again.

The table is bounded by bytes (``common.Table``), so texts without spaces, which
are one long word each, are segmented and not kept. Texts are cut and joined
whole, rows are independent, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import Table, small

MARKS = " ▁"
#: Where a marker follows another character and something follows the marker.
CUT = re.compile(f"(?<=[^{MARKS}])[{MARKS}](?=.)", re.DOTALL)


class ChunkTable(Table):
    """Marked word -> its ids as text; ``plain`` holds what the ids decode to."""

    def __init__(self, model: str):
        import sentencepiece

        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.plain = Table()
        self.lost = False  # whether some word met is not in the table
        pieces = map(self.sp.id_to_piece, range(self.sp.get_piece_size()))
        self.whole = any(re.search("[^▁]▁", p) for p in pieces)

    def __missing__(self, word: str) -> str:
        before, ids = len(self), self.sp.encode(word)
        text = self.keep(word, ",".join(map(str, ids)))
        plain = self.sp.decode(ids)
        if plain != word:
            self.plain.keep(word, plain)
        self.lost |= len(self) <= before
        return text

    def chunks(self, text: str) -> list[str]:
        """The marked words of ``text`` without their first marker."""
        if self.whole:  # pieces of this model may cross markers: the text is one chunk
            return [text]
        if "▁" in text or "  " in text or text[:1] == " " or text[-1:] == " ":
            return CUT.split(text)
        return text.split(" ")

    def encode(self, text: str) -> str:
        return ",".join([x for x in map(self.__getitem__, self.chunks(text)) if x])

    def both(self, text: str) -> tuple[str, str]:
        """``(ids as text, decoded text)``."""
        chunks = self.chunks(text)
        ids = ",".join([x for x in map(self.__getitem__, chunks) if x])
        if not self.plain and not self.lost:
            return ids, " ".join(chunks)
        return ids, " ".join([self.decoded(c) if c in self.plain or c not in self else c for c in chunks])

    def decoded(self, word: str) -> str:
        """Decoded anew where the tables have lost the word."""
        return self.plain[word] if word in self.plain else self.sp.decode(self.sp.encode(word))


@lru_cache(maxsize=2)
def table(model: str) -> ChunkTable:
    """One table per worker process and model; later tasks of the process find it filled."""
    return ChunkTable(model)


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row.

    Null texts count as empty: no ids, digests of the empty string. Repeated
    rows give repeated results, an empty table an empty one.
    """
    def work(batches):
        t = table(model)
        for b in small(batches):
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1).to_pylist():
                ids, plain = t.both(text or "")
                n.append(ids.count(",") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(plain.encode()).hexdigest())
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                  ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(batches, model: str, at: int, names: list[str]):
    """The batches with the ids of column ``at`` after them."""
    t = table(model)
    for b in small(batches, 256):
        ids = [np.array(e.split(","), np.int32) if (e := t.encode(text or "")) else [] for text in b.column(at).to_pylist()]
        yield pa.record_batch([*b.columns, pa.array(ids, pa.list_(pa.int32()))], names)


def _decoded(batches, model: str, at: int, names: list[str]):
    """The batches with the text of the ids of column ``at`` after them."""
    sp = table(model).sp
    for b in small(batches, 256):
        text = [sp.decode(x or []) if x else "" for x in b.column(at).to_pylist()]
        yield pa.record_batch([*b.columns, pa.array(text, pa.string())], names)


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text (null: none); an earlier column of that name gives way, so name another to keep it."""
    rest = [c for c in docs.columns if c != ids_col]
    work = partial(_encoded, model=model, at=rest.index(text_col), names=[*rest, ids_col])
    slim = docs.select(*rest)
    return slim.mapInArrow(work, slim.withColumn(ids_col, F.lit(None).cast("array<int>")).schema)


def decode(docs: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text that the library decodes from ``ids_col`` (null: empty)."""
    rest = [c for c in docs.columns if c != text_col]
    work = partial(_decoded, model=model, at=rest.index(ids_col), names=[*rest, text_col])
    slim = docs.select(*rest)
    return slim.mapInArrow(work, slim.withColumn(text_col, F.lit("")).schema)


def encode_decode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """:func:`decode` of :func:`encode`, both steps in one Python worker of a task: the ids
    go from one to the other in small batches, and a task does not hold two workers and
    a large batch of texts and ids between them."""
    rest = [c for c in docs.columns if c not in (ids_col, decoded_col)]
    names = [*rest, ids_col, decoded_col]

    def work(batches):
        return _decoded(_encoded(batches, model, rest.index(text_col), names[:-1]), model, len(rest), names)

    slim = docs.select(*rest)
    return slim.mapInArrow(work, slim.withColumn(ids_col, F.lit(None).cast("array<int>")).withColumn(decoded_col, F.lit("")).schema)
