"""Helpers shared by the operators: typed inputs and tables in the shared folder."""

from __future__ import annotations

from sys import getsizeof

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from egoline.session import shared_path

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null texts as empty ones; other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor re-reads the files instead of
    recomputing what was before. The folder is the deployment's scratch space.
    """
    path = shared_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes after which a worker's table of words starts anew, the longest word that it keeps, and what an entry costs beside its parts.
TABLE_BYTES, LONGEST, SLOT = 96 << 20, 256, 150


class Table(dict):
    """Word -> result, bounded by bytes: long words are not kept, and a full table starts anew."""

    used = 0

    def keep(self, word, value):
        n = len(word)
        if n <= LONGEST:
            self.used += 4 * n + getsizeof(value) + SLOT  # at most four bytes a character
            if self.used > TABLE_BYTES:
                self.clear()
                self.used = 0
            self[word] = value
        return value


class Aging(Table):
    """A table whose words live on while they are asked for: when its entries fill ``share``
    of the bytes they become the old ones, and a word found there is taken over. Old and
    new ones together hold twice the share at most."""

    def __init__(self, share: float = 0.5):
        super().__init__()
        self.old: dict = {}
        self.share = share

    def keep(self, word, value):
        n = len(word)
        if n <= LONGEST:
            self.used += 4 * n + getsizeof(value) + SLOT
            if self.used > TABLE_BYTES * self.share:
                self.old = dict(self)
                self.clear()
                self.used = 0
            self[word] = value
        return value


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(batches, rows: int = 512):
    """The batches in slices, so that a task holds few rows as Python objects at a time."""
    for b in batches:
        for first in range(0, b.num_rows, rows):
            yield b.slice(first, rows)
