"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton of all items' normalised words is built once on the driver and
broadcast: it is linear in the items' words, which are checked against
``MAX_WORDS`` first. Each task streams its documents' words through it; after
each word the automaton gives the length of the longest match that ends there.
A match of at least ``window`` words marks its words; so does a whole item of
fewer words. Words that no item has end every match, so the automaton only
runs over stretches of item words.
"""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import small

WINDOW = 10
#: Most item words for which the automaton is broadcast: in every Python worker it takes some 900 bytes a word (measured:
#: 179 MB for 200,000 words of varied text), so at most 360 MB.
MAX_WORDS = 400_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes that end words become spaces, A-Z become small; all bytes of characters from U+0080 on belong to words.
TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def words(text: str | None) -> list[bytes]:
    """The matches of ``WORD`` in UTF-8, A-Z lower-cased."""
    return text.encode().translate(TABLE).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over numbered words, with the items whose windows end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = [name for name, _ in items]
        seqs = [[self.vocab.setdefault(w, len(self.vocab)) for w in ws] for _, ws in items]
        for seq in seqs:
            last = 0
            for c in seq:
                last = self.extend(last, c)
        #: for a state of at least ``window`` words, the state of its suffix of that many
        self.top = list(range(len(self.link)))
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[self.link[v]] >= window:
                self.top[v] = self.top[self.link[v]]
        #: items with a window of this many words that ends in the state; the states and lengths of whole short items
        self.full: dict[int, set[int]] = {}
        self.short: dict[int, dict[int, set[int]]] = {}
        for k, seq in enumerate(seqs):
            state, n = 0, 0
            for c in seq:
                state, n = self.step(state, n, c)
                if n >= window:
                    self.full.setdefault(self.top[state], set()).add(k)
            if 0 < len(seq) < window:
                self.short.setdefault(state, {}).setdefault(len(seq), set()).add(k)
        self.least = min([window, *(len(s) for s in seqs if s)])
        #: the next state up the links that holds a short item's end, or -1
        self.up = [-1] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            p = self.link[v]
            self.up[v] = p if p in self.short else self.up[p]

    def extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self.clone(last, c, q)
        new = self.new(self.length[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.clone(p, c, q)
        return new

    def new(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def clone(self, p: int, c: int, q: int) -> int:
        """Splits the strings of ``q`` that ``p`` reaches with ``c`` off into a state of their own."""
        twin = self.new(self.length[p] + 1, dict(self.next[q]))
        self.link[twin] = self.link[q]
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def step(self, state: int, n: int, c: int) -> tuple[int, int]:
        """The state and length of the longest match that ends with word ``c``."""
        while c not in self.next[state]:
            if not state:
                return 0, 0
            state = self.link[state]
            n = self.length[state]
        return self.next[state][c], n + 1

    def hits(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Marked spans of word positions (ascending, apart) and the items they come from; -1 is a word of no item."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        array = np.array(ids, np.int64)
        known = np.flatnonzero(np.diff(np.concatenate([[False], array >= 0, [False]]).astype(np.int8)))
        starts, ends = known[::2], known[1::2]
        long = ends - starts >= self.least
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            state = n = 0
            for i in range(a, b):
                state, n = self.step(state, n, ids[i])
                mark = 0
                if n >= self.window:
                    mark = n
                    items |= self.full.get(self.top[state], set())
                if self.short:
                    v = state if state in self.short else self.up[state]
                    while v > 0:
                        for size, who in self.short[v].items():
                            if size <= n:
                                mark = max(mark, size)
                                items |= who
                        v = self.up[v]
                if mark:
                    begin = i + 1 - mark
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, i + 1))
        return spans, items

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        if len(ws) < self.least:
            return [], []
        ids = list(map(self.vocab.get, ws, repeat(-1)))
        spans, items = self.hits(ids)
        return spans, sorted(self.names[k] for k in items)


def automaton(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text"):
    """The broadcast automaton. Items with a null text or without words have no window; a null id is written as empty text.

    Raises ValueError for more than ``MAX_WORDS`` words; the words are counted before anything is gathered.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    n = items.agg(F.sum(F.regexp_count("text", F.lit(WORD.pattern)))).first()[0] or 0
    if n > MAX_WORDS:
        raise ValueError(f"{n} benchmark words; the automaton is broadcast up to {MAX_WORDS}: split the benchmark")
    rows = sorted((r.item, r.text or "") for r in items.distinct().collect())
    return benchmark.sparkSession.sparkContext.broadcast(SuffixAutomaton([(i, words(t)) for i, t in rows], window))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row.

    Null texts have no words. Repeated rows give repeated results; items that
    repeat an id count once. An empty benchmark contaminates nothing.
    """
    shared = automaton(benchmark, window)

    def work(batches):
        sam = shared.value
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text in b.column(1).to_pylist():
                ws = words(text)
                spans, items = sam.scan(ws)
                items = sorted(set(items))
                for column, x in zip(out, (len(ws), sum(e - a for a, e in spans), len(items), hashlib.sha256(",".join(items).encode()).hexdigest())):
                    column.append(x)
            yield pa.record_batch([b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()),
                                   pa.array([h > 0 for h in out[1]], pa.bool_())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(work, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words in ``spans`` and what lies between them."""
    at = [m.span() for m in WORD.finditer(text)]
    kept, last = [], 0
    for a, e in spans:
        kept.append(text[last:at[a][0]])
        last = at[e - 1][1]
    return "".join([*kept, text[last:]])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without marked words; documents of which more than ``coverage`` of the words is marked go.

    Texts without marked words, null ones included, stay as they are.
    """
    shared = automaton(benchmark, window)
    at = docs.columns.index(text_col)

    def work(batches):
        sam = shared.value
        for b in small(batches):
            texts, keep = b.column(at).to_pylist(), []
            for k, text in enumerate(texts):
                ws = words(text)
                spans, _ = sam.scan(ws)
                keep.append(sum(e - a for a, e in spans) <= coverage * len(ws))
                if spans:
                    texts[k] = cut(text, spans)
            columns = [*b.columns[:at], pa.array(texts, pa.string()), *b.columns[at + 1:]]
            yield pa.record_batch(columns, b.schema.names).filter(pa.array(keep, pa.bool_()))

    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(work, docs.withColumn(text_col, F.col(text_col).cast("string")).schema)
