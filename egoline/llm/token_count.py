"""Token counts by a compiled finite-state transducer.

``Transducer`` is a deterministic transducer over the byte alphabet of a
byte-level BPE tokenizer. After each byte of a pre-token BPE has exactly one
last token, and what follows depends only on the places from which a longer
token may still grow: their nodes in the vocabulary's trie, the last token
before each, and how many more tokens one place has than another. That is the
state; the tokens that became common to all places are the count on the
transition. States are compiled when first reached and numbered; a transition
that is compiled is one table look-up.

Two tokens may follow each other exactly if BPE of their joined text gives the
two of them back, and a token sequence is the tokenizer's own exactly if that
holds for each neighbouring pair.

A text is worked piece by piece. A piece's state map says what the piece does
to any state in which it may be entered: before its first sure cut (a space
after a visible character, where every pre-token ends whatever came before) the
text waits for its entry state, from there to the last sure cut the count is
known, and the rest waits for what follows. Maps compose associatively, and
``scan`` combines the pieces of a text in rounds of doubling distance.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import Table

#: Characters of a piece; states after which the transducer starts anew.
PIECE, STATES = 1 << 14, 400_000
NEVER = 1 << 60
SURE = re.compile(r"(?<=\S) ")
#: Other white space before a space: there the space is no sure cut.
BEFORE = ("  ", "\n ", "\t ", "\r ", "\v ", "\f ")
WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ")
ENDS = frozenset(".,;:!?")


def sure_parts(text: str) -> list[str]:
    """``text`` cut at its sure cuts, whose spaces are left out; a piece's leading space is none."""
    if text[:1] == " " or any(p in text for p in BEFORE) or not text.isascii() and WIDE.search(text):
        return SURE.split(text)
    return text.split(" ")


class Transducer:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.made = {a + b: (k, a, b) for (a, b), k in reversed(self.rank.items())}
        self.spines: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.child: dict[tuple[int, str], int] = {}
        self.token: list[str | None] = [None]
        self.grows: list[bool] = [False]
        for t in vocab:
            node = 0
            for c in t:
                self.grows[node] = True
                if (node, c) not in self.child:
                    self.child[node, c] = len(self.token)
                    self.token.append(None)
                    self.grows.append(False)
                node = self.child[node, c]
            self.token[node] = t
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self):
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.last: list[int] = []
        self.pairs.clear()
        self.state(((0, "", 0),))

    def state(self, key: tuple) -> int:
        k = self.number.get(key)
        if k is None:
            k = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            self.last.append(next(n for node, _, n in key if node == 0))
        return k

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """From the outermost byte on one side of ``token`` up to the token: each part, and the rank at which it is merged on."""
        key = (token, side)
        kept = self.spines.get(key)
        if kept is None:
            kept, merged = [], NEVER
            while True:
                kept.append((token, merged))
                if token not in self.made:
                    break
                merged, token = self.made[token][0], self.made[token][1 + side]
            kept.reverse()
            self.spines[key] = kept
        return kept

    def follows(self, a: str, b: str) -> bool:
        """BPE of the joined text leaves the two tokens as they are.

        A merge comes after those of its parts, so the parts at the border
        grow in order of rank; the two tokens stay apart unless a merge across
        the border is due before either part is merged inwards. Of equal
        merges the leftmost comes first.
        """
        ok = self.pairs.get((a, b))
        if ok is not None:
            return ok
        ok = self.whole(b)
        if ok and a:
            left, right, i, j = self.spine(a, 1), self.spine(b, 0), 0, 0
            while True:
                (x, x_on), (y, y_on) = left[i], right[j]
                across = self.rank.get((x, y), NEVER)
                if across < x_on and across <= y_on:
                    ok = False
                    break
                if x_on == y_on == NEVER:
                    break
                if x_on <= y_on:
                    i += 1
                else:
                    j += 1
        self.pairs[a, b] = ok
        return ok

    def whole(self, token: str) -> bool:
        """The tokenizer can give this token at all: its two parts would be merged."""
        ok = self.pairs.get(("", token))
        if ok is None:
            ok = True
            if len(token) > 1:
                ok = token in self.made and self.bpe(token) == [token]
            self.pairs["", token] = ok
        return ok

    def bpe(self, text: str) -> list[str]:
        """Merges in order of rank, for the few symbols of one token."""
        parts = list(text)
        while len(parts) > 1:
            rank, at = min((self.rank.get(pair, NEVER), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compile(self, k: int, c: str) -> tuple[int, int]:
        """The transition from state ``k`` under ``c``: next state and emitted tokens."""
        grown, found = [], None
        for node, last, n in self.states[k]:
            to = self.child.get((node, c))
            if to is None:
                continue
            t = self.token[to]
            if t is not None and found is None and self.follows(last, t):
                found = (0, t, n + 1)
            if self.grows[to]:
                grown.append((to, last, n))
        if found is None:
            raise ValueError(f"no token ends in {c!r}: not a byte-level vocabulary")
        grown.append(found)
        emitted = min(n for _, _, n in grown)
        out = (self.state(tuple((node, t, n - emitted) for node, t, n in grown)), emitted)
        self.steps[k][c] = out
        return out

    def count(self, symbols: str) -> int:
        """Tokens of one pre-token, written in the byte alphabet."""
        if len(self.states) > STATES:
            self.reset()
        k = total = 0
        for c in symbols:
            k, emitted = self.steps[k].get(c) or self.compile(k, c)
            total += emitted
        return total + self.last[k] if symbols else 0


def byte_alphabet() -> dict[int, str]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


class StateMap(NamedTuple):
    """What a piece does to its entry state; ``tail`` is None where the piece has no sure cut."""

    head: str
    count: int
    tail: str | None


class Counter(Table):
    """Marked word (without its space) -> tokens: paths of the transducer from a sure cut to the next."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.machine = Transducer(spec["model"]["vocab"], pairs)
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.to_symbols = byte_alphabet()
        self.words = Table()

    def pre_token(self, text: str) -> int:
        n = self.words.get(text)
        if n is None:
            n = self.machine.count(text.encode().decode("latin-1").translate(self.to_symbols))
            self.words.keep(text, n)
        return n

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings: the library's own automaton cuts pre-tokens where it is not plain."""
        return sum(self.machine.count(symbols) for symbols, _ in self.pre.pre_tokenize_str(text)) if text else 0

    def text(self, text: str) -> int:
        if self.split and (n := len(self.split.findall(text))):
            return n + sum(map(self.plain, self.split.split(text)))
        return self.plain(text)

    def simple(self, word: str, lead: str) -> int | None:
        """Tokens of a word of letters, perhaps with one mark at its end; None for any other."""
        if word.isalpha():
            return self.pre_token(lead + word)
        if word[-1:] in ENDS and word[:-1].isalpha():
            return self.pre_token(lead + word[:-1]) + self.pre_token(word[-1])
        return None

    def __missing__(self, word: str) -> int:
        n = self.simple(word, " ")
        if n is None:
            # the last word of a line and the first of the next: the line's end is a pre-token of its own
            last, end, first = word.partition("\n")
            if end and (a := self.simple(last, " ")) is not None and (b := self.simple(first, "")) is not None:
                return a + self.pre_token("\n") + b
            n = self.text(" " + word)
        return self.keep(word, n)

    def piece(self, text: str) -> StateMap:
        parts = sure_parts(text)
        if len(parts) == 1:
            return StateMap(text, 0, None)
        return StateMap(parts[0], sum(map(self.__getitem__, parts[1:-1])), " " + parts[-1])

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """First ``a``, then ``b``."""
        if a.tail is None:
            joined = self.piece(a.head + b.head)  # a cut may lie where the two meet
            if joined.tail is None:
                return StateMap(joined.head, b.count, b.tail)
            if b.tail is None:
                return joined
            return StateMap(joined.head, joined.count + self.text(joined.tail) + b.count, b.tail)
        between = a.tail + b.head
        if b.tail is None:
            return StateMap(a.head, a.count, between)
        return StateMap(a.head, a.count + self.text(between) + b.count, b.tail)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """Inclusive prefixes of ``maps`` under composition, by doubling distances."""
        step = 1
        while step < len(maps):
            maps = [self.compose(maps[i - step], m) if i >= step else m for i, m in enumerate(maps)]
            step *= 2
        return maps

    def total(self, m: StateMap) -> int:
        """The tokens of a whole text: its map entered at the beginning and left at the end."""
        return self.text(m.head) + m.count + (self.text(m.tail) if m.tail is not None else 0)

    def count(self, text: str) -> int:
        pieces = [self.piece(text[i:i + PIECE]) for i in range(0, len(text), PIECE)]
        return self.total(self.scan(pieces)[-1]) if pieces else 0


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker process and tokenizer; later tasks of the process find its tables filled."""
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row, for a byte-level BPE tokenizer file.

    Null texts count as empty (no tokens). Special strings inside texts are
    special tokens, as the library has it by default. Repeated rows give
    repeated results, an empty table an empty one; other columns are ignored.
    """
    def work(batches):
        c = counter(tokenizer)
        for b in batches:
            n = pa.array([c.count(t or "") for t in b.column(1).to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.record_batch([b.column(0), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
