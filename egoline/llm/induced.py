"""Suffix sorting by induction with queues that go to disk.

The text is a sequence of symbols; its suffixes are typed S or L by comparison
with the next suffix, and the leftmost S ones (LMS) induce the order of all
others: buckets are scanned in order of their symbol, and each suffix sends the
one before it to the queue of its own symbol. A bucket is read in blocks, so
that the work inside is vectorised; a queue keeps ``KEPT`` bytes in memory and
is an anonymous file of the task beyond that, which is gone when the task ends.
LMS substrings are sorted by the same induction, named, and the names' order is
refined by doubling as far as ``depth`` symbols reach.
"""

from __future__ import annotations

from tempfile import SpooledTemporaryFile

import numpy as np

#: Bytes of a queue that stay in memory, and positions read from it at a time.
KEPT, BLOCK = 4 << 20, 1 << 19


class Queue:
    """First in, first out positions; what is added while it is read comes last."""

    def __init__(self):
        self.file = None
        self.size = self.taken = 0

    def add(self, positions: np.ndarray) -> None:
        if len(positions):
            if self.file is None:
                self.file = SpooledTemporaryFile(max_size=KEPT)
            self.file.seek(self.size)
            self.file.write(positions.astype(np.int64, copy=False).tobytes())
            self.size += 8 * len(positions)

    def blocks(self):
        while self.taken < self.size:
            yield self.block(self.taken, min(self.taken + 8 * BLOCK, self.size))

    def block(self, first: int, end: int) -> np.ndarray:
        self.file.seek(first)
        self.taken = max(self.taken, end)
        return np.frombuffer(self.file.read(end - first), np.int64)

    def all(self) -> np.ndarray:
        return self.block(0, self.size) if self.size else np.zeros(0, np.int64)

    def backwards(self):
        """Blocks from the last to the first, each reversed."""
        end = self.size
        while end:
            first = max(0, end - 8 * BLOCK)
            yield self.block(first, end)[::-1]
            end = first


def types(s: np.ndarray) -> np.ndarray:
    """True for S: the next different symbol is greater; the last symbol (the only smallest one) is S."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])
    nearest = np.searchsorted(differs, np.arange(n - 1))
    at = differs[np.minimum(nearest, len(differs) - 1)] if len(differs) else np.zeros(n - 1, np.int64)
    return np.append(s[at + 1] > s[at], True)


def send(queues: list[Queue], s: np.ndarray, positions: np.ndarray) -> None:
    """Each position to the queue of its symbol, in the given order."""
    if not len(positions):
        return
    symbols = s[positions]
    order = np.argsort(symbols, kind="stable")
    symbols, positions = symbols[order], positions[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(positions)]):
        queues[symbols[first]].add(positions[first:end])


def induce(s: np.ndarray, small: np.ndarray, symbols: int, seeds: np.ndarray) -> tuple[list[Queue], list[Queue]]:
    """Per symbol the L suffixes in ascending and the S suffixes in descending order, from LMS ``seeds`` sorted in their buckets."""
    larger = [Queue() for _ in range(symbols)]
    seeded = [Queue() for _ in range(symbols)]
    send(seeded, s, seeds)
    for c in range(symbols):
        for queue in (larger[c], seeded[c]):
            for block in queue.blocks():
                before = block[block > 0] - 1
                send(larger, s, before[~small[before]])
    lower = [Queue() for _ in range(symbols)]
    lower[s[-1]].add(np.array([len(s) - 1]))
    for c in range(symbols - 1, -1, -1):
        for block in lower[c].blocks():
            before = block[block > 0] - 1
            send(lower, s, before[small[before]])
        for block in larger[c].backwards():
            before = block[block > 0] - 1
            send(lower, s, before[small[before]])
    return larger, lower


def named(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in text order: equal for equal ones, ascending with their order."""
    end = np.append(lms[1:] + 1, len(s))
    place = np.searchsorted(lms, ordered)
    size = (end - lms)[place]
    same = np.zeros(len(ordered), bool)
    same[1:] = size[1:] == size[:-1]
    pairs = np.flatnonzero(same)
    for part in np.array_split(pairs, max(1, int(size[pairs].sum()) // (4 * BLOCK) + 1)):
        if len(part):
            each = size[part]
            first = np.concatenate([[0], np.cumsum(each)[:-1]])
            step = np.arange(int(each.sum())) - np.repeat(first, each)
            equal = s[np.repeat(ordered[part], each) + step] == s[np.repeat(ordered[part - 1], each) + step]
            same[part] = np.logical_and.reduceat(equal, first)
    names = np.empty(len(lms), np.int64)
    names[place] = np.cumsum(~same) - 1
    return names


def refined(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names`` by their first ``depth`` or more names.

    A rank is the place of the first of equals; only suffixes that still have
    equals are sorted again, by the rank ``k`` names further on.
    """
    n, k = len(names), 1
    order = np.argsort(names, kind="stable")
    rank = np.empty(n, np.int64)
    tied, place = order, np.arange(n)
    new = np.concatenate([[True], names[order][1:] != names[order][:-1]])[:n]
    while n:
        first = place[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        rank[tied] = first
        alone = new & np.append(new[1:], True)
        tied, place = tied[~alone], place[~alone]
        if k >= depth or not len(tied):
            break
        one, two = rank[tied], np.where(tied + k < n, rank[np.minimum(tied + k, n - 1)], -1)
        again = np.lexsort((two, one))  # ranks ascend with places, so each group is sorted in its own places
        tied, one, two = tied[again], one[again], two[again]
        order[place] = tied
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        k *= 2
    return order


def suffix_order(s: np.ndarray, symbols: int, depth: int):
    """Blocks of positions in suffix order, exact in the first ``depth`` symbols.

    ``s`` ends with its only 0. The blocks come bucket by bucket.
    """
    small = types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    _, lower = induce(s, small, symbols, lms)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    parts = []
    for queue in lower:
        found = queue.all()[::-1]
        parts.append(found[is_lms[found]])
    ordered = np.concatenate(parts) if parts else lms
    # the next LMS position is two symbols on at least, so half as many names reach ``depth`` symbols
    order = refined(named(s, lms, ordered), depth // 2 + 1)
    larger, lower = induce(s, small, symbols, lms[order])
    for up, down in zip(larger, lower):
        if up.size:
            yield up.all()
        if down.size:
            yield down.all()[::-1]
