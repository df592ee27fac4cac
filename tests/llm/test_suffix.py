import random
from collections import Counter

import brute
import numpy as np
import pytest
from egoline.llm import induced, suffix_dedup


def by_definition(rows, length=200):
    """Every 200-byte string counted; positions judged on the input."""
    count = Counter()
    for _, t in rows:
        data = (t or "").encode()
        count.update(data[i:i + length] for i in range(len(data) - length + 1))
    out = []
    for doc, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if count[data[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, brute.sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=str)


def got(d, **options):
    return sorted((tuple(r) for r in suffix_dedup.remove_repeats(d, **options).collect()), key=str)


def test_suffix_order_against_sorting(monkeypatch):
    rng = random.Random(3)
    for kept, block in ((4 << 20, 1 << 19), (16, 3)):
        monkeypatch.setattr(induced, "KEPT", kept)
        monkeypatch.setattr(induced, "BLOCK", block)
        for _ in range(150):
            k = rng.choice([1, 2, 3, 20])
            s = [rng.randint(1, k) for _ in range(rng.randint(0, 60))] + [0]
            order = np.concatenate(list(induced.suffix_order(np.array(s, np.uint16), k + 1, len(s))))
            assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_windows_and_hashes():
    x = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64)
    assert suffix_dedup.least_in_windows(x, 7).tolist() == [min(x[i:i + 7]) for i in range(294)]
    h, data = suffix_dedup.Hasher(), b"abcab" * 100
    sums = h.sums(np.frombuffer(data, np.uint8))
    one = h.stretch(sums, np.array([0, 5, 1]), np.array([64, 69, 65]))
    assert one[0] == one[1] != one[2]


def corpus(seed, chars="abcdefgh \né😀", n=25):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choices(chars, k=k))
    shared = [text(rng.choice([90, 190, 199, 200, 201, 230, 400, 900])) for _ in range(6)]
    texts = [None, "", "short", "é" * 100, "é" * 101, "x" * 199, "x" * 200, "y" * 201, "ab" * 700]
    for _ in range(n):
        parts = [rng.choice([text(rng.randint(0, 300)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 60):]]) for _ in range(rng.randint(1, 4))]
        texts.append("".join(parts))
    texts += [texts[-1], texts[-2], texts[-2]]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[-1]), (None, texts[-5]), (3, texts[-1])]


@pytest.mark.parametrize("seed,hot", [(1, suffix_dedup.HOT), (2, 1), (3, 3), (4, 0)])
def test_against_definition(table, seed, hot):
    rows = corpus(seed)
    d = table([(*r, "clash", 1) for r in rows], "doc_id long, text string, found string, ref int").repartition(3)
    assert got(d, hot=hot) == by_definition(rows)


def test_no_shard_holds_a_passage_with_many_surroundings(table, monkeypatch):
    rng = random.Random(9)
    text = lambda k: "".join(rng.choices("abcdefghijklmnop ", k=k))
    passage = text(420)
    rows = [(i, text(60) + passage + text(60)) for i in range(60)]

    def watched(batches, shard, sort=suffix_dedup.sorted_shards):
        def counted():
            seen = Counter()
            for b in batches:
                seen.update(b.column("g").to_pylist())
                assert max(seen.values()) <= 8, "a group of a shard grows with the documents"
                yield b
        yield from sort(counted(), shard)

    monkeypatch.setattr(suffix_dedup, "sorted_shards", watched)
    assert got(table(rows), hot=8) == by_definition(rows)


def test_periodic_texts(table):
    rows = [(1, "a" * 1000), (2, "a" * 300), (3, "ab" * 400), (4, "abc" * 300 + "z" + "abc" * 80), (5, "q" * 250 + "r")]
    assert got(table(rows)) == got(table(rows), hot=0) == by_definition(rows)


def test_chunks_of_long_texts(table, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 150)
    rows = corpus(6, n=15)
    out = []
    h = suffix_dedup.Hasher()
    for _, t in rows:
        data = (t or "").encode()
        key, ctx, first, end, place = suffix_dedup.anchors(h, data)
        starts = [s for a, e in zip(first, end) for s in range(a, e)]
        assert starts == list(range(max(0, len(data) - 199)))
        assert all(a - p <= 0 <= 136 - (p - (e - 1)) + 200 for a, e, p in zip(first, end, place))
        out.append(len(first))
    assert sum(out)


def test_small_shards_and_tables(docs, plain, table):
    rows = sorted(plain.items())[:60]
    d = docs.filter(docs.doc_id.isin([i for i, _ in rows]))
    assert got(d, shard=3000) == by_definition(rows)
    assert got(table([(1, "a")]).limit(0)) == []


def test_shards_are_sorted_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    rows = [(i // 4, i // 4, i, 1, 0, rng.randbytes(336)) for i in range(13_000)]  # 4 MB in groups of four
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 4 + [pa.int32(), pa.binary()])]
    batch = pa.record_batch(columns, ["g", "key", "ctx", "m", "off", "bytes"])
    tracemalloc.start()
    found = list(suffix_dedup.sorted_shards(iter([batch]), suffix_dedup.SHARD))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) > 1 and sum(b.num_rows for b in found) == 0
    assert peak < 120 << 20
