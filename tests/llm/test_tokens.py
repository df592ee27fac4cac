import random

import brute
import numpy as np
import public_tokenizers as P
import pytest
from egoline.llm import common, sentencepiece_chunks, token_count, token_files
from egoline.session import shared_path

BITS = ["a", "b", " ", "  ", "\n", "\t", "　", "1", "23", "'s", "'", "<|endoftext|>", "<|endoftext", "é", "日本", "😀",
        "\x1c", "\x85", "the", "!!", "_", "▁", "\x00", ".", "�", "ǅ", "٣", "́", "<s>", "<0x0A>", "x" * 40]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 25))) for _ in range(n)] + ["", "z" * 50_000, "ab1" * 9_000, "word " * 20_000, "\n" * 5_000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_transducer_counts_as_the_library(library, monkeypatch):
    c = token_count.Counter(P.path("byte_bpe_50k.json"))
    for size in (5, 64, token_count.PIECE):
        monkeypatch.setattr(token_count, "PIECE", size)
        for text in odd_texts(1500, size):
            if len(text) < 2000 or size > 64:
                assert c.count(text) == len(library(text)), repr(text[:80])


def test_state_maps_compose_in_any_grouping(library):
    c, rng = token_count.Counter(P.path("byte_bpe_50k.json")), random.Random(8)
    for text in odd_texts(300, 9)[:300]:
        cuts = sorted(rng.choices(range(len(text) + 1), k=4))
        maps = [c.piece(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        while len(maps) > 1:
            i = rng.randrange(len(maps) - 1)
            maps[i:i + 2] = [c.compose(maps[i], maps[i + 1])]
        assert c.total(maps[0]) == len(library(text))


def test_transducer_starts_anew_beyond_its_bound(library, monkeypatch):
    monkeypatch.setattr(token_count, "STATES", 50)
    monkeypatch.setattr(common, "TABLE_BYTES", 4_000)
    c = token_count.Counter(P.path("byte_bpe_50k.json"))
    assert [c.count(t) for t in odd_texts(200, 3)[:200]] == [len(library(t)) for t in odd_texts(200, 3)[:200]]


def test_token_count_rows(docs, plain, table, library):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.token_counts(docs, P.path("byte_bpe_50k.json")).collect()}
    assert got == {i: (len(t.encode()), len(library(t)), len(library(t)) > 512) for i, t in plain.items()}
    d = table([(1, None, "x"), (1, None, "x"), (None, "a b", "y")], "doc_id long, text string, n_tokens string")
    assert sorted(tuple(r) for r in token_count.token_counts(d.filter("doc_id is not null"), P.path("byte_bpe_50k.json")).collect()) == [(1, 0, 0, False)] * 2
    assert token_count.token_counts(d, P.path("byte_bpe_50k.json")).count() == 3
    assert token_count.token_counts(d.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_sentencepiece_as_the_library(docs, plain, table, monkeypatch):
    import sentencepiece
    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)

    def want(text):
        ids = sp.encode(text or "")
        return len(ids), brute.sha(",".join(map(str, ids))), brute.sha(sp.decode(ids) if ids else "")

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_chunks.digests(docs, model).collect()}
    assert got == {i: want(t) for i, t in plain.items()}
    texts = [*odd_texts(1500, 5), None, None]
    d = table([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_chunks.digests(d, model).collect()}
    assert got == {i: want(t) for i, t in enumerate(texts)}
    monkeypatch.setattr(common, "TABLE_BYTES", 4_000)
    t = sentencepiece_chunks.ChunkTable(model)
    assert all(t.both(x) == (",".join(map(str, sp.encode(x))), sp.decode(sp.encode(x)) if x else "") for x in odd_texts(300, 6)[:300])
    coded = sentencepiece_chunks.decode(sentencepiece_chunks.encode(d, model), model)
    assert all(r.ids == sp.encode(r.text or "") and r.decoded == (sp.decode(r.ids) if r.ids else "") for r in coded.collect())
    assert sentencepiece_chunks.encode(d.limit(0), model).count() == 0


def test_elias_fano_round_trip():
    rng = random.Random(4)
    for _ in range(200):
        v = sorted(rng.randint(0, rng.choice([3, 1000, 10**12, 2**62])) for _ in range(rng.randint(0, 700)))
        e = token_files.EliasFano.from_bytes(token_files.EliasFano.of(np.array(v, np.uint64)).to_bytes())
        assert e.values().tolist() == v
        assert all(e.select(k) == v[k] for k in rng.sample(range(len(v)), min(len(v), 20)))
        with pytest.raises(IndexError):
            e.select(len(v))


def files(spark, d, **options):
    path = shared_path(spark, "test-token-files")
    token_files.write(d, path, P.path("byte_bpe_50k.json"), end_id=2, **options)
    return [tuple(r) for r in token_files.read(spark, path).collect()]


def test_token_files(spark, docs, plain, table, library):
    import zlib
    want, start = [], 0
    for i in sorted(plain):
        ids = [*library(plain[i]), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(files(spark, docs.repartition(5), block_ids=2000)) == want
    d = table([(None, "a", 1), (None, None, 1), (-5, "b c", 1), (7, "", 1), (7, "x", 1), (2**62, "y", 1)], "doc_id long, text string, start int")
    got = sorted(files(spark, d), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, -5, 7, 7, 2**62] and [r[2] for r in got] == [1, 2, 3, 1, 2, 2]
    assert [r[1] for r in got] == [0, 1, 3, 6, 7, 9]
    assert files(spark, d.limit(0)) == []
