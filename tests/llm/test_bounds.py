"""Memory bounds: tables of words, and the automaton of the benchmark."""

import random
import time

import public_tokenizers as P
import pytest
import sentencepiece
from egoline.llm import common, sentencepiece_chunks, token_count, token_files
from egoline.llm.decontaminate import SuffixAutomaton, words


@pytest.fixture
def tight(monkeypatch):
    monkeypatch.setattr(common, "TABLE_BYTES", 3_000)
    monkeypatch.setattr(common, "LONGEST", 40)


TEXTS = ["漢字" * 900, "a" * 5000 + " b", "word " * 50 + "x" * 300, "ﬁne ｆｕｌｌ odd\u00a0space ﬁne", "", "Zeile\nZeile " * 30,
         *[f"w{i} v{i * 7} ﬁ{i}" for i in range(200)]]


def test_tables_keep_no_long_words_and_start_anew(tight):
    t = common.Table()
    t.keep("x" * 41, 1)
    assert not t
    for i in range(1000):
        t.keep(f"word{i}", i)
        assert t.used <= 3_000 and len(t) < 30


def test_sentencepiece_with_a_full_table(tight):
    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    t = sentencepiece_chunks.ChunkTable(model)
    for text in TEXTS * 2:
        ids = sp.encode(text)
        assert t.both(text) == (",".join(map(str, ids)), sp.decode(ids))
    assert t.used <= 3_000 and t.plain.used <= 3_000


def test_byte_tokenizers_with_a_full_table(tight):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library, counter, encoder = Tokenizer.from_file(path), token_count.Counter(path), token_files.Encoder(path)
    for text in TEXTS * 2:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == b"".join(i.to_bytes(2, "little") for i in ids)
        assert counter.count(text) == len(ids)
    assert max(len(w) for w in [*counter, *counter.words, *encoder, *encoder.words]) <= 40
    assert counter.used <= 3_000 and encoder.words.used <= 3_000


def test_item_of_one_repeated_word_is_linear():
    def seconds(n):
        began = time.perf_counter()
        sam = SuffixAutomaton([("a", [b"la"] * n), ("b", [b"la"] * 3)], 10)
        spans, items = sam.scan([b"la"] * n)
        assert spans == [(0, n)] and items == ["a", "b"]
        return time.perf_counter() - began
    seconds(1000)
    assert seconds(100_000) < 30 * max(seconds(10_000), 0.02)
    assert SuffixAutomaton([("a", words("x y z " * 4))], 10).scan(words("q x y z x y z x y z x q")) == ([(1, 11)], ["a"])


def test_words_that_are_asked_for_outlive_a_full_table(monkeypatch):
    monkeypatch.setattr(common, "TABLE_BYTES", 20_000)
    encoder, asked = token_files.Encoder(P.path("byte_bpe_50k.json")), []
    plain = encoder.pre_token
    encoder.pre_token = lambda text: asked.append(text) or plain(text)
    for i in range(3_000):
        word = "".join(chr(97 + i // 26**k % 26) for k in range(4))
        assert encoder.encode(f"a hot {word}") == encoder.ids(f"a hot {word}")
    assert asked.count(" hot") == 1 and len(encoder) + len(encoder.old) < 200
    assert encoder.used <= 20_000


def test_marks_after_letters_need_no_whole_tokenizer():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library, encoder, rng = Tokenizer.from_file(path), token_files.Encoder(path), random.Random(3)
    bits = ["a", "word", "é", "日本", "ǅ", " ", "\n", "'s", "'", "1", "<|endoftext|>", "<|", "|>", "%%%", "###", *token_files.MARKS]
    for _ in range(3_000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert encoder.encode(text) == b"".join(i.to_bytes(2, "little") for i in library.encode(text, add_special_tokens=False).ids), repr(text)
    whole, encoder.ids = encoder.ids, None
    assert encoder["thhaed,%%%"] == whole(" thhaed,%%%") and encoder["é_***"] == whole(" é_***")
