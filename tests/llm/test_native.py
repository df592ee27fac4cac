import random
from collections import Counter, defaultdict

import brute
from egoline.llm import pii, quality, sharding

ODD = ["", None, "   \n\t ", "word", "a b c " * 400 + "\nx y z", "ünïcode 😀 " * 60, "same line\nsame line\n \nsame line " + "w%d " % 3 * 70]


def test_quality_counts_match_brute_force(docs, plain):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs).collect()}
    assert got == {i: brute.quality(t) for i, t in plain.items()}


def test_quality_edge_rows(table):
    rows = [(i, t, None if i % 2 else "xx", None, 7, "clash") for i, t in enumerate(ODD)] + [(0, ODD[0], "xx", None, 7, "clash")]
    d = table(rows, "doc_id long, text string, lang string, source string, kept long, m0 string")
    got = quality.judge(d).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(ODD[r.doc_id] or "")
        assert r.kept == (not r.base_failed)
    assert quality.judge(d.limit(0)).count() == 0


def test_quality_rejects_outliers_and_keeps_clean(table):
    rng = random.Random(1)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    rows = [(i, text(rng.randint(60, 400)), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in text(100).split()), "en", "s") for i in range(20)]
    rows += [(2000 + i, text(100).upper() + "!!", "en", "s") for i in range(20)]
    kept = {r.doc_id for r in quality.judge(table(rows, "doc_id long, text string, lang string, source string")).collect() if r.kept}
    assert kept == set(range(300))


def test_quality_judges_small_groups_by_their_language_or_all(table):
    rng = random.Random(2)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    junk = lambda: " ".join(w + "$$$" for w in text(100).split())
    # ten sources of six, a language of three and a null one, each with a junk document; no group has thirty
    rows = [(i, text(rng.randint(60, 400)), "en", f"s{i % 10}") for i in range(60)]
    rows += [(100 + i, text(100), "xx", "t") for i in range(3)] + [(200 + i, text(100), None, None) for i in range(3)]
    rows += [(1000 + i, junk(), "en", f"s{i}") for i in range(5)] + [(1100, junk(), "xx", "t"), (1101, junk(), None, None)]
    got = quality.judge(table(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if r.kept} == {i for i, *_ in rows if i < 1000}
    assert all(r.distance is not None for r in got)


def test_quality_rejects_junk_up_to_near_half_of_a_source(table):
    rng = random.Random(4)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    junk = lambda: " ".join(w + "$$$" for w in text(100).split())
    copy = junk()
    rows = [(i, text(rng.randint(60, 400)), "en", "third") for i in range(100)] + [(1000 + i, junk(), "en", "third") for i in range(50)]
    rows += [(200 + i, text(rng.randint(60, 400)), "en", "more") for i in range(110)] + [(1200 + i, junk(), "en", "more") for i in range(85)]
    rows += [(400 + i, text(rng.randint(60, 400)), "en", "copies") for i in range(100)] + [(1400 + i, copy, "en", "copies") for i in range(50)]
    kept = {r.doc_id for r in quality.judge(table(rows, "doc_id long, text string, lang string, source string")).collect() if r.kept}
    assert kept == {i for i, *_ in rows if i < 1000}


def test_pii_matches_brute_force(docs, plain):
    for r in pii.find(docs).collect():
        t = plain[r.doc_id]
        n = Counter(s[3] for s in brute.base_spans(t))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (n["email"], n["ip"], n["card"], n["phone"])
        assert r.base_sha256 == brute.base_sha(t)


def test_pii_random_strings(table):
    rng = random.Random(3)
    bits = ["a@b.co", "@", ".", "-", "+1 (555) 010-9999", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4", "256.1.1.1", "01.002.3.4", " ", "é", "😀", "9", "x_", "%", "_d@e.f", "\n", "0" * 13]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 14)))) for i in range(1500)]
    for r in pii.find(table(rows)).collect():
        assert r.base_sha256 == brute.base_sha(rows[r.doc_id][1]), rows[r.doc_id]


def test_pii_method_spans_and_redaction(table):
    good, bad = "GB82WEST12345698765432", "GB82WEST12345698765431"
    rows = [(1, f"bank account {good} and {bad}"), (2, "my ssn is 123-45-6789"), (3, "code 123-45-6789 there"), (4, None), (5, ""),
            (6, "mail a@b.co or 1.2.3.4!"), (7, "a" * 300_000), (8, "7" * 20_000)]
    d = table([(i, t, "clash") for i, t in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r.spans for r in pii.find(d).collect()}
    assert got == {1: "iban:13:35", 2: "ssn:10:21", 3: "", 4: "", 5: "", 6: "email:5:11,ip:15:22", 7: "", 8: ""}
    clean = {r.doc_id: (r.text, r.spans) for r in pii.redact(d).collect()}
    assert clean[1] == (f"bank account [IBAN] and {bad}", "clash") and clean[4] == (None, "clash") and clean[6][0] == "mail [EMAIL] or [IP]!"
    assert pii.find(d.limit(0)).count() == 0 and pii.redact(d.limit(0)).count() == 0


def test_printed_and_small_ibans(table):
    good = ["GB82 WEST 1234 5698 7654 32", "gb82west12345698765432", "DE89 3704 0044 0532 0130 00", "BE71 0961 2345 6769", "NO9386011117947"]
    bad = ["GB82 WEST 1234 5698 7654 33", "Gb82west12345698765432", "GB82 WES 1234 5698 7654 32", "xGB82WEST12345698765432"]
    rows = [(i, f"paid to {t} from here") for i, t in enumerate(good + bad)]
    got = {r.doc_id: r.spans for r in pii.find(table(rows)).collect()}
    assert [got[i] for i in range(len(good))] == [f"iban:8:{8 + len(t)}" for t in good]
    assert not any("iban" in got[i] for i in range(len(good), len(rows)))


def test_redaction_with_clashing_names(table):
    d = table([(1, "mail a@b.co", 1, "x", "y")], "doc_id long, text string, _spans int, _pii_text string, _pii_0 string")
    got = pii.redact(d)
    assert got.columns == d.columns and got.first().text == "mail [EMAIL]" and got.first()["_spans"] == 1


def test_quality_is_alike_with_and_without_broadcast(docs, monkeypatch):
    judged = lambda: {r.doc_id: (r.kept, r.distance and round(r.distance, 6)) for r in quality.judge(docs).collect()}
    one = judged()
    monkeypatch.setattr(quality, "FEW", 0)
    assert judged() == one


def brute_capacity(sizes, shards):
    best = [[0] + [float("inf")] * len(sizes)]
    for _ in range(shards):
        best.append([min(max(best[-1][j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(len(sizes) + 1)])
    return best[-1][-1]


def test_minimax_cuts_are_optimal():
    rng = random.Random(5)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 5, 30]) for _ in range(rng.randint(1, 14))]
        shards = rng.randint(1, 6)
        capacity, ends = sharding.minimax_cuts(sizes, shards)
        got = [sum(sizes[a:b]) for a, b in zip([0, *ends], ends)]
        assert len(ends) == shards and ends[-1] == len(sizes) and sum(got) == sum(sizes)
        assert max(got) == capacity == brute_capacity(sizes, shards)


def check_shards(rows, texts, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 1, brute.crc(t or "")) for i, t in texts)
    where, slots = defaultdict(set), defaultdict(list)
    by_id = defaultdict(set)
    for i, t in texts:
        by_id[i].add(t or "")
    for r in rows:
        assert 0 <= r.shard < shards and r.grown_shard is None and r.law == "bytes"
        slots[r.shard].append(r.slot)
        if len(by_id[r.doc_id]) == 1:
            where[next(iter(by_id[r.doc_id]))].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding(docs, plain, table):
    check_shards(sharding.shard_documents(docs).collect(), list(plain.items()), 16)
    texts = [(i % 90, t) for i, t in enumerate(ODD * 3 + ["hot copy"] * 200 + [f"text {i}" for i in range(100)])]
    d = table([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, size int, shard string")
    check_shards(sharding.shard_documents(d).collect(), texts, 16)
    check_shards(sharding.shard_documents(d, shards=1).collect(), texts, 1)
    assert sharding.shard_documents(d.limit(0)).count() == 0


def test_shards_are_near_equal(spark):
    rows = sharding.shard_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    total, sizes = sum(r.size for r in rows), Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert len(sizes) == 16 and max(sizes.values()) <= total / 16 + max(r.size for r in rows)
