import random
import re
import zlib

import brute
from egoline.llm import decontaminate, toxicity

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text)


def brute_hits(ws, items, window):
    hit, found = set(), []
    for name, item in items:
        windows = {tuple(item[i:i + window]) for i in range(len(item) - window + 1)} if len(item) >= window else ({tuple(item)} if item else set())
        at = [(i, len(w)) for w in windows for i in range(len(ws) - len(w) + 1) if tuple(ws[i:i + len(w)]) == w]
        hit.update(j for i, n in at for j in range(i, i + n))
        if at:
            found.append(name)
    return hit, sorted(found)


def test_automaton_against_brute_force():
    rng = random.Random(4)
    for k in range(1500):
        vocab = [x.encode() for x in ("abc" if k % 2 else "abcdefgh")]
        window = rng.choice([3, 4, 5])
        items = [(str(i), rng.choices(vocab, k=rng.randint(0, 9))) for i in range(rng.randint(0, 5))]
        ws = rng.choices([*vocab, b"z"], k=rng.randint(0, 40))
        if items and rng.random() < .6:
            ws[5:5] = rng.choice(items)[1]
        spans, names = decontaminate.SuffixAutomaton(items, window).scan(ws)
        hit, found = brute_hits(ws, items, window)
        assert ({j for a, e in spans for j in range(a, e)}, names) == (hit, found)


def test_words_are_the_contract_s():
    rng = random.Random(2)
    for _ in range(3000):
        s = "".join(rng.choices("aZ09é_- \n\x7f\x85ÉſK日😀.\x1c", k=rng.randint(0, 12)))
        assert [w.decode() for w in decontaminate.words(s)] == NORMAL.findall(lower(s))
        assert len(decontaminate.words(s)) == len(decontaminate.WORD.findall(s))


def test_contamination_of_the_tables(spark, docs, plain, table):
    from conftest import SF
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(str(r.item_id), NORMAL.findall(lower(r.text or ""))) for r in bench.collect()]
    for r in decontaminate.report(docs, bench).collect():
        ws = NORMAL.findall(lower(plain[r.doc_id]))
        hit, found = brute_hits(ws, items, 10)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(ws), len(hit), len(found), brute.sha(",".join(found)), bool(hit))


def test_contamination_edges_and_cleaning(table):
    bench = table([(1, "Alpha, beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item"), (2, "short item"), (3, None), (4, "")], "item_id long, text string")
    long = "alpha beta gamma delta epsilon zeta eta theta iota KAPPA lambda"
    rows = [(1, f"Before! {long}, after it all comes more of the text that is quite long enough to stay here."), (2, None), (3, ""), (4, long), (5, "a SHORT-item, and much more than that"), (6, "clean"), (6, "clean")]
    d = table([(i, t, "x") for i, t in rows], "doc_id long, text string, n_hit string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.report(d, bench).collect()}
    assert got == {1: (11, 1), 2: (0, 0), 3: (0, 0), 4: (11, 1), 5: (2, 1), 6: (0, 0)}
    kept = sorted((r.doc_id, r.text, r.n_hit) for r in decontaminate.clean(d, bench).fillna("NULL", ["text"]).collect())
    assert kept == [(1, "Before! , after it all comes more of the text that is quite long enough to stay here.", "x"), (2, "NULL", "x"), (3, "", "x"),
                    (5, "a , and much more than that", "x"), (6, "clean", "x"), (6, "clean", "x")]
    assert decontaminate.report(d.limit(0), bench).count() == 0
    assert decontaminate.report(d, bench.limit(0)).filter("contaminated").count() == 0


def brute_segments(seq):
    """By definition: the best segment (the shortest of equals), then both of its sides."""
    best = None
    for a in range(len(seq)):
        s = 0
        for e in range(a + 1, len(seq) + 1):
            s += seq[e - 1]
            if s > 1e-9 and (best is None or s > best[0] + 1e-9 or (abs(s - best[0]) < 1e-9 and e - a < best[2] - best[1])):
                best = (s, a, e)
    if best is None:
        return []
    return brute_segments(seq[:best[1]]) + [best] + [(s, x + best[2], y + best[2]) for s, x, y in brute_segments(seq[best[2]:])]


def test_segments_against_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randint(0, 30)
        at = sorted(rng.sample(range(n), rng.randint(0, n)))
        scores, drift = [rng.choice([1.01, 2.003, 3.7, .3]) for _ in at], -rng.choice([.1, .7, 1.9])
        seq = [drift] * n
        for i, s in zip(at, scores):
            seq[i] = s
        assert [(round(s, 5), a, e) for s, a, e in toxicity.segments(at, scores, drift)] == [(round(s, 5), a, e) for s, a, e in brute_segments(seq)]


def test_toxicity_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score(d, toxicity.fit(d, labels)).collect()
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == d.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    ones, zeros = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros)
    assert auc > 0.9 and sum(p == y for _, p, y in held) / len(held) > 0.95


def test_toxicity_edges(table):
    d = table([(i, t, 1) for i, t in [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "word " * 60_000), (None, "x")]], "doc_id long, text string, score int")
    labels = table([(1, None), (2, 1), (3, 0), (3, 1), (4, 7)], "doc_id long, toxic int")
    rows = toxicity.score(d, toxicity.fit(d, labels)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(d.limit(0), toxicity.fit(d.limit(0), labels.limit(0))).count() == 0
