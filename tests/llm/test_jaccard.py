import random
import re

import numpy as np
import pytest
from egoline.llm import jaccard_join
from egoline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=4):
    words = WORD.findall("".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or ""))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k=4, percent=85):
    """Components by all pairs, from the contract."""
    sets = [shingle_set(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def got(d, **kw):
    return sorted(tuple(r) for r in jaccard_join.groups(d, **kw).collect())


def corpus(seed, n=60):
    """Bases of all sizes with chains of edits, copies, shared passages and tiny texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocab, k=25))
    texts = []
    for _ in range(n):
        base = rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 8, 10, 14, 17, 20, 30, 60, 150]))
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.7 and len(base) > 3:
                at = rng.randrange(len(base))
                base = base[:at] + rng.choice([[], [rng.choice(vocab)], [rng.choice(vocab), rng.choice(vocab)]]) + base[at + 1:]
            texts.append(" ".join(base) + (" " + passage if rng.random() < 0.2 else ""))
    texts += [rng.choice(texts).upper() for _ in range(10)]
    rng.shuffle(texts)
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,frequent,small", [(1, 1 << 19, 16), (2, 5, 16), (3, 0, 0)])
def test_components_match_all_pairs(table, monkeypatch, seed, frequent, small):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    rows = corpus(seed)
    assert got(table(rows).repartition(3)) == brute(rows)


def test_subsets_alone_match_all_pairs(table, monkeypatch):
    monkeypatch.setattr(jaccard_join, "boundary_of", lambda sizes, mean, rule: 14)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices("abcdef", k=rng.randint(1, 5)) + [f"x{k}" for k in range(rng.randint(3, 12))])) for i in range(150)]
    assert got(table(rows)) == brute(rows)


@pytest.mark.parametrize("words,percent", [(5, 80), (1, 50), (3, 95)])
def test_other_shingles_and_thresholds(table, words, percent):
    rows = corpus(words)
    assert got(table(rows), rule=jaccard_join.Rule(words, percent, 100)) == brute(rows, words, percent)


def test_re_read_by_shuffle(table, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PICKED", 0)
    rows = corpus(4)
    assert got(table(rows)) == brute(rows)


def test_links_run_through_null_ids(table):
    base = [f"w{i}" for i in range(120)]
    edit = lambda *at: " ".join(f"e{i}" if i in at else w for i, w in enumerate(base))
    a, m, b = edit(), edit(20, 60), edit(20, 60, 90, 100)
    rows = [(3, a), (None, m), (9, b), (None, m), (7, "quite another text of its own here"), (None, None)]
    found = {r.doc_id: r.component_id for r in jaccard_join.groups(table(rows)).collect() if r.doc_id is not None}
    ends = {r.doc_id: r.component_id for r in jaccard_join.groups(table([rows[0], rows[2]])).collect()}
    assert found == {3: 3, 9: 3, 7: 7} and ends == {3: 3, 9: 9}
    left = jaccard_join.representatives(table(rows))
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 0, 3, 7]


def test_names_that_clash(table):
    rows = [(1, "a b c d e", 1, 2, "x"), (2, "a b c d e", 1, 2, "y")]
    d = table(rows, "doc_id long, text string, _gone int, gone int, least string")
    left = jaccard_join.representatives(d)
    assert left.columns == d.columns and [r.doc_id for r in left.collect()] == [1]


def test_sketches_never_rule_out_a_link(monkeypatch):
    rng = np.random.default_rng(3)
    out = 0
    for k in range(600):
        monkeypatch.setattr(jaccard_join, "FIELD", 1 << 15 if k % 3 else 256)
        n = int(rng.integers(5, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        kept = a[rng.random(len(a)) > rng.choice([0, 0.05, 0.1, 0.3])]
        b = np.unique(np.concatenate([kept, rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 8))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        rule = jaccard_join.Rule()
        open_ = jaccard_join.may_link(jaccard_join.sketch(a), len(a), jaccard_join.sketch(b), len(b), rule)
        if rule.den * common >= rule.num * (len(a) + len(b) - common):
            assert open_
        else:
            out += not open_
    assert out > 50


def test_classes_whose_names_collide_are_told_apart(table):
    whole = jaccard_join.klass
    rows = [(1, 10, 7, 5), (2, 10, 8, 5), (3, 10, 8, 5), (4, 11, 7, 5), (5, None, None, None)]
    d = table(rows, "doc_id long, c long, c2 long, n long")
    got = {r.doc_id: r.c for r in jaccard_join.told_apart(d).collect()}
    assert got[2] == got[3] != got[1] and got[4] == 11 and got[5] is None and len({got[1], got[2], 10}) == 3
    assert whole(np.arange(3).astype(np.uint64)) != whole(np.arange(4).astype(np.uint64))


def test_frequency_table_is_bounded(table, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 10)
    tokens = table([(i, 200_000 + i % 3) for i in range(40)] + [(100 + i, 5_000_000) for i in range(7)], "token long, n long")
    held, n = jaccard_join.frequent_ones(tokens)
    assert held.tolist() == list(range(100, 107)) and set(n.tolist()) == {5_000_000}
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    assert len(jaccard_join.frequent_ones(tokens)[0]) == 0


def test_tables_match_all_pairs(docs, plain):
    assert got(docs) == brute(list(plain.items()))


def test_edge_rows(table):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (5, "one"), (6, "é one"), (7, "a " * 50_000), (8, "a " * 50_001), (9, "one two three four"), (10, "one two three four five")]
    d = table([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n long, c long")
    assert got(d) == brute(rows)
    left = sorted(r.doc_id for r in jaccard_join.representatives(d).collect())
    assert left == [1, 2, 3, 4, 6, 7, 9, 10] and jaccard_join.representatives(d).columns == d.columns
    assert got(d.limit(0)) == []


def test_large_group_is_no_square(table):
    """A group of near copies with a common base: as many candidate pairs as members, not their square."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(120)] = f"e{rng.random()}"
        rows.append((i, " ".join(words)))
    d = table(rows)
    assert got(d) == brute(rows)


def test_components_of_paths_and_stars(spark, table):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5)]
    found = {r.node: r.label for r in components(table(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(60)}}
    assert components(table([], "a long, b long"), "a", "b").count() == 0


def test_costs_are_those_of_the_enumeration():
    rng = np.random.default_rng(1)
    for n in range(1, 15):
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        assert len(jaccard_join.subset_keys(s, 10**6)[0]) == jaccard_join.Rule().subset_cost(n)
