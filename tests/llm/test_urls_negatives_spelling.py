import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from egoline.llm import hard_negatives, queries, spelling, url_rules

SF = "/root/testdata/sf0.001"
URLS = "page_id long, url string"


# --- URL filters --------------------------------------------------------------

def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return host.translate(str.maketrans(url_rules.UPPER, url_rules.LOWER)), path


def fixed(host, path):
    best = None
    for verdict, h, p in url_rules.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and len(h + p) > len(best[0] if best else ""):
            best = (h + p, verdict)
    return best or (None, None)


def url_tokens(url):
    if url is None or "://" not in url:
        return set()
    host, path = split(url)
    rest = url.split("://", 1)[1][len(host) + len(path):]
    lower = str.maketrans(url_rules.UPPER, url_rules.LOWER)
    return {m + t.translate(lower) for m, part in (("h:", host), ("p:", path), ("q:", rest)) for t in re.findall(url_rules.TOKEN, part)}


def mined_by_brute_force(labelled, least, confidence):
    """Every set of tokens with enough bad holders, closed under tokens that always come together, minimal ones only."""
    rows = [(url_tokens(u), bool(b)) for u, b in labelled]
    holders = {}
    for i, (ts, _) in enumerate(rows):
        for t in ts:
            holders.setdefault(t, set()).add(i)
    classes = {}
    for t, h in holders.items():
        if sum(rows[i][1] for i in h) >= least:
            classes.setdefault(frozenset(h), set()).add(t)
    rules = {}
    for k in range(1, len(classes) + 1):
        for combo in combinations(classes, k):
            both = frozenset.intersection(*combo)
            bad = sum(rows[i][1] for i in both)
            if bad >= least and bad / len(both) >= confidence:
                rules[frozenset().union(*(classes[c] for c in combo))] = bad / len(both)
    return {r: c for r, c in rules.items() if not any(o < r for o in rules)}


def spam_urls(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.choice(["good", "cheap", "free"]), rng.choice(["news", "pills", "shop"])
        bad = (a, b) in (("cheap", "pills"), ("free", "shop")) and rng.random() < 0.9 or rng.random() < 0.05
        out.append((f"https://{a}-{b}.example.com/{rng.choice(['en', 'es'])}/{i}?utm=feed", bad))
    return out


def test_mined_rules_match_brute_force(table):
    labelled = spam_urls(400)
    got = url_rules.mine(table(labelled, "url string, bad boolean"), min_support=0.01, min_urls=10, min_confidence=0.7).collect()
    want = mined_by_brute_force(labelled, 10, 0.7)
    assert {frozenset(r.tokens): round(r.confidence, 9) for r in got} == {t: round(c, 9) for t, c in want.items()}
    assert {frozenset(r.tokens) for r in got} >= {frozenset({"h:cheap", "h:pills"})}
    assert all(r.key in r.tokens for r in got)


def test_verdicts_follow_rules_then_mined_combinations(table):
    mined = url_rules.mine(table(spam_urls(400), "url string, bad boolean"), min_urls=10, min_confidence=0.7)
    rules = [(set(r.tokens), r.confidence) for r in mined.collect()]
    urls = [u for u, _ in spam_urls(60, seed=2)] + [
        None, "", "no scheme", "http://", "http://net", "http://a.NET/", "http://anet/x", "https://Example.Net/en/1?x", "http://x.example.net/en",
        "http://example.com/de/", "http://m.example.com/de", "http://org/fr/?q#f", "http://a.org/fr", "http://cheap.org/pills", "x://y://z/p",
        "https://cheap-pills.example.net/en/", "ftp://h/p#frag?not", "http://h?q=/x", "http://h/" + "long/" * 30_000, "http://CHEAP.PILLS/É/ü?Ä"]
    rows = list(enumerate(urls)) + [(0, urls[0]), (None, urls[1])]
    got = url_rules.judge(table([(*r, "c", "d") for r in rows], URLS + ", host string, verdict string"), mined).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got if r.page_id is not None}
    for i, u in enumerate(urls):
        host, path = split(u)
        name, verdict = fixed(host, path)
        hit = [t for t, _ in rules if t <= url_tokens(u)] if name is None else []
        r = by_id[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, name, verdict or ("block" if hit else "allow")), u
        assert (r.mined is None) == (not hit) and (not hit or set(r.mined.split()) in hit)
    assert sum(r.mined is not None for r in got) > 3


def test_urls_edges(table):
    empty = url_rules.mine(table([], "url string, bad boolean"))
    assert empty.count() == 0
    assert url_rules.judge(table([], URLS), empty).count() == 0
    assert url_rules.mine(table([(None, True)] * 30 + [("x", None)] * 5, "url string, bad boolean")).count() == 0
    # a third of the labelled rows are copies of one URL with 40 tokens: one item, not 2 ** 40 sets
    long = "http://spam.example.com/" + "/".join(f"w{i}x" for i in range(40))
    labelled = [(long, True)] * 100 + [(f"http://ok.example.com/{i}", False) for i in range(200)]
    rules = url_rules.mine(table(labelled, "url string, bad boolean")).collect()
    assert len(rules) == 1 and len(rules[0].tokens) == 41 and rules[0].confidence == 1.0  # 40 words and "spam"; the domain is everywhere


def test_op11_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    labels = {r.doc_id: bool(r.toxic == 1 or r.quality == 0) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    labelled = [(u, labels[i]) for i, u in pages.items() if i in labels]
    rules = mined_by_brute_force(labelled, max(url_rules.MIN_URLS, math.ceil(url_rules.MIN_SUPPORT * len(labelled))), url_rules.MIN_CONFIDENCE)
    for r in queries.op11_url_filters(spark, SF).collect():
        name, verdict = fixed(*split(pages[r.page_id]))
        if name is None:
            verdict = "block" if any(t <= url_tokens(pages[r.page_id]) for t in rules) else "allow"
        assert (r.rule, r.verdict) == (name, verdict)


# --- hard negatives -----------------------------------------------------------

def hard_by_brute_force(rows, every=100, positives=5, negatives=10):
    ok = [(i, lab, [math.floor(256.0 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  (the shorter one ends the sum)
    out = []
    for k, (i, lab, v) in enumerate(ok):
        if i % every:
            continue
        near = sorted((-dot(v, w), j) for m, (j, other, w) in enumerate(ok) if other == lab and m != k)[:positives]
        rest = sorted((-dot(v, w), j) for j, other, w in ok if other != lab)
        for ps, p in near:
            band = [(s, j) for s, j in rest if 30 * -ps <= 100 * -s <= 90 * -ps][:negatives]
            out += [(i, p, r + 1, j, -ps, -s) for r, (s, j) in enumerate(band)]
    return sorted(out)


def hard(spark, rows, schema="vec_id long, label int, embedding array<float>", parts=5, **kw):
    kw.setdefault("every", 10)
    got = hard_negatives.mine(spark.createDataFrame(rows, schema).repartition(parts), **kw)
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims)) * 0.2
    lab = rng.integers(0, labels, n)
    return [(i, int(lab[i]), [float(np.float32(x)) for x in centres[lab[i]] + rng.normal(size=dims) * 0.2 + 0.2]) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 8, 13, 64])
def test_hard_negatives_match_brute_force(spark, dims):
    rows = vectors(300, dims, dims)
    want = hard_by_brute_force(rows, every=10)
    assert hard(spark, rows) == want and want


def test_hard_negatives_with_ties_copies_nulls_and_ragged_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BATCH_BYTES", 2000)  # several batches
    rows = vectors(200, 9, 3)
    same = rows[20][2]
    rows += [(i, 1 + i % 2, same) for i in range(200, 330)]  # a third of the rows are one vector
    rows += [rows[30], rows[30], rows[205], (30, 2, rows[31][2])]  # repeated rows, an id with two vectors
    bad = [(400, None, same), (410, 1, None), (420, 1, [1.0, None]), (430, 1, [float("nan")]), (440, 1, [float("inf")]), (None, 1, same)]
    ragged = [(450, 1, []), (460, 1, [0.5]), (470, 2, same + [3.0, -4.0])]
    want = hard_by_brute_force(rows + bad + ragged, every=10)
    assert hard(spark, rows + bad + ragged) == want
    assert hard(spark, []) == []
    assert hard(spark, bad) == []


def test_hard_negatives_ignore_other_columns_and_reject_overflow(spark):
    rows = vectors(60, 5, 8)
    named = [(i, lab, v, 1, "x", 2) for i, lab, v in rows]
    assert hard(spark, named, "vec_id long, label int, embedding array<double>, id int, vector string, anchor int") == hard_by_brute_force(rows, every=10)
    big = [(i, lab, [x * 1e6 for x in v]) for i, lab, v in rows]  # needs 64-bit sums
    assert hard(spark, big, "vec_id long, label int, embedding array<double>") == hard_by_brute_force(big, every=10)
    with pytest.raises(Exception, match="64 bits"):
        hard(spark, [(0, 1, [1e30]), (1, 1, [1e30])])


def test_op12_query(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 and lab is not None else lab, v) for i, lab, v in rows]
    assert sorted(tuple(r) for r in queries.op12_hard_negatives(spark, SF).collect()) == hard_by_brute_force(rows)


# --- spelling variants --------------------------------------------------------

def variants_by_brute_force(docs, least=2):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= least}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    out, ws = {}, sorted(n)
    close = {w: [x for x in ws if near(w, x)] for w in ws}
    form = {}
    for w in ws:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    for w in ws:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None)
    return sorted(out.values())


def spelt(spark, docs, schema="doc_id long, text string"):
    return sorted((tuple(r) for r in spelling.variants(spark.createDataFrame(docs, schema)).collect()))


def test_spelling_variants_match_brute_force(spark):
    rng = random.Random(5)
    base = ["aaaaaaab", "abababab", "recommend", "éécriture", "müllerin", "occurrence", "aaaaaaaa", "zzzzzzz"]

    def edit(w):
        i, c = rng.randrange(len(w) + 1), rng.choice("abcmé")
        return rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
    docs = []
    for i in range(250):
        ws = [rng.choice(base[:1 + i % 8]) for _ in range(20)] + [edit(rng.choice(base)) for _ in range(6)] + [edit(edit(rng.choice(base)))]
        docs.append((i, " ".join(w.upper() if rng.random() < 0.2 else w for w in ws)))
    docs += [(900 + k, "recommend " * 2 + "recommendz " * 40 + "recommendzy " * 900) for k in range(2)]  # a chain of forms
    want = variants_by_brute_force(docs)
    assert spelt(spark, docs) == want
    assert any(r[1] and r[1] != r[2] for r in want) and sum(r[4] for r in want) > 200


def test_spelling_edges(spark):
    long = "q" * 5000
    docs = [(1, None), (2, ""), (None, "withoutid withoutid"), (3, "×÷×÷×÷× ×÷×÷×÷× Straße-STRASSEN strassen"), (4, long + " " + long), (4, long[:-1] + " " + long[:-1]),
            (5, "Élégance élégance élégance Élégance"), (5, "😀letters😀 letters"), (5, "😀letters😀 letters")]
    assert spelt(spark, docs) == variants_by_brute_force(docs)
    assert spelt(spark, [(*d, "k", 3, "f") for d in docs], "doc_id long, text string, key string, n int, form string") == variants_by_brute_force(docs)
    assert spelt(spark, []) == []


def test_op13_query(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in queries.op13_spelling_variants(spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == variants_by_brute_force(rows)


def test_groups_are_bounded_by_the_alphabet(spark):
    """However many words there are, a key holds one whole rotation and one word per letter."""
    rng = random.Random(2)
    counted = spark.createDataFrame([("".join(rng.choices("abc", k=7)), 5) for _ in range(3000)], "word string, n long").dropDuplicates(["word"])
    assert spelling.rotations(counted).groupBy("key").count().agg(F.max("count")).first()[0] <= 3 + 1
