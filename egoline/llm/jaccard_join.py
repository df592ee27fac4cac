"""Size-aware heavy-light join of documents on the Jaccard similarity of their word shingles.

Documents with the same shingle set are one class from the start. Classes of
few shingles ("light" work) enumerate, for every size that a partner may have,
their subsets of exactly the overlap that the threshold asks for: two classes
link if and only if such a subset is common, so a bucket of one subset is a
clique and a star of links says it all. Larger classes scan inverted lists:
they post the first ``n - ceil(t n) + 1`` shingles of a global order, one of
which every linked pair shares. The boundary between both is where the
estimated cost of subsets and lists, from the sizes and frequencies of the
whole corpus, is least.

The global order puts frequent shingles last, rarest first, so a passage that
thousands of documents share posts nothing. Any order gives the same links;
the frequency table has a fixed bound and only decides the work.

A list never yields all of its pairs. Its members are held against one hub per
size class (the member with the fewest shingles of its own), links are joined
to components, and only members of different components that still share a
list are held against each other. A candidate pair is first held against the
sketches of its sets, some bits a shingle, which rule out most pairs that share
no more than a passage; the others are decided by the exact intersection.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from dataclasses import dataclass
from struct import unpack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import id_text, small, written
from egoline.llm.components import components

#: Shingles that a task counts at a time; most entries of the frequency table (it is broadcast); largest size tried as boundary.
CHUNK, FREQUENT, SMALL = 1_000_000, 1 << 19, 16
#: Most rows to re-read that are picked by a broadcast; beyond, by a shuffle.
PICKED = 1_000_000
#: Bits of the largest sketch of a set.
FIELD = 1 << 15
U = np.uint64
MULTIPLY = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * MULTIPLY[3]
    h = (h ^ (h >> U(29))) * MULTIPLY[0]
    return h ^ (h >> U(32))


def shingles(text: str | None, words: int = 4) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    from xxhash import xxh3_64_intdigest

    ws = text.encode().lower().split() if text else []
    if not ws:
        return np.zeros(0, U)
    w = np.array(list(map(xxh3_64_intdigest, ws)), U)
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, U)
    for i in range(k):
        h = h + mix(w[i:len(w) - k + 1 + i] + MULTIPLY[i % 3])
        h = h * MULTIPLY[2]
    return np.unique(mix(h))


@dataclass(frozen=True)
class Rule:
    """What links two documents: shingles of so many words, and ``den * intersection >= num * union``."""
    words: int = 4
    num: int = 85
    den: int = 100

    def overlap(self, n: int, m: int) -> int:
        """Least intersection of linked sets of sizes n and m."""
        return -(-self.num * (n + m) // (self.den + self.num))

    def prefix(self, n: int) -> int:
        """Shingles that a set of size n posts."""
        return n - -(-self.num * n // self.den) + 1

    def partners(self, n: int) -> range:
        return range(-(-self.num * n // self.den), n * self.den // self.num + 1)

    def subset_cost(self, n: int) -> int:
        return sum(math.comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= min(n, m))

    def alike(self, n: str, m: str) -> str:
        return f"{self.den} * least({n}, {m}) >= {self.num} * greatest({n}, {m})"


def subset_keys(s: np.ndarray, boundary: int, rule: Rule = Rule()) -> tuple[list[int], list[int]]:
    """Keys of the subsets through which a small set may link, and its side of each bucket (0: the smaller, 1: the larger, 2: alike)."""
    keys, sides, n = [], [], len(s)
    for m in rule.partners(n):
        c = rule.overlap(n, m)
        if m > boundary or c > min(n, m):
            continue
        mark = U(min(n, m) * 1_000_003 + max(n, m))
        for part in itertools.combinations(s.tolist(), c):
            keys.append(int(mix(mix(np.array(part, U)).sum(dtype=U, keepdims=True) + mark)[0].astype(np.int64)))
            sides.append(2 if m == n else int(n > m))
    return keys, sides


def klass(s: np.ndarray) -> tuple[int, int]:
    """Identity of a shingle set: a 128-bit hash of all of it. Its first half names the class (see ``told_apart``)."""
    from xxhash import xxh3_128_digest

    return unpack("<qq", xxh3_128_digest(s.tobytes(), seed=len(s)))


def sketch(s: np.ndarray) -> bytes:
    """The set's bits in a field of four to eight times its size (a power of two, at most ``FIELD`` bits)."""
    bits = min(FIELD, max(64, 1 << (4 * len(s) - 1).bit_length()))
    field = np.zeros(bits, bool)
    field[s & U(bits - 1)] = True
    return np.packbits(field, bitorder="little").tobytes()


def may_link(x: bytes, n: int, y: bytes, m: int, rule: Rule) -> bool:
    """Whether two sketches leave a link of their sets open.

    A bit of one field that the other lacks is at least one shingle that the
    other lacks, so the fields bound the intersection from above. A larger field
    folds onto a smaller one.
    """
    a, b = np.frombuffer(x, U), np.frombuffer(y, U)
    while len(a) > len(b):
        a = a[:len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] | b[len(b) // 2:]
    need = rule.overlap(n, m)
    return n - int(np.bitwise_count(a & ~b).sum()) >= need and m - int(np.bitwise_count(b & ~a).sum()) >= need


def census(batches, words: int):
    """How often a task's classes hold the shingles that several of them hold, and how many classes have each size."""
    seen, held, n, sizes = set(), [], 0, Counter()

    def flush():
        tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, U), np.zeros(0, np.int64))
        often = counts >= 2
        keys, values = list(sizes), list(sizes.values())
        yield pa.record_batch([pa.array(tokens[often].astype(np.int64)), pa.array(counts[often].astype(np.int64)),
                               pa.nulls(int(often.sum()), pa.int64())], ["token", "n", "size"])
        yield pa.record_batch([pa.nulls(len(keys), pa.int64()), pa.array(values, pa.int64()), pa.array(keys, pa.int64())], ["token", "n", "size"])

    for b in small(batches):
        for text in b.column("text").to_pylist():
            s = shingles(text, words)
            if not len(s) or (k := klass(s)) in seen:
                continue
            seen.add(k)
            held.append(s)
            sizes[len(s)] += 1
            n += len(s)
            if n >= CHUNK:
                yield from flush()
                seen, held, n, sizes = set(), [], 0, Counter()
    yield from flush()


def boundary_of(sizes: dict[int, int], mean_list: float, rule: Rule = Rule()) -> int:
    """The size up to which subsets cost less than lists: each posting reads a list of the mean length."""
    best, at, cost = 0.0, 0, 0.0
    for n in range(1, SMALL + 1):
        cost += sizes.get(n, 0) * (rule.subset_cost(n) - rule.prefix(n) * (1 + mean_list))
        if cost < best:
            best, at = cost, n
    return at


def profiled(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], boundary: int, rule: Rule) -> DataFrame:
    """One row per document: its class, and once per task and class what the class posts.

    ``h`` is the hash of the text, by which a row is found again. ``own``:
    shingles outside the frequency table; the first ``light`` of ``posts`` are such.
    ``bits``: the sketch of the set.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    least = -(-rule.num * (boundary + 1) // rule.den)

    def work(batches):
        tokens, rank = shared.value
        seen: set[tuple[int, int]] = set()
        for b in small(batches):
            rows: list[list] = [[] for _ in range(9)]
            for text in b.column("text").to_pylist():
                s = shingles(text, rule.words)
                n = len(s)
                k = klass(s) if n else (None, None)
                posts = light = own = keys = sides = bits = None
                if n and k not in seen:
                    seen.add(k)
                    at = np.searchsorted(tokens, s)
                    known = at < len(tokens)
                    known[known] = tokens[at[known]] == s[known]
                    rest, often = s[~known], s[known][np.argsort(rank[at[known]], kind="stable")]
                    own = len(rest)
                    if n >= least:
                        p = rule.prefix(n)
                        light = min(p, own)
                        posts = np.concatenate([rest, often])[:p].astype(np.int64)
                        bits = sketch(s)
                    keys, sides = subset_keys(s, boundary, rule) if n <= boundary else (None, None)
                for column, x in zip(rows, (n, *k, own, light, posts, keys, sides, bits)):
                    column.append(x)
            yield pa.record_batch([b.column("doc_id"), b.column("h"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()),
                                   pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.int32()), pa.array(rows[5], pa.list_(pa.int64())),
                                   pa.array(rows[6], pa.list_(pa.int64())), pa.array(rows[7], pa.list_(pa.int32())), pa.array(rows[8], pa.binary())],
                                  ["doc_id", "h", "n", "c", "c2", "own", "light", "posts", "keys", "sides", "bits"])

    return docs.withColumn("h", F.xxhash64("text")).mapInArrow(
        work, "doc_id long, h long, n long, c long, c2 long, own int, light int, posts array<long>, keys array<long>, sides array<int>, bits binary")


def told_apart(profiles: DataFrame) -> DataFrame:
    """``profiles`` with one ``c`` per class: should the first halves of two different
    identities agree, which few of many billion do, those classes are named anew from both halves."""
    while True:
        twice = profiles.filter("c IS NOT NULL").groupBy("c").agg(F.min("c2").alias("lo"), F.max("c2").alias("hi")).filter("lo <> hi").select("c")
        if twice.isEmpty():
            return profiles
        again = profiles.join(twice.withColumn("_twice", F.lit(True)), "c", "left")
        again = again.withColumn("c", F.when(F.col("_twice"), F.xxhash64("c", "c2")).otherwise(F.col("c")))
        profiles = written(again.select(*profiles.columns), "profiles")


def subset_links(profiles: DataFrame) -> DataFrame:
    """Links ``a, b`` of the small classes: a star for each subset bucket with both sides."""
    rows = profiles.filter("size(keys) > 0").select("c", F.explode(F.arrays_zip("keys", "sides")).alias("k")).select("c", "k.keys", "k.sides")
    groups = rows.groupBy("keys").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("sides").alias("s0"), F.max("sides").alias("s1"))
    groups = groups.filter("lo <> hi and (s0 = 2 or s0 <> s1)")
    return rows.join(groups, "keys").filter("c <> lo").select(F.col("c").alias("a"), F.col("lo").alias("b"))


def posted(profiles: DataFrame, rule: Rule) -> DataFrame:
    """Postings ``token, c, n, own, reach, g`` on lists with several classes.

    A link of sizes n and m shares a shingle among the first ``n - overlap(n, m) + 1``
    of either, so a posting at place i only serves partners of sizes up to ``reach``.
    """
    rows = profiles.filter("posts is not null")
    cols = ["c", "n", "own"]
    # a task holds a shingle outside the table at most once, so such lists are as short as there are tasks
    rare = rows.select(*cols, F.posexplode(F.slice("posts", F.lit(1), F.col("light"))).alias("i", "token"))
    rare = reaching(rare, rule).selectExpr("*", "min(c) over (partition by token) <> max(c) over (partition by token) as several",
                                     "min(n) over (partition by token) as low").filter("several and low <= reach").drop("several", "low")
    often = rows.select(*cols, "light", F.posexplode(F.slice("posts", F.col("light") + 1, F.greatest(F.size("posts") - F.col("light"), F.lit(0)))).alias("i", "token"))
    often = reaching(often.withColumn("i", F.col("i") + F.col("light")).drop("light"), rule)
    low = often.groupBy("token").agg(F.min("n").alias("low"), F.min("c").alias("one"), F.max("c").alias("two")).filter("one <> two")
    often = often.join(low.select("token", "low"), "token").filter("low <= reach").drop("low")
    return rare.unionByName(often).withColumn("g", F.floor(F.log("n") / -math.log(rule.num / rule.den)).cast("int"))


def reaching(rows: DataFrame, rule: Rule) -> DataFrame:
    return rows.withColumn("reach", F.expr(f"(n - i) * {rule.den + rule.num} div {rule.num} - n")).drop("i")


def pairs_of(rows: DataFrame, rule: Rule) -> DataFrame:
    """Distinct unordered pairs of ``c, n, reach`` and ``d, m, far`` whose sizes and places may link."""
    rows = rows.filter(f"c <> d and m <= reach and n <= far and {rule.alike('n', 'm')}")
    first = F.col("c") < F.col("d")
    return rows.select(F.when(first, F.col("c")).otherwise(F.col("d")).alias("a"), F.when(first, F.col("d")).otherwise(F.col("c")).alias("b")).distinct()


def hub_pairs(posts: DataFrame, rule: Rule) -> DataFrame:
    """Each class with one hub: of the hubs of its size class and the next one on its
    lists the one that it meets most often, then the one with the fewest shingles of its own."""
    hubs = posts.groupBy("token", "g").agg(F.min(F.struct("own", "c", "n", "reach")).alias("h"))
    hubs = hubs.select("token", F.explode(F.array("g", F.col("g") - 1)).alias("g"), F.col("h.c").alias("d"), F.col("h.n").alias("m"),
                       F.col("h.reach").alias("far"), F.col("h.own").alias("of_hub"))
    met = posts.join(hubs, ["token", "g"]).filter(f"c <> d and m <= reach and n <= far and {rule.alike('n', 'm')}")
    met = met.groupBy("c", "d").agg(F.count(F.lit(1)).alias("times"), F.min("of_hub").alias("of_hub"))
    best = met.groupBy("c").agg(F.max_by("d", F.struct("times", -F.col("of_hub"), "d")).alias("d"))
    return best.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()


def rest_pairs(posts: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of one list in different components: components are paired first, by
    whether any sizes of theirs are in reach of each other, then opened."""
    rows = posts.join(labels, posts["c"] == labels["node"], "left").select("token", "c", "n", "reach", F.coalesce("label", "c").alias("k"))
    mixed = rows.groupBy("token").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).filter("lo <> hi").select("token")
    rows = written(rows.join(mixed, "token").distinct(), "lists")
    groups = rows.groupBy("token", "k").agg(F.min("n").alias("low"), F.max("reach").alias("top"), F.count(F.lit(1)).alias("held"))
    other = groups.select("token", F.col("k").alias("l"), F.col("low").alias("low2"), F.col("top").alias("top2"), F.col("held").alias("held2"))
    # the smaller component is opened first, so a large one is met by single rows, within their reach only
    couples = groups.join(other, "token").filter("(held < held2 or held = held2 and k < l) and low <= top2 and low2 <= top").select("token", "k", "l")
    right = rows.select("token", F.col("k").alias("l"), F.col("c").alias("d"), F.col("n").alias("m"), F.col("reach").alias("far"))
    return pairs_of(couples.join(rows, ["token", "k"]).join(right, ["token", "l"]), rule)


def promising(pairs: DataFrame, profiles: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` that the sketches of their sets do not rule out."""
    nodes = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    nodes = written(nodes, "nodes")
    nodes = F.broadcast(nodes) if nodes.count() <= PICKED else nodes
    rows = profiles.filter("bits is not null").select("c", "n", "bits").join(nodes, "c", "left_semi").dropDuplicates(["c"])
    rows = written(rows, "sketches")
    # both sides rename every column, so that the planner sees one exchange and uses it twice
    both = pairs.join(rows.select(F.col("c").alias("a"), F.col("n").alias("size_a"), F.col("bits").alias("x")), "a")
    both = both.join(rows.select(F.col("c").alias("b"), F.col("n").alias("size_b"), F.col("bits").alias("y")), "b")

    def work(batches):
        for b in small(batches):
            x, n, y, m = (b.column(c).to_pylist() for c in ("x", "size_a", "y", "size_b"))
            yield b.select(["a", "b"]).filter(pa.array([may_link(*z, rule) for z in zip(x, n, y, m)], pa.bool_()))
    return both.select("a", "b", "size_a", "size_b", "x", "y").mapInArrow(work, "a long, b long")


def found_again(docs: DataFrame, profiles: DataFrame, nodes: DataFrame) -> DataFrame:
    """``c, c2, text`` of one document of each class in ``nodes`` (rows that repeat id and text come more than once).

    A row is named by its id, null ids included, and the hash of its text.
    """
    name = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("h")]
    ids = written(profiles.select("c", "c2", *name).join(nodes, "c").groupBy("c", "c2").agg(F.min(F.struct("none", "id", "h")).alias("r")).select("c", "c2", "r.*"), "nodes")
    picked = F.broadcast(ids) if ids.count() <= PICKED else ids
    return docs.withColumn("h", F.xxhash64("text")).select("text", *name).join(picked, ["none", "id", "h"]).select("c", "c2", "text")


def linked(pairs: DataFrame, docs: DataFrame, profiles: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough, by their exact intersection.

    Sets are made anew, from the text of one document per class, only for the
    classes of pairs that their sketches leave open.
    """
    pairs = written(promising(written(pairs, "pairs"), profiles, rule), "pairs")
    nodes = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()

    def work(batches):
        seen: set[int] = set()
        for b in small(batches):
            found = []
            for c, c2, t in zip(*(b.column(x).to_pylist() for x in ("c", "c2", "text"))):
                if c not in seen and len(s := shingles(t, rule.words)) and klass(s)[1] == c2:
                    seen.add(c)
                    found.append((c, s.astype(np.int64)))
            yield pa.record_batch([pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.list_(pa.int64()))], ["c", "s"])

    sets = found_again(docs, profiles, nodes).mapInArrow(work, "c long, s array<long>")
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("c").alias("b"), F.col("s").alias("y")), "b")
    common = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("t"))
    # not made distinct here: an aggregate on top would keep a hub's pairs in one task; components() does that
    return written(common.filter(f"{rule.den + rule.num} * i >= {rule.num} * t").select("a", "b"), "links")


def frequent_ones(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, with their counts: as many whole buckets of
    like counts as hold ``FREQUENT`` at most. Buckets are sixteenths of a power of two,
    without an upper end, so their number is bounded too."""
    bucket = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r["b"], r["k"]) for r in tokens.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    least, room = None, FREQUENT
    for b, k in sizes:
        room -= k
        if room < 0:
            break
        least = b
    if least is None:
        return np.zeros(0, U), np.zeros(0, np.int64)
    table = tokens.filter(bucket >= least).select("token", "n").toPandas()  # at most FREQUENT rows
    token = table["token"].to_numpy(np.int64).astype(U)
    order = np.argsort(token)
    return token[order], table["n"].to_numpy(np.int64)[order]


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    Texts without words, null ones included, have no shingle and link with
    nothing. Rows that repeat an id are rows of their own, linked by their
    texts. A null id names no component, but its row links others. Texts of any
    length are taken whole. Columns other than the id and the text are ignored,
    whatever their names. An empty table gives an empty result.
    """
    docs = id_text(docs, id_col, text_col)
    words = rule.words
    counts = written(docs.select("text").mapInArrow(lambda it: census(it, words), "token long, n long, size long"), "census")
    tokens = written(counts.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    frequent = frequent_ones(tokens)
    sizes = {r["size"]: r["n"] for r in counts.filter(f"size <= {SMALL}").groupBy("size").agg(F.sum("n").alias("n")).collect()}
    total = counts.filter("size is not null").agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    again = tokens.agg(F.sum(F.col("n") * F.col("n")), F.sum("n")).first()
    mean_list = (float(again[0] or 0) + total - (again[1] or 0)) / total if total else 1.0
    profiles = told_apart(written(profiled(docs, frequent, boundary_of(sizes, mean_list, rule), rule), "profiles"))
    posts = written(posted(profiles, rule), "postings")
    small = written(subset_links(profiles), "links")
    first = small.union(linked(hub_pairs(posts, rule), docs, profiles, rule))
    labels = components(first, "a", "b")
    rest = rest_pairs(posts, labels, rule)
    links = first.union(linked(rest, docs, profiles, rule))
    # both right sides are written first: then the rows of a large class or component can be split at the join
    labels = written(components(links, "a", "b"), "labels")
    rows = profiles.select("doc_id", "n", "c").join(labels, F.col("c") == F.col("node"), "left")
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "c").alias("label"))
    named = written(rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id")), "named")
    return rows.join(named, "label", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component: one document of each group stays.

    Rows that repeat an id are one document and stay or go together, and rows
    with a null id stay. All columns are returned, whatever their names.
    """
    found = groups(docs, id_col, text_col, rule).groupBy("doc_id").agg(F.min("component_id").alias("least"))
    gone = written(found.filter("least < doc_id").select(F.col("doc_id").alias("gone")), "gone")
    return docs.join(gone, docs[id_col].cast("long") == gone["gone"], "left_anti")
