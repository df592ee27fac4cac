"""Toxicity by maximal scoring segments over token log-odds.

Fit: the words of a bounded sample of labelled documents are counted by class,
once per document; the log-odds of a word under an informative Dirichlet prior
(the words' overall shares) and its standard deviation tell which words are
significantly toxic. Such a word scores its log-odds, any other word a small
negative drift, so that long clean stretches end a passage. The extreme-value
law of the best segment of clean text (its decay solves ``E exp(decay * score)
= 1``; its factor is fitted to the clean documents of the sample) turns a
segment's score into evidence beyond chance. One logistic curve from the summed
evidence to the label, again fitted on the sample, gives the final score.

Use: a linear-time scan finds every maximal segment of every document (the
algorithm of Ruzzo and Tompa, over the significant words only, since the drift
between two of them is known). Texts alone are scored; labels, languages,
sources and ids are no inputs. Only the fitted words (at most ``LEXICON``) and
four numbers are broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import small, written
from egoline.llm.decontaminate import words

#: Bound on the labelled documents that the classifier is fitted on: those with the smallest hashed ids.
SAMPLE = 20_000
#: Most significant words that are kept, least documents that hold one, and least z-score.
LEXICON, LEAST_DOCS, LEAST_Z = 20_000, 5, 4.0
#: Weight of the prior in documents, and the score of a word that is not significant.
PRIOR, DRIFT = 100.0, -0.02


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def segments(positions: list[int], scores: list[float], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, first, end)`` of a sequence that scores ``drift`` off the given positions.

    Linear: each segment is pushed once and merged at most once; ``down`` points to
    the nearest earlier segment that begins lower, as in the paper.
    """
    kept: list[list] = []  # left sum, right sum, first, end, index of the nearest segment with a lower left sum
    total, last = 0.0, 0
    for at, score in zip(positions, scores):
        left = total + drift * (at - last)
        total, last = left + score, at + 1
        new = [left, total, at, at + 1, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= new[0]:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= new[1]:
                break
            new = [kept[j][0], new[1], kept[j][2], new[3], -1]
            del kept[j:]
        new[4] = j
        kept.append(new)
    return [(right - left, first, end) for left, right, first, end, _ in kept]


@dataclass
class Model:
    scores: dict[bytes, float]
    decay: float
    log_factor: float
    bias: float
    slope: float

    def passages(self, ws: list[bytes]) -> list[tuple[float, int, int]]:
        """Maximal segments with their evidence beyond chance, the significant ones only."""
        got = list(map(self.scores.get, ws, repeat(0.0)))
        at = [i for i, s in enumerate(got) if s]
        chance = self.log_factor + math.log(len(ws)) if at else 0.0
        found = [(self.decay * s - chance, a, e) for s, a, e in segments(at, [got[i] for i in at], DRIFT)]
        return [x for x in found if x[0] > 0]

    def evidence(self, ws: list[bytes]) -> float:
        return math.log1p(sum(x for x, _, _ in self.passages(ws)))

    def score(self, ws: list[bytes]) -> float:
        return 1 / (1 + math.exp(-min(60.0, max(-60.0, self.bias + self.slope * self.evidence(ws)))))


def counted(batches):
    """Documents of each class that hold a word, partial to the task."""
    n: dict[bytes, list[int]] = {}
    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w in set(words(text)):
                n.setdefault(w, [0, 0])[toxic] += 1
    names = list(n)
    yield pa.record_batch([pa.array(names, pa.binary()), pa.array([n[w][1] for w in names], pa.int64()), pa.array([n[w][0] for w in names], pa.int64())],
                          ["word", "toxic", "clean"])


def decay_of(share: np.ndarray, score: np.ndarray) -> float:
    """The positive root of ``E exp(x * score) = 1``; scores have a negative mean."""
    lo, hi = 1e-6, 1.0
    over = lambda x: float((share * np.exp(x * score)).sum()) > 1
    while not over(hi) and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if over(mid) else (mid, hi)
    return hi


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton steps with a slight ridge."""
    a = np.stack([np.ones_like(x), x], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, a.T @ (y - p) - 1e-3 * w)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model from the labelled documents that are not held out.

    Labels other than 0 and 1 and null ids are left out; texts that repeat
    count once, with their first label. Without labelled documents of both
    classes no word is significant and every score is the share of label 1
    (one half where there is none).
    """
    named = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("y"))
    chosen = named.filter(F.col("y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    chosen = chosen.groupBy("_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    slim = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    picked = slim.join(F.broadcast(chosen), "_id")  # at most ``sample`` rows
    picked = written(picked.groupBy(F.xxhash64("text").alias("h")).agg(F.min_by(F.struct("text", "y"), "_id").alias("r")).select("r.text", "r.y"), "toxicity")
    by_class = {r["y"]: r["n"] for r in picked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = by_class.get(1, 0), by_class.get(0, 0)
    if not n1 or not n0:
        share = n1 / (n1 + n0) if n1 + n0 else 0.5
        return Model({}, 1.0, 0.0, math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0)
    both = F.col("toxic") + F.col("clean")
    count = picked.mapInArrow(counted, "word binary, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    prior1 = F.lit(PRIOR) * both / (n1 + n0)
    odds = lambda n, size: F.log((n + prior1) / (size + PRIOR - n - prior1))
    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    spread = F.sqrt(1 / (F.col("toxic") + prior1) + 1 / (F.col("clean") + prior1))
    rare = count.filter(both <= 0.5 * (n1 + n0)).select("word", "toxic", "clean", delta.alias("delta"), (delta / spread).alias("z"))
    best = rare.filter((F.col("toxic") >= LEAST_DOCS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "word").limit(LEXICON).collect()
    scores = {bytes(r["word"]): r["delta"] for r in best}
    model = Model(scores, 1.0, 0.0, 0.0, 1.0)

    def measured(batches):
        """Words, best segment and the number of each score's occurrences, as the sample has them."""
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = words(text)
                got = [s for s in map(scores.get, ws, repeat(0.0))]
                at = [i for i, s in enumerate(got) if s]
                top = max((s for s, _, _ in segments(at, [got[i] for i in at], DRIFT)), default=0.0)
                yield pa.record_batch([pa.array([y], pa.int32()), pa.array([len(ws)], pa.int64()), pa.array([top], pa.float64()),
                                       pa.array([len(at)], pa.int64()), pa.array([sum(got)], pa.float64())],
                                      ["y", "n", "top", "hits", "sum"])

    rows = picked.mapInArrow(measured, "y int, n long, top double, hits long, sum double").collect()
    clean = [r for r in rows if r["y"] == 0 and r["n"]]
    total = sum(r["n"] for r in clean)
    hits = sum(r["hits"] for r in clean)
    if scores and total:
        mean = sum(r["sum"] for r in clean) / hits if hits else sum(scores.values()) / len(scores)
        share = min(max(hits, 0.5) / total, 0.5 * -DRIFT / (mean - DRIFT))  # the mean score of clean text is negative
        model.decay = decay_of(np.array([1 - share, share]), np.array([DRIFT, mean]))
        # segments of at least the mean score per word of clean text give the factor of the law
        reached = max(0.5, sum(r["top"] >= mean for r in clean))
        model.log_factor = math.log(reached / total) + model.decay * mean
    weighed = picked.mapInArrow(lambda batches: weigh(batches, model), "y int, x double").collect()
    model.bias, model.slope = logistic(np.array([r["x"] for r in weighed]), np.array([r["y"] for r in weighed], float))
    return model


def weigh(batches, model: Model):
    for b in batches:
        x = [model.evidence(words(t)) for t in b.column(0).to_pylist()]
        yield pa.record_batch([b.column(1).cast(pa.int32()), pa.array(x, pa.float64())], ["y", "x"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` per row.

    Null and empty texts hold no evidence and get the score of none. Repeated
    rows give repeated results, an empty table an empty one. Texts of any length
    are scored whole; other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        m = shared.value
        for b in small(batches):
            all_words = [words(t) for t in b.column(2).to_pylist()]
            s = [m.score(ws) for ws in all_words]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32()),
                                   pa.array([len(m.passages(ws)) for ws in all_words], pa.int32())],
                                  ["doc_id", "held_out", "score", "predicted", "n_passages"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int, n_passages int")
