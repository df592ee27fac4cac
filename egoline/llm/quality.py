"""Quality rules: base rules and robust multivariate outliers (DataFrame functions only).

Per language and source (small ones are pooled, see ``pools``), the minimum covariance determinant (MCD) estimate of
location and scatter of five transformed statistics: several deterministic
starts (``STARTS``), each taken through concentration steps until its
determinant stops falling. A step keeps the half of the rows with the smallest
Mahalanobis distances and re-estimates mean and covariance from them. The start
of least determinant stays and is reweighted once: mean and covariance of all
rows within the 0.975 quantile. A document is rejected when its squared distance
under the final estimate exceeds ``CUTOFF``.

All statistics are mergeable aggregates (sums, ``percentile_approx``), so a
source that holds a third of all rows is combined map-side and never gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from egoline.llm.common import written
from egoline.session import ensure_checkpoint_dir

WORD_BREAK = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
#: Starts, all from medians and absolute deviations: no correlation; that of hyperbolic tangents, of spatial signs, of all
#: rows; and the covariance of the rows below the median of all standardised statistics' sum.
STARTS = ["plain", "tanh", "sign", "all", "low"]
#: A determinant that falls by a smaller share has stopped falling.
FALL = 1e-6
#: A step keeps (n + 6) / 2 of n rows, the subset of the highest breakdown in five dimensions, rounded up to a hundredth.
SHARES = [k / 100 for k in range(50, 101)]
#: Groups with fewer documents that pass the base rules are judged by the estimate of their language, and languages
#: with fewer by that of all documents.
MIN_GROUP = 30
#: Most pairs of language and source whose estimates (some 300 bytes each and start) are broadcast.
FEW = 5_000
#: Chi-square quantile with 5 degrees of freedom at 1 - 1e-9, at one half and at 0.975.
CUTOFF = 51.4
CHI_HALF = 4.351
CHI_NEAR = 12.833
#: Least standard deviation of each transformed statistic. Most clean texts have no
#: symbol and no repeated line at all, and a scatter of zero would reject the first that has one.
FLOORS = [0.06, 0.3, 0.12, 0.12, 0.3]
XS = ["x0", "x1", "x2", "x3", "x4"]
PAIRS = [(i, j) for i in range(5) for j in range(i + 1)]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the five counts, ``n_lines`` and ``n_upper``.

    The words in repeated three-word windows are found by sorting the window
    hashes with their positions: n log n in the words of the text.
    """
    t = docs.withColumn("_t", F.coalesce(text.cast("string"), F.lit("")))
    t = t.withColumn("_w", F.filter(F.split("_t", WORD_BREAK), lambda w: w != ""))
    t = t.withColumn("_l", F.filter(F.split("_t", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    t = t.withColumn("_n", F.size("_w"))
    t = t.withColumn("_h", F.when(F.col("_n") >= 3, F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_n") - 2, F.lit(1))),
        lambda i: F.xxhash64(F.element_at("_w", i), F.element_at("_w", i + 1), F.element_at("_w", i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    t = t.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform(
        F.col("_h"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    t = t.withColumn("_p", F.filter(F.transform(F.col("_s"), lambda e, k: F.when(
        ((k > 0) & (F.get("_s", k - 1)["h"] == e["h"])) | (F.get("_s", k + 1)["h"] == e["h"]), e["i"])),
        lambda i: i.isNotNull()))
    solid = F.translate("_t", " \t\n\x0b\x0c\r", "")
    return t.select(
        *[F.col(c) for c in docs.columns], F.col("_n").cast("long").alias("n_words"),
        F.length(solid).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(F.transform("_p", lambda i: F.array(i, i + 1, i + 2)))))
        .cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.length("_t") - F.length(F.translate("_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"))


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def transformed() -> list[Column]:
    """Logarithms and square roots bring the statistics near symmetry."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return [F.log(chars / words), F.log1p(F.col("n_symbols") * 100 / chars),
            F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
            F.sqrt(F.col("n_repeat_words") / words), F.log1p(F.col("n_upper") * 10 / chars)]


def distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance under the joined ``m*`` and ``s*``: the Cholesky factor, unrolled, in one row."""
    out, z = F.lit(0.0), []
    for i in range(5):
        zi = x[i] - F.col(f"m{i}")
        for j in range(i):
            zi = zi - F.col(f"c{i}{j}") * z[j]
        z.append(zi / F.col(f"c{i}{i}"))
        out = out + z[i] * z[i]
    return out


def factored(groups: DataFrame) -> DataFrame:
    """The lower Cholesky factor ``c*`` of the scatter ``s*``, floored on its diagonal, and the logarithm ``det`` of its determinant."""
    for i in range(5):
        for j in range(i + 1):
            v = F.col(f"s{i}{j}")
            for k in range(j):
                v = v - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            least = (FLOORS[i] ** 2) * 0.25  # rounding can leave a pivot at or below zero
            groups = groups.withColumn(f"c{i}{j}", F.sqrt(F.greatest(v, F.lit(least))) if i == j else v / F.col(f"c{j}{j}"))
    groups = groups.withColumn("det", sum((F.log(f"c{i}{i}") * 2 for i in range(5)), F.lit(0.0)))
    return groups.drop(*[f"s{i}{j}" for i, j in PAIRS])


def estimate() -> list[Column]:
    """Mean and floored covariance of a group's rows."""
    return [*[F.avg(c).alias(f"m{i}") for i, c in enumerate(XS)],
            *[(F.covar_pop(XS[i], XS[j]) + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(f"s{i}{j}") for i, j in PAIRS]]


def by_group(rows: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """Rows with what is known of their group. Up to ``FEW`` groups are broadcast, and no
    group's rows meet in one task; more are joined by a shuffle."""
    return rows.join(F.broadcast(groups) if few else groups, "g")


def pools(stats: DataFrame) -> DataFrame:
    """One row per language and source: the group ``g`` that judges its documents, and all groups ``into`` that count them.

    A group's name is the JSON list of its language and source, of its language
    alone, or of nothing for all documents; nulls are values of their own.
    """
    own, lang, every = F.to_json(F.array("lang", "source")), F.to_json(F.array("lang")), F.lit("[]")
    n = stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    of_lang = Window.partitionBy("lang")
    n = n.withColumn("n_lang", F.sum("n").over(of_lang)).withColumn("least", F.min("n").over(of_lang))
    small_lang = n.agg((F.min("n_lang") < MIN_GROUP).alias("any_small"))
    large, large_lang = F.col("n") >= MIN_GROUP, F.col("n_lang") >= MIN_GROUP
    into = F.array(F.when(large, own), F.when(large_lang & (F.col("least") < MIN_GROUP), lang), F.when(F.col("any_small"), every))
    return n.crossJoin(small_lang).select("lang", "source", F.when(large, own).when(large_lang, lang).otherwise(every).alias("g"),
                                          F.array_compact(into).alias("into")).checkpoint()


def pooled(rows: DataFrame, of: DataFrame, few: bool) -> DataFrame:
    of = (F.broadcast(of) if few else of).withColumnsRenamed({"lang": "_gl", "source": "_gs"})
    return rows.join(of, rows["lang"].eqNullSafe(of["_gl"]) & rows["source"].eqNullSafe(of["_gs"]), "left").drop("_gl", "_gs")


def starts(stats: DataFrame, few: bool) -> DataFrame:
    """A row per group and start: ``n``, location ``m*``, scatter ``s*``."""
    med = stats.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(x, 0.5, 10000).alias(f"m{i}") for i, x in enumerate(XS)]).checkpoint()
    mad = by_group(stats, med, few).groupBy("g").agg(
        F.first("n").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(5)],
        *[F.greatest(F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 10000) * 1.4826, F.lit(FLOORS[i])).alias(f"a{i}") for i, x in enumerate(XS)]).checkpoint()
    z = by_group(stats, mad, few).select("g", *XS, *[((F.col(x) - F.col(f"m{i}")) / F.col(f"a{i}")).alias(f"z{i}") for i, x in enumerate(XS)])
    size = F.greatest(F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(5)), F.lit(0.0))), F.lit(1e-9))
    z = z.withColumn("size", size).withColumn("sum", sum((F.col(f"z{i}") for i in range(5)), F.lit(0.0)))
    # written, or the planner repeats the terms in each of the 45 sums below
    z = written(z.select("*", *[F.tanh(f"z{i}").alias(f"tanh{i}") for i in range(5)], *[(F.col(f"z{i}") / F.col("size")).alias(f"sign{i}") for i in range(5)]), "standard")
    shape = {"tanh": "tanh", "sign": "sign", "all": "z"}
    made = z.groupBy("g").agg(F.percentile_approx("sum", 0.5, 10000).alias("half"), *[
        F.avg(F.col(f"{c}{i}") * F.col(f"{c}{j}")).alias(f"{name}{i}{j}") for name, c in shape.items() for i, j in PAIRS])
    made = made.join(mad, "g").checkpoint()
    out = []
    for name in STARTS[:4]:
        def cor(i, j, name=name):
            if i == j or name == "plain":
                return F.lit(float(i == j))
            over = F.sqrt(F.col(f"{name}{i}{i}") * F.col(f"{name}{j}{j}"))
            return F.when(over > 0, F.col(f"{name}{i}{j}") / over).otherwise(0.0)
        out.append(made.select("g", "n", F.lit(name).alias("start"), *[f"m{i}" for i in range(5)],
                               *[(cor(i, j) * F.col(f"a{i}") * F.col(f"a{j}")).alias(f"s{i}{j}") for i, j in PAIRS]))
    low = by_group(z, made.select("g", "n", "half"), few).filter(F.col("sum") <= F.col("half")).groupBy("g").agg(F.first("n").alias("n"), *estimate())
    out.append(low.withColumn("start", F.lit(STARTS[4])).select(*out[0].columns))
    return reduce(DataFrame.unionByName, out)


FITTED = ["det", *[f"m{i}" for i in range(5)], *[f"c{i}{j}" for i, j in PAIRS]]


def concentrated(stats: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """One concentration step of each group and start: the estimate from the rows nearest to the ``last`` one.

    Written rather than checkpointed: a checkpoint keeps the planner's constraints, which double with every step.
    """
    x = [F.col(c) for c in XS]
    share = F.least(F.ceil((F.col("n") + 6) * 50 / F.col("n")) - 49, F.lit(len(SHARES))).cast("int")
    cut = by_group(stats, groups, few).groupBy("g", "start").agg(F.element_at(F.percentile_approx(distance(x), SHARES, 10000), F.first(share)).alias("cut"))
    cut = groups.join(written(cut, "cuts"), ["g", "start"])
    near = by_group(stats, cut, few).filter(distance(x) <= F.col("cut"))
    return written(factored(near.groupBy("g", "start").agg(F.first("n").alias("n"), F.first(F.struct(*FITTED)).alias("last"), *estimate())), "step")


def scaled(stats: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """``groups`` with the consistency factor ``k``: their rows' median distance over that of the normal law, one at least."""
    near = by_group(stats, groups, few).withColumn("d", distance([F.col(c) for c in XS]))
    scale = near.groupBy("g").agg(F.greatest(F.percentile_approx("d", 0.5, 10000) / CHI_HALF, F.lit(1.0)).alias("k"))
    return by_group(groups, scale.checkpoint(), few)


def mcd(stats: DataFrame, few: bool) -> DataFrame:
    """One row per group ``g``: location ``m*``, factor ``c*`` and the scale ``k`` of its distances.

    Starts whose determinant has stopped falling take no part in further steps.
    The first step of a start always counts, as it only then has a subset.
    """
    active, settled = concentrated(stats, written(factored(starts(stats, few)), "starts"), few).drop("last"), []
    falls = F.col("det") < F.col("last.det") - FALL
    while not settled or not active.isEmpty():
        after = concentrated(stats, active, few)
        settled.append(after.filter(~falls).select("g", "start", "last.*"))
        active = after.filter(falls).drop("last")
    ends = reduce(DataFrame.unionByName, settled)
    best = scaled(stats, ends.groupBy("g").agg(F.min(F.struct(*FITTED)).alias("b")).select("g", "b.*").checkpoint(), few)
    near = by_group(stats, best, few).filter(distance([F.col(c) for c in XS]) <= F.col("k") * CHI_NEAR)
    return scaled(stats, factored(near.groupBy("g").agg(*estimate())).checkpoint(), few).drop("det")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with counts, ``base_failed``, ``distance`` and ``kept``.

    A null text has no words and fails the base rules. Null languages and
    sources are groups of their own. Groups of fewer than ``MIN_GROUP``
    documents that pass the base rules are judged by their language, smaller
    languages by all documents. Only documents of a group with no document that
    passes the base rules have a null distance. Repeated rows are judged one by
    one, alike, texts of any length whole. Columns that are not kept are ignored,
    whatever their names; kept ones may have any name but those of the result.
    An empty table gives an empty result.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    named = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col(lang_col).cast("string").alias("lang"),
                        F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("_text"))
    rows = base_counts(named, F.col("_text")).drop("_text").withColumn("base_failed", failed())
    rows = written(rows.select("*", *[x.alias(XS[i]) for i, x in enumerate(transformed())]), "quality")
    stats = rows.filter(~F.col("base_failed")).select("lang", "source", *XS)
    of = pools(stats)
    few = of.count() <= FEW
    groups = mcd(written(pooled(stats, of, few).select(F.explode("into").alias("g"), *XS), "pools"), few)
    out = pooled(rows, by_group(of.select("lang", "source", "g"), groups, few), few).withColumn("distance", distance([F.col(c) for c in XS]) / F.col("k"))
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], *COUNTS, "base_failed", "distance",
                      (~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= CUTOFF))).alias("kept"))
