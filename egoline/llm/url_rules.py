"""URL verdicts by fixed rules and mined token combinations (DataFrame functions and Spark's FP-growth only).

A fixed rule names a host and the beginning of a path; it fits its host and all
subdomains, and the longest fitting one decides. Every other URL is judged by
association rules: FP-growth finds token combinations that are frequent among
labelled URLs together with the label "bad", and those above a confidence are
kept. A combination that holds another kept one is dropped, since the smaller
one decides the same. The rules are matched by an inverted index: each is filed
under its rarest token, a URL looks up its own tokens, and the rules found are
compared whole.

Tokens that occur in exactly the same labelled URLs are mined as one item.
Otherwise one long URL with many copies would have a frequent set for each
subset of its tokens. A rule asks for all tokens of such an item.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import written

#: The rules that the task fixes: verdict, host, beginning of the path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Least share of the labelled URLs, and least number, that hold a combination and are bad; least share of bad ones among its holders.
MIN_SUPPORT, MIN_URLS, MIN_CONFIDENCE = 0.001, 20, 0.6

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BAD = "label:bad"
MINED = "id string, tokens array<string>, key string, confidence double, n_bad long"


def lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host(url: Column) -> Column:
    return F.coalesce(lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct words of host (``h:``), path (``p:``) and the rest (``q:``), lower-cased; none without a host part."""
    def marked(mark, part):
        return F.transform(F.regexp_extract_all(lower(part), F.lit(TOKEN), F.lit(0)), lambda t: F.concat(F.lit(mark), t))
    rest = F.regexp_extract(url, "(?s)://[^?#]*(.*)", 1)
    return F.coalesce(F.array_distinct(F.concat(marked("h:", host(url)), marked("p:", path(url)), marked("q:", rest))),
                      F.array().cast("array<string>"))


def fixed_rule(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, nulls if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):  # the last one asked wins
        fits = ((h == rule_host) | h.endswith(f".{rule_host}")) & p.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def mine(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_support: float = MIN_SUPPORT,
         min_urls: int = MIN_URLS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``id, tokens, key, confidence, n_bad`` of the minimal token combinations that tell bad URLs.

    Every row of ``labelled`` counts, repeated ones too; a null label counts as
    not bad, a null URL has no tokens. An empty table, or one without a frequent
    combination, gives no rules.
    """
    spark = labelled.sparkSession
    rows = written(labelled.select(F.monotonically_increasing_id().alias("row"), tokens(F.col(url_col)).alias("tokens"),
                                   F.coalesce(F.col(bad_col).cast("boolean"), F.lit(False)).alias("bad")), "url-labelled")
    least = max(min_urls, 1, -int(-min_support * rows.count() // 1))
    held = rows.select("row", "bad", F.explode("tokens").alias("token"))
    # two 64-bit hashes of the rows that hold a token, summed, tell which tokens always come together
    held_by = [F.sum(F.xxhash64("row", F.lit(k)).cast("decimal(38,0)")).alias(f"rows{k}") for k in range(2)]
    classes = (held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"), *held_by)
               .filter(F.col("n_bad") >= least)
               .groupBy("n", "rows0", "rows1").agg(F.sort_array(F.collect_list("token")).alias("members")))
    classes = written(classes.select(F.col("members")[0].alias("item"), "members", "n"), "url-items")
    baskets = held.join(classes.select(F.col("item").alias("token")), "token").groupBy("row", "bad").agg(F.collect_list("token").alias("items"))
    baskets = written(baskets.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items")), "url-baskets")
    n = baskets.count()
    if not n:
        return spark.createDataFrame([], MINED)
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
             .select(F.array_sort("antecedent").alias("items"), "confidence", F.round(F.col("support") * n).cast("long").alias("n_bad"))
             .withColumn("id", F.array_join("items", " ")))
    rules = written(rules, "url-rules")
    whole = (rules.select("id", F.explode("items").alias("item")).join(classes, "item")
             .groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens"),
                                F.min(F.struct("n", "item")).alias("rarest")))
    # a rule is dropped if another one's items are among its own
    inner = rules.select(F.col("id").alias("inner_id"), F.col("items").alias("inner_items"), F.col("items")[0].alias("item"))
    over = (rules.select("id", "items", F.explode("items").alias("item")).join(inner, "item")
            .filter((F.col("id") != F.col("inner_id")) & (F.size(F.array_except("inner_items", "items")) == 0)).select("id"))
    return written(rules.join(over, "id", "left_anti").join(whole, "id")
                   .select("id", "tokens", F.col("rarest.item").alias("key"), "confidence", "n_bad"), "url-mined")


def matches(urls: DataFrame, mined: DataFrame, url_col: str = "url") -> DataFrame:
    """``url, mined`` for each distinct URL that a mined rule fits: the rule of most confidence, ties by its text."""
    u = urls.select(F.col(url_col).alias("url")).select("url", tokens(F.col("url")).alias("has"))
    found = (u.select("url", "has", F.explode("has").alias("key")).join(mined, "key")
             .filter(F.size(F.array_except("tokens", "has")) == 0))
    return found.groupBy("url").agg(F.min(F.struct(-F.col("confidence"), F.array_join("tokens", " "))).getField("col2").alias("mined"))


def judge(pages: DataFrame, mined: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` per row of ``pages``.

    ``mined`` (from :func:`mine`) names the tokens of the combination that
    blocked the URL, null where a fixed rule decided or none matched; without
    either the verdict is allow. A null URL or one without ``://`` has an empty
    host and path and is allowed. Repeated rows are judged alike, null ids are
    kept, URLs of any length are taken whole, an empty table gives an empty
    result; columns other than the id and the URL are ignored.
    """
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    d = d.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    d = d.withColumn("rule", name).withColumn("fixed", verdict)
    hits = written(matches(d.filter("rule IS NULL"), mined), "url-matches")  # written first: a hot URL's rows can be split at the join
    return (d.join(hits, "url", "left")
            .select("page_id", "host", "path", "rule",
                    F.when(F.col("rule").isNotNull(), F.col("fixed")).when(F.col("mined").isNotNull(), "block").otherwise("allow").alias("verdict"),
                    "mined"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, bad``: a page's label is the ``labels`` row of its id; toxic or of low quality is bad, on any of several rows."""
    bad = labels.groupBy("doc_id").agg(F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))).alias("bad"))
    return pages.select("page_id", "url").join(bad, F.col("page_id") == F.col("doc_id")).select("url", "bad")
