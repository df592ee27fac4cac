"""The registered queries of the operators, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from egoline.llm import (
    decontaminate,
    hard_negatives,
    jaccard_join,
    pii,
    quality,
    sentencepiece_chunks,
    sharding,
    spelling,
    suffix_dedup,
    token_count,
    token_files,
    toxicity,
    url_rules,
)
from egoline.llm.common import documents
from egoline.session import shared_path

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the compiled counting transducer."""
    return token_count.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), limit=512)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return sentencepiece_chunks.digests(documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_join.groups(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and minimum-covariance-determinant outliers per language and source."""
    return quality.judge(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document words in any window of the benchmark's items."""
    return decontaminate.report(documents(spark, sf_dir), benchmark(spark, sf_dir), window=10)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data: proposed by pattern, confirmed by checksum, scored by context."""
    return pii.find(documents(spark, sf_dir))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that start at two places, removed everywhere."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files, written in order of id and read back."""
    path = shared_path(spark, "llm", "token-files")
    token_files.write(documents(spark, sf_dir), path, public_tokenizers.path(BYTE_BPE), end_id=2)
    return token_files.read(spark, path)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic passages as maximal scoring segments, calibrated by the extreme-value law."""
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimax contiguous partition of all documents into 16 shards."""
    return sharding.shard_documents(documents(spark, sf_dir), shards=16)


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed rules, and token combinations mined from the labelled pages, judge every URL."""
    pages, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "labels"))
    return url_rules.judge(pages, url_rules.mine(url_rules.labelled_pages(pages, labels)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each positive of an anchor the best rows of other labels within its band of scores."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=100, positives=5, negatives=10, low=30, high=90, label=label)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts with the frequent word that each is a variant of."""
    return spelling.variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_sentencepiece, op3_ngram_jaccard, op4_quality_rules, op5_decontamination, op6_pii,
    op7_suffix_dedup, op8_token_files, op9_toxicity, op10_sharding, op11_url_filters, op12_hard_negatives,
    op13_spelling_variants)}


def lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def marked(mark: str, part: str) -> str:
    return f"list_transform(regexp_extract_all({lowered(part)}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: '{mark}' || w)"


LOWER = lowered("coalesce(text, '')")
NORMAL = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Tokenizers, concentration steps, spans with checksums, suffix sorting, fitted models, hashed
#: orders and checksums of runs are beyond SQL; their queries are tested against brute force.
ORACLE: dict[str, str] = {
    "op3_ngram_jaccard": f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM w),
x AS (SELECT doc_id, unnest(s) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
r AS (SELECT doc_id, doc_id AS node FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.least AS component_id
FROM s JOIN (SELECT doc_id, min(node) AS least FROM r GROUP BY doc_id) m ON m.doc_id = s.doc_id""",

    "op5_decontamination": f"""WITH d AS (SELECT doc_id, {NORMAL} AS w FROM documents),
i AS (SELECT item_id, {NORMAL} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[p:p + least(10, len(w)) - 1] AS win
  FROM i, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(p) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, p, z.n, w[p:p + z.n - 1] AS win
  FROM (SELECT DISTINCT n FROM iw) z, d, unnest(generate_series(1, len(w))) AS u(p) WHERE p + z.n - 1 <= len(w)),
h AS (SELECT DISTINCT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
k AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM h, unnest(generate_series(p, p + n - 1)) AS u(q) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id""",

    "op11_url_filters": f"""WITH p AS (
  SELECT page_id, url, coalesce({lowered("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '(?s)://[^?#]*(.*)', 1), '') AS rest FROM pages),
d AS (
  SELECT page_id, url, host, path, list_distinct(list_concat({marked('h:', 'host')}, {marked('p:', 'path')}, {marked('q:', 'rest')})) AS has,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p),
l AS (SELECT doc_id, bool_or(coalesce(toxic = 1 OR quality = 0, false)) AS bad FROM labels GROUP BY doc_id),
t AS (SELECT page_id, bad, has FROM d JOIN l ON page_id = doc_id),
k AS (SELECT greatest({url_rules.MIN_URLS}, ceil({url_rules.MIN_SUPPORT} * count(*))) AS least FROM t),
c AS (SELECT token, list(page_id ORDER BY page_id) AS held, count(*) FILTER (bad) AS n_bad
      FROM (SELECT page_id, bad, unnest(has) AS token FROM t) GROUP BY token HAVING count(*) FILTER (bad) >= (SELECT least FROM k)),
i AS (SELECT min(token) AS item, list(token) AS members, held FROM c GROUP BY held),
b AS (SELECT t.page_id, t.bad, list_sort(list(item)) AS items
      FROM (SELECT unnest(held) AS page_id, item FROM i) x JOIN t ON t.page_id = x.page_id GROUP BY ALL),
s AS (SELECT bad, list_filter(items, lambda x, j: (m >> (j - 1)) & 1 = 1) AS items
      FROM b, unnest(generate_series(1, (1::BIGINT << len(items)) - 1)) AS u(m)),
r AS (SELECT items, count(*) FILTER (bad) / count(*) AS confidence FROM s GROUP BY items
      HAVING count(*) FILTER (bad) >= (SELECT least FROM k) AND count(*) FILTER (bad) / count(*) >= {url_rules.MIN_CONFIDENCE}),
least AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM r o WHERE o.items <> r.items AND list_has_all(r.items, o.items))),
w AS (SELECT confidence, list_sort(flatten(list(members))) AS tokens
      FROM (SELECT items, confidence, unnest(items) AS item FROM least) x JOIN i ON i.item = x.item GROUP BY items, confidence),
f AS (SELECT url, array_to_string(tokens, ' ') AS mined FROM (SELECT DISTINCT url, has FROM d WHERE rule IS NULL) u JOIN w ON list_has_all(has, tokens)
      QUALIFY row_number() OVER (PARTITION BY url ORDER BY confidence DESC, array_to_string(tokens, ' ')) = 1)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN mined IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, mined
FROM d LEFT JOIN f ON f.url = d.url""",

    "op12_hard_negatives": """WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM e WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS a, e.vec_id AS b, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
      FROM a JOIN e ON a.vec_id <> e.vec_id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b, s.b AS c, p.score AS ps, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a AS anchor_id, b AS positive_id, r::INTEGER AS rank, c AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE r <= 10""",
}
