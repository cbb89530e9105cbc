"""The registered queries of this folder, each one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, exactdedup, licenses, linededup, packing, phrases, sharding, simhash, spotsigs, topk, toxicity, urlrules, whitening
from tillroll.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules that come with the query, as (verdict, rule).
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, capacity=4096, end_id=1)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.deduplicate(table(spark, sf_dir, "documents"), percent=80)
    return done.select(
        "doc_id",
        "n_lines",
        F.size("removed_lines").alias("n_removed"),
        F.array_join("removed_lines", ",").alias("removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantise(table(spark, sf_dir, "embeddings"), scale=1024)
    return topk.search(vectors.where(F.col("vec_id") % 100 == 0), vectors, k=10)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(table(spark, sf_dir, "embeddings"), count=8, scale=1024)
    return done.withColumn("deviation", F.col("deviation").cast("long"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.deduplicate(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), max_words=5, min_count=100, best=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_url_rules": op3_url_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_spotsigs": op6_spotsigs,
    "op7_top_k": op7_top_k,
    "op8_licenses": op8_licenses,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op7_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(generate_series(1, len(a.q)), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op12_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, CAST(count(*) OVER same AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: w[i:i + k - 1])) AS g
  FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), total AS (
  SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), cuts AS (
  SELECT c.lang, c.k, c.g, c.a, t.n, j, l.a AS l, r.a AS r,
         CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM f c
  JOIN (SELECT unnest([1, 2, 3, 4]) AS j) ON j < c.k
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:j]
  JOIN f r ON r.lang = c.lang AND r.g = c.g[j + 1:c.k]
  JOIN total t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), inner_parts AS (
  SELECT lang, g[1:k - 1] AS g, max(a) AS most FROM f WHERE k > 2 GROUP BY ALL
  UNION ALL
  SELECT lang, g[2:k] AS g, max(a) AS most FROM f WHERE k > 2 GROUP BY ALL
), contained AS (
  SELECT lang, g, max(most) AS most FROM inner_parts GROUP BY ALL
), ranked AS (
  SELECT o.lang, array_to_string(o.g, ' ') AS phrase, o.a, o.l, o.r, o.n, o.score,
         row_number() OVER (PARTITION BY o.lang ORDER BY o.score DESC, o.a DESC, array_to_string(o.g, ' ')) AS rank
  FROM lowest o LEFT JOIN contained c ON c.lang = o.lang AND c.g = o.g
  WHERE c.most IS NULL OR 100 * c.most < 100 * o.a
)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
""",
}
