"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavid.llm import pii, secrets
from stratavid.llm.common import documents, scratch
from stratavid.llm.exact_dedup import exact_groups
from stratavid.llm.fingerprint import edit_resistance
from stratavid.llm.mixing import mix
from stratavid.llm.neardup import Rule, near_groups
from stratavid.llm.negatives import mine
from stratavid.llm.packing import pack
from stratavid.llm.quality import score_documents, train
from stratavid.llm.substrings import without_repeats
from stratavid.llm.token_output import read_token_files, write_token_files
from stratavid.llm.warc import derivatives, responses
from stratavid.llm.whitening import whiten


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return edit_resistance(documents(spark, sf_dir))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = documents(spark, sf_dir)
    return pii.find_personal_data(docs, pii.train(docs))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component on word 3-shingles at a similarity of 0.85."""
    return near_groups(documents(spark, sf_dir), Rule(words=3, percent=85))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learned from the labels that are not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_documents(docs, labels, train(docs, labels))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens: one row per piece."""
    return pack(documents(spark, sf_dir)).drop("ids")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = documents(spark, sf_dir)
    return secrets.find_secrets(docs, secrets.train(docs))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    return exact_groups(documents(spark, sf_dir), keep="largest")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mixture of the sources at tempered weights."""
    placed = mix(documents(spark, sf_dir).select("doc_id", "source"))
    return placed.select(F.col("row.doc_id").alias("doc_id"), *placed.columns[1:])


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, from the token files written for all documents."""
    files = write_token_files(documents(spark, sf_dir), scratch(spark, "token-files"))
    return read_token_files(spark, files)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 20-word passages that start earlier elsewhere: counts and digest of what stays."""
    found = without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their first 32 principal components, each of unit variance."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, with the labels of every seventh moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", moved)
    return mine(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprint": op1_fingerprint,
        "op2_warc_derivatives": op2_warc_derivatives,
        "op3_personal_data": op3_personal_data,
        "op4_near_dedup": op4_near_dedup,
        "op5_quality": op5_quality,
        "op6_pack": op6_pack,
        "op7_secrets": op7_secrets,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_mix_sources": op9_mix_sources,
        "op10_token_output": op10_token_output,
        "op11_substring_dedup": op11_substring_dedup,
        "op12_whitening": op12_whitening,
        "op13_hard_negatives": op13_hard_negatives,
    }


OP8_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)
), later AS (
  SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN s n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": OP8_SQL, "op11_substring_dedup": OP11_SQL, "op13_hard_negatives": OP13_SQL}
