"""Registered queries of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fundtide.llm import (
    decontamination,
    hmm,
    language,
    merkle,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    revisits,
    sql,
    suffix_dedup,
    textops,
    token_files,
    toxicity,
    variants,
)
from fundtide.sources.workspace import materialized

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where that folder exists on the executors (local runs, a shared installation);
    elsewhere ship the package with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


#: How Python workers give memory back: large arrays to the system as soon as they are free,
#: so that what one stage needed is not held through the next ones.
ALLOCATION = {
    "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}

#: Rows and bytes that a Python worker is sent at a time.  Texts are long, and the executor's
#: JVM and the worker each hold such a batch.
ARROW_ROWS, ARROW_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """What the operators expect of a session."""
    workers_find_package(spark)
    for name, value in ALLOCATION.items():
        spark.sparkContext.environment.setdefault(name, value)
    textops.take_back()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def _query(key: str, oracle: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(spark, sf_dir)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op4_token_ids")
def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.token_file_digest(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@_query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@_query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.assess(docs, quality_rules.fit_field(docs, _table(spark, sf_dir, "labels")))


@_query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


@_query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@_query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


@_query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs, _table(spark, sf_dir, "labels")))


@_query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents"))


@_query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return decontamination.matches(docs, decontamination.Index.build(docs, _table(spark, sf_dir, "benchmark")))


@_query("op11_variants", sql.VARIANTS_SQL)
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.vocabulary(_table(spark, sf_dir, "documents")))


@_query("op12_merkle", sql.MERKLE_SQL)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_tampered(_table(spark, sf_dir, "documents"))


@_query("op13_lm_score")
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(_table(spark, sf_dir, "documents"))


@_query("op6_revisits", """
WITH page AS (
  SELECT page_id, url, md5(html) AS digest, CAST(length(html) AS VARCHAR) AS size, page_id * 60 AS fetched,
    '"' || substr(md5(html), 1, 16) || '"' AS tag, regexp_replace(url, '#.*$', '') AS bare
  FROM pages),
revisit AS (
  SELECT page_id * 4 + 1 AS record_id, fetched + 30 AS captured_at,
    regexp_replace(bare, '^https?://', 'HTTPS://WWW.') || CASE WHEN contains(bare, '?') THEN '&' ELSE '?' END
      || 'utm_medium=again#x' AS url,
    CASE WHEN page_id % 5 = 0 THEN 'W/"changed"' ELSE 'W/' || tag END AS etag, NULL AS modified,
    'max-age=600' AS cache
  FROM page
  UNION ALL
  SELECT page_id * 4 + 2, fetched + 7200, url, NULL,
    CAST(CASE WHEN page_id % 3 = 0 THEN fetched + 7200 ELSE fetched - 3600 END AS VARCHAR), NULL FROM page
  UNION ALL
  SELECT page_id * 4 + 3, fetched - 10, url, tag, NULL, NULL FROM page WHERE page_id % 9 = 0),
bare_urls AS (
  SELECT record_id, captured_at, 'revisit' AS kind, regexp_replace(regexp_replace(trim(url), '#.*$', ''),
    '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM revisit
  UNION ALL
  SELECT page_id * 4, fetched, 'response', regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://', '') FROM page),
keyed AS (
  SELECT record_id, captured_at, kind,
    regexp_replace(lower(regexp_extract(split_part(bare, '?', 1), '^([^/]*)', 1)), '^www[.]|:(80|443)$', '', 'g')
    || regexp_replace(regexp_extract(split_part(bare, '?', 1), '^[^/]*(.*)$', 1), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical_url
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '[?](.*)$', 1), '&'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))) AS params FROM bare_urls)),
latest AS (
  SELECT v.record_id, v.canonical_url, v.captured_at, arg_max(p.record_id, p.captured_at * 1000000000 + p.record_id) AS refers_to
  FROM (SELECT * FROM keyed WHERE kind = 'revisit') v
  LEFT JOIN (SELECT * FROM keyed WHERE kind = 'response') p
    ON p.canonical_url = v.canonical_url AND p.captured_at < v.captured_at
  GROUP BY 1, 2, 3),
judged AS (
  SELECT a.*, r.etag, r.modified, r.cache, p.tag, p.digest, p.size, CAST(p.fetched - 3600 AS VARCHAR) AS stored_modified,
    CASE WHEN a.refers_to IS NULL THEN 'no_earlier_response'
      WHEN r.etag IS NOT NULL THEN
        CASE WHEN regexp_replace(r.etag, '^W/', '') = p.tag THEN 'resolved' ELSE 'validator_mismatch' END
      WHEN r.modified = CAST(p.fetched - 3600 AS VARCHAR) THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM latest a JOIN revisit r USING (record_id) LEFT JOIN page p ON p.page_id * 4 = a.refers_to)
SELECT record_id, canonical_url, captured_at, outcome, refers_to,
  CASE WHEN outcome = 'resolved' THEN digest END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN 'cache-control: ' || coalesce(cache, 'max-age=60') || chr(10)
    || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || captured_at || chr(10) || 'etag: ' || coalesce(etag, tag) || chr(10)
    || 'last-modified: ' || coalesce(modified, stored_modified) END AS merged_headers
FROM judged""")
def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = materialized(revisits.captures(_table(spark, sf_dir, "pages")), "captures")
    found = revisits.resolve(records)
    return found.withColumn("merged_headers", revisits.header_lines(found["headers"])).drop("headers")
