"""The training-data queries and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift.llm import bpe_automaton, media, near_dedup, packing, period_runs, sharding, substring_dedup, token_alignment, token_counts, toxicity, url_filter, vector_search, web_archives
from roadsift.llm.common import read_table, sha256_text, utf8_crc32

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
N_SHARDS = 24
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffle_into_shards(read_table(spark, sf_dir, "documents").select("doc_id", "text"), N_SHARDS)
    text = F.col("record.text")
    return out.select(F.col("record.doc_id").alias("doc_id"), sharding.record_size(text).alias("size"), utf8_crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "dedup.n_words", "dedup.n_removed", sha256_text(F.col("dedup.kept")).alias("kept_sha256"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), RULES)


OP3_SQL = """
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw_host, coalesce(rest, '') AS rest FROM a),
c AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT page_id, host, path, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM c)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM d
"""


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_automaton.encode_texts(read_table(spark, sf_dir, "documents"), WORD_BPE)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_text(ids).alias("ids_sha256"), sha256_text(F.col("decoded")).alias("decoded_sha256"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(read_table(spark, sf_dir, "documents"), WORD_BPE)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), BYTE_BPE)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_search.search(rows, rows.filter("vec_id % 20 = 0"), k=20)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score_texts(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", (toxicity.remainder(F.col("doc_id")) == toxicity.HELD_OUT).alias("held_out"), "score", "predicted")


def periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places of words that a tenth of the documents, chosen by a hash, repeat with a period; null ids are left as they are."""
    told = zlib.crc32(str(doc_id).encode())
    if doc_id is None or told % 10 or not n:
        return None
    told //= 10
    first = told % n
    period = 1 + (n - first) // (3 + told % 8)
    place = np.arange(n)
    place[first:] = first + (place[first:] - first) % period
    return place


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_runs.run_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=24, min_periods=3, reorder=periodic)


def op12_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archives.archive_pages(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_alignment.align_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE, PIECE_BPE, digest=True)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_sharding, op2_substring_dedup, op3_url_filters, op4_bpe, op5_near_dedup, op6_packing, op7_token_counts, op8_vector_search, op9_media, op10_toxicity, op11_period_runs, op12_web_archives, op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filters": OP3_SQL}
