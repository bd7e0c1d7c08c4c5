"""Registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from overspend.llm import bpe, chat, decontaminate, hilbert, negatives, neardup, pii, quality, repeats, secrets, tokencounts, warc, whitening
from overspend.llm.common import table
from overspend.llm.vectors import is_finite, whole

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, folder, "documents")))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), words=4)


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, folder, "documents")))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"), keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.attribute(table(spark, folder, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return pii.digest(pii.scan(documents, pii.fit_field(documents)))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    stored = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = chat.threads(stored.unionByName(probe))
    back = chat.read_back(chat.format_paths(messages, chat.paths(messages, best=1)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return back.select(F.col("tree.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    rows = table(spark, folder, "embeddings").where(is_finite("embedding")).select(
        vec_id.cast("long").alias("id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), whole("embedding", 256).alias("x"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    sharded = hilbert.shard_documents(table(spark, folder, "documents"), shards=24, law="rows")
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                          "curve")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").where(is_finite("embedding")).select(F.col("vec_id").alias("id"), whole("embedding", 64, 1_000_000).alias("x"))
    return whitening.whiten(rows, components=16, fill=1_000_000).withColumnRenamed("id", "vec_id")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     g AS (SELECT html, max(page_id) AS top FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.top > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.top > p.page_id THEN g.top END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html"""

OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_extract_all(role || chr(10) || chr(10) || text,
           '<\|(?:im_start|im_end|endoftext|system|user|assistant|eot_id)\||</?s>|<</?SYS>>|\[/?INST\]|\\'))
           + length(role) - length(replace(role, chr(10), '')) AS added
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + added + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 80 * positive_score AND 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_decontaminate, op2_repeats, op3_near_duplicates, op4_secrets, op5_byte_bpe, op6_quality, op7_warc,
                                                     op8_token_counts, op9_personal_data, op10_chat, op11_hard_negatives, op12_hilbert_shards,
                                                     op13_whitening)}
ORACLES = {"op7_warc": OP7_SQL, "op10_chat": OP10_SQL, "op11_hard_negatives": OP11_SQL}
