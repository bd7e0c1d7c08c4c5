"""From raw documents to token ids: quality, near-duplicates, decontamination, secrets, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from overspend.llm import bpe, decontaminate, neardup, quality, secrets
from overspend.llm.common import table, written


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that pass the fixed limits and are no outliers of their language and source."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that of the smallest id, and of rows that share it one.

    Rows are told apart by id and text, so rows without an id and rows that repeat an id with another text are documents of their own. Rows equal in both are
    copies, of which one stays. Rows without words are linked with nothing and all stay.
    """
    row = max(docs.columns, key=len) + "_row"
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = neardup.near_duplicates(keyed.select(row, "text"), words=5, percent=80, key=row)
    groups = found.groupBy(row).agg(F.min("component_id").alias("group"), F.max("n_shingles").alias("size"), F.count("*").alias("copies"))
    named = keyed.groupBy(row).agg(F.min("doc_id").alias("id")).join(groups, row)
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", F.col(row).alias("row"), "copies", "size")).alias("first")
    stay = written(named.groupBy("group").agg(first).select(F.col("first.row").alias(row), (F.expr("first.copies > 1 and first.size > 0")).alias("several")), "stay")
    once = keyed.join(stay.where("not several"), row, "left_semi")
    several = keyed.join(stay.where("several"), row, "left_semi").dropDuplicates([row])
    return once.unionByName(several).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a piece of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the text; all rows stay, and n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of each text; the ids are decoded in the same step and compared with the text."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs.select("doc_id", "text"), path, pattern, check=True)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("quality", drop_low_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_leaks), ("secrets", mask_secrets),
          ("byte_bpe", encode_bytes)]

#: Edit distances, outlier estimates and merges are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
