"""Bounded and unbounded reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

KAFKA = {"failOnDataLoss": "false"}


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def even_out(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Spread rows over ``parts`` tasks where the caller knows that a file has few row groups; without a number nothing is done."""
    return df if parts is None else df.repartition(parts)


def scan_many(spark: SparkSession, pattern: str, base: str | None = None) -> DataFrame:
    """All files that match a pattern as one table; ``base`` keeps partition columns."""
    reader = spark.read
    if base:
        reader = reader.option("basePath", base)
    return reader.parquet(pattern)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table in any installed format."""
    return spark.read.format(fmt).load(path)


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """A bounded read of a topic; needs the Kafka connector on the class path."""
    reader = spark.read.format("kafka").options(**KAFKA, **options)
    return reader.options(**{"kafka.bootstrap.servers": servers}, subscribe=topic, startingOffsets=starting).load()


def stream_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """An unbounded read of a topic; positions live in the query's checkpoint."""
    reader = spark.readStream.format("kafka").options(**KAFKA, **options)
    return reader.options(**{"kafka.bootstrap.servers": servers}, subscribe=topic, startingOffsets=starting).load()


def stream_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                 name_pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """An unbounded read of files as they appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)
