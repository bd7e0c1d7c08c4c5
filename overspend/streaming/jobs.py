"""Streams built from the same functions as the batch operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from overspend.operators.clean import parse_records, to_silver
from overspend.sources.writers import upsert

ARRIVAL = ["kafka_timestamp", "partition", "offset"]


def total_cost(df: DataFrame) -> DataFrame:
    """Fare plus tip, keeping rows above zero; for batch and stream alike."""
    summed = df.withColumn("total_cost", F.col("fare_amount") + F.col("tip_amount"))
    return summed.where(F.col("total_cost") > 0)


def window_counts(df: DataFrame, moment: str, key: str, length: str = "10 minutes", slide: str = "5 minutes",
                  late: str = "10 minutes") -> DataFrame:
    """Rows per key in sliding windows; rows later than ``late`` are left out of a stream in append mode."""
    timed = df.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, late)
    counted = timed.groupBy(F.window(moment, length, slide).alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")


def append_stream(df: DataFrame, path: str, checkpoint: str, by: str | None = None) -> StreamingQuery:
    """Append all available rows to a Parquet table, each exactly once; ``by`` names a column whose values become folders.

    Windows are appended when the watermark has passed their end and are then dropped from the state, so state and writes follow the open
    windows, not all windows so far.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer if by is None else writer.partitionBy(by)).start(path)


def batch_stream(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                 mode: str = "append") -> StreamingQuery:
    """Hand each micro-batch and its number to ``handle``."""
    return (df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def update_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that each micro-batch changed to a folder of its own, over those of the same batch before a restart.

    Windows that the watermark has passed leave the state; those still open are in the table as far as they have been counted. ``newest`` reads it.
    """
    def handle(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return batch_stream(df, handle, checkpoint, mode="update")


def newest(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of each key in a table of changes by batch."""
    rest = [F.col(c) for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("row")).select(*keys, "row.*")


def silver_stream(records: DataFrame, path: str, checkpoint: str, buckets: int | None = None, strict: bool = False) -> StreamingQuery:
    """Topic records to parsed, valid contracts, upserted by id; a repeated batch changes nothing."""
    silver = to_silver(parse_records(records), strict)

    def handle(rows: DataFrame, number: int) -> None:
        # The query's own id tells a new stream, which counts from 0 again, from a restarted one.
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert(rows, path, "id_contrato", ARRIVAL, buckets, f"{stream}-{number}")

    return batch_stream(silver, handle, checkpoint)


def replace_table(path: str) -> Callable[[DataFrame, int], None]:
    """Handler for complete mode: the newest result replaces the last one."""
    def handle(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(path)

    return handle


def run(query: StreamingQuery) -> None:
    query.awaitTermination()
