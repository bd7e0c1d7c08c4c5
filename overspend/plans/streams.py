"""Streams over the stored tables, run to the end of the available data."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from overspend import schemas
from overspend.functions.times import epoch_seconds
from overspend.operators import clean, models
from overspend.operators.lookup import join_region
from overspend.plans.columns import REGION_ROWS
from overspend.plans.domain import BRONZE, SILVER, department_of, department_sql, records, table
from overspend.plans.registry import query
from overspend.session import shared_dir
from overspend.sources import readers, writers
from overspend.streaming import jobs


def event_stream(spark, sf):
    """The events file as a stream."""
    return readers.stream_files(spark, sf, schemas.EVENT, name_pattern="events.parquet")


def record_stream(spark, sf, rows_per_file: int = 60_000, files_per_batch: int = 32):
    """Topic records as a stream of files, written by as many tasks as the scan has; the files of a micro-batch are read side by side."""
    folder = shared_dir(spark, "topic")
    records(spark, sf).write.option("maxRecordsPerFile", rows_per_file).parquet(folder)
    return readers.stream_files(spark, folder, schemas.TOPIC_RECORD, files_per_batch=files_per_batch)


def finished(spark, stream, purpose: str):
    """Append the stream to a table, wait for its end and read the table."""
    folder = shared_dir(spark, purpose)
    jobs.run(jobs.append_stream(stream, f"{folder}/table", f"{folder}/checkpoint"))
    return readers.read_table(spark, f"{folder}/table")


def costs(df):
    """Fare and tip of an event; some totals are zero or below."""
    return df.select("event_id", (F.col("value") - 5).alias("fare_amount"),
                     (F.col("event_id") % 10).cast("double").alias("tip_amount"))


COSTS = """costs AS (SELECT event_id, value - 5 AS fare_amount, CAST(event_id % 10 AS DOUBLE) AS tip_amount,
  value - 5 + CAST(event_id % 10 AS DOUBLE) AS total_cost FROM events)"""


@query("bronze_stream", f"""WITH {BRONZE} SELECT id_contrato, valor_contrato, fecha_firma, "partition", "offset" FROM bronze""")
def bronze_stream(spark, sf):
    parsed = clean.parse_records(record_stream(spark, sf))
    return finished(spark, parsed.select("id_contrato", "valor_contrato", "fecha_firma", "partition", "offset"), "bronze")


@query("stream_sink", "SELECT event_id, event_type, value FROM events")
def stream_sink(spark, sf):
    return finished(spark, event_stream(spark, sf).select("event_id", "event_type", "value"), "events")


@query("stream_transform", f"WITH {COSTS} SELECT * FROM costs WHERE total_cost > 0")
def stream_transform(spark, sf):
    return finished(spark, jobs.total_cost(costs(event_stream(spark, sf))), "costs")


@query("stream_transform_batch", f"WITH {COSTS} SELECT * FROM costs WHERE total_cost > 0")
def stream_transform_batch(spark, sf):
    return jobs.total_cost(costs(table(spark, sf, "events")))


WINDOWS = """WITH starts AS (
  SELECT event_type, ts, unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE])
    AS window_start FROM events)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS n
FROM starts GROUP BY ALL"""


def _plain_times(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_window_count", WINDOWS)
def stream_window_count(spark, sf):
    """All windows: each micro-batch writes those it changed, the last count of a window holds, and the state keeps open windows only."""
    folder = shared_dir(spark, "windows")
    counted = jobs.window_counts(event_stream(spark, sf), "ts", "event_type")
    jobs.run(jobs.update_stream(counted, f"{folder}/table", f"{folder}/checkpoint"))
    return _plain_times(jobs.newest(readers.read_table(spark, f"{folder}/table"), ["window_start", "window_end", "event_type"]))


@query("window_count_batch", WINDOWS)
def window_count_batch(spark, sf):
    return _plain_times(jobs.window_counts(table(spark, sf, "events"), "ts", "event_type"))


@query("stream_checkpoint", f"WITH {COSTS} SELECT * FROM costs WHERE total_cost > 0")
def stream_checkpoint(spark, sf):
    """The stream is stopped after half of the files and started again from its checkpoint."""
    folder = shared_dir(spark, "restart")
    events = table(spark, sf, "events")
    half = F.col("event_type").isin("click", "view")
    for part in (events.where(half), events.where(~half)):
        writers.append(part, f"{folder}/in")
        source = readers.stream_files(spark, f"{folder}/in", schemas.EVENT)
        jobs.run(jobs.append_stream(jobs.total_cost(costs(source)), f"{folder}/table", f"{folder}/checkpoint"))
    return readers.read_table(spark, f"{folder}/table")


@query("stream_to_silver", f"""WITH {SILVER} SELECT id_contrato, objeto_contrato, entidad, valor_contrato, duracion_dias,
  fecha_firma, estado_contrato, anno, "partition", "offset" FROM silver""")
def stream_to_silver(spark, sf):
    folder = shared_dir(spark, "silver-stream")
    jobs.run(jobs.silver_stream(record_stream(spark, sf), f"{folder}/table", f"{folder}/checkpoint"))
    return writers.read_upserted(spark, f"{folder}/table").select(
        "id_contrato", "objeto_contrato", "entidad", "valor_contrato", "duracion_dias", "fecha_firma",
        "estado_contrato", "anno", "partition", "offset")


@query("stream_region_join", f"""WITH dictionary(departamento, region) AS (VALUES {REGION_ROWS}),
placed AS (SELECT event_id, {department_sql('user_id')} AS departamento FROM events)
SELECT event_id, p.departamento, coalesce(d.region, 'Desconocida') AS region
FROM placed p LEFT JOIN dictionary d ON p.departamento = d.departamento""")
def stream_region_join(spark, sf):
    placed = event_stream(spark, sf).select("event_id", department_of(F.col("user_id")).alias("departamento"))
    return finished(spark, join_region(placed), "regions")


@query("stream_metadata", f"""WITH {BRONZE} SELECT id_contrato, "partition", "offset", sent_at AS kafka_timestamp FROM bronze""")
def stream_metadata(spark, sf):
    parsed = clean.parse_records(record_stream(spark, sf)).select("id_contrato", "partition", "offset", "kafka_timestamp")
    return finished(spark, parsed, "metadata").withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


@query("stream_score", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM events")
def stream_score(spark, sf):
    """A fitted model scores the stream as it scores the stored table."""
    def prepared(df):
        return df.select("event_id", F.col("value").alias("label"), F.hour("ts").alias("hora"),
                         (epoch_seconds(F.col("ts")) % 3600).alias("segundo"))

    stored = prepared(table(spark, sf, "events"))
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=["hora", "segundo"], outputCol="features"), models.linear(regParam=0.0),
    ]).fit(stored)
    scored = fitted.transform(prepared(event_stream(spark, sf))).select("event_id", F.col("prediction").alias("streamed"))
    streamed = finished(spark, scored, "scores")
    both = streamed.join(fitted.transform(stored).select("event_id", "prediction"), "event_id")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("streamed") != F.col("prediction")).alias("n_different"))


SINCE = "(SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1999-01-01')"


@query("incremental_select", f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {SINCE}")
def incremental_select(spark, sf):
    orders = table(spark, sf, "orders")
    done = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    since = clean.high_watermark(done, "o_orderdate", F.lit("1970-01-01").cast("timestamp_ntz"))
    return clean.newer_than(orders, "o_orderdate", since).select("o_orderkey", "o_orderdate")


@query("incremental_select_inclusive", f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= {SINCE}")
def incremental_select_inclusive(spark, sf):
    orders = table(spark, sf, "orders")
    done = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    since = clean.high_watermark(done, "o_orderdate", F.lit("1970-01-01").cast("timestamp_ntz"))
    return clean.newer_than(orders, "o_orderdate", since, inclusive=True).select("o_orderkey", "o_orderdate")
