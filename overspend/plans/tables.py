"""Reads, writes, keyed upserts and saved models."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from overspend.operators import clean, models, trips as trip_ops
from overspend.operators.anomaly import detect_by_group
from overspend.operators.lookup import payment_table
from overspend.plans.columns import PAYMENT_ROWS
from overspend.plans.domain import (
    FAULTY, faulty_events,
    BRONZE, CLEAN, CONTRACTS, FARES, JUDGED, contracts, fares, judged_events, records, rounded, table,
    trips,
)
from overspend.plans.registry import query
from overspend.session import shared_dir
from overspend.sources import readers, writers


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf):
    return readers.scan(spark, f"{sf}/orders.parquet")


@query("scan_parquet_multi", """SELECT CAST(month(o_orderdate) AS INTEGER) AS mes, count(*) AS n,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def scan_parquet_multi(spark, sf):
    folder = shared_dir(spark, "monthly")
    orders = table(spark, sf, "orders").withColumn("mes", F.month("o_orderdate"))
    writers.write_partitions(orders, folder, "mes")
    months = readers.scan_many(spark, f"{folder}/mes=*", base=folder)
    return months.groupBy("mes").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("write_monthly", f"WITH {CLEAN} SELECT mes, count(*) AS n, round(avg(trip_distance), 6) AS distancia, "
                        "max(tpep_pickup_datetime) AS ultimo FROM clean GROUP BY mes")
def write_monthly(spark, sf):
    """Every month is written, then the first half of the year once more: the table does not change."""
    folder = shared_dir(spark, "clean-trips")
    cleaned = trip_ops.clean_trips(trips(spark, sf))
    writers.write_partitions(cleaned, folder, "mes")
    writers.write_partitions(cleaned.where(F.col("mes") <= 6), folder, "mes")
    return readers.scan(spark, folder).groupBy("mes").agg(
        F.count("*").alias("n"), F.round(F.avg("trip_distance"), 6).alias("distancia"),
        F.max("tpep_pickup_datetime").alias("ultimo"))


@query("read_clean_dataset", f"WITH {CLEAN} SELECT count(*) AS n FROM clean WHERE mes IN (3, 4)")
def read_clean_dataset(spark, sf):
    folder = shared_dir(spark, "clean-trips")
    writers.write_partitions(trip_ops.clean_trips(trips(spark, sf)), folder, "mes")
    return readers.scan(spark, folder).where(F.col("mes").isin(3, 4)).agg(F.count("*").alias("n"))


@query("literal_table", f"""WITH {FARES}, pagos(payment_id, nombre_pago) AS (VALUES {PAYMENT_ROWS})
SELECT CAST(payment_id AS BIGINT) AS payment_id, nombre_pago, count(payment_type) AS n FROM pagos LEFT JOIN fares ON payment_type = payment_id
GROUP BY ALL""")
def literal_table(spark, sf):
    used = fares(spark, sf).groupBy("payment_type").agg(F.count("*").alias("n"))
    names = payment_table(spark)
    joined = names.join(used, names.payment_id == used.payment_type, "left")
    return joined.select("payment_id", "nombre_pago", F.coalesce("n", F.lit(0)).alias("n"))


@query("bronze_batch", f"""WITH {BRONZE} SELECT id_contrato, objeto_contrato, entidad, departamento, valor_contrato,
  duracion_dias, fecha_firma, estado_contrato, anno, "partition", "offset" FROM bronze""")
def bronze_batch(spark, sf):
    return clean.parse_records(records(spark, sf)).select(
        "id_contrato", "objeto_contrato", "entidad", "departamento", "valor_contrato", "duracion_dias", "fecha_firma",
        "estado_contrato", "anno", "partition", "offset")


@query("table_overwrite", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def table_overwrite(spark, sf):
    """A table is replaced by one with other columns."""
    folder = shared_dir(spark, "parts")
    parts = table(spark, sf, "part")
    writers.overwrite(parts.select("p_partkey", "p_name", "p_size"), folder)
    writers.overwrite(parts.select("p_partkey", "p_brand", "p_retailprice"), folder)
    return readers.read_table(spark, folder)


@query("table_append", f"WITH {JUDGED} SELECT anomaly_flag, severity, count(*) AS n FROM judged GROUP BY ALL")
def table_append(spark, sf):
    folder = shared_dir(spark, "anomalies")
    judged = judged_events(spark, sf).select("event_id", "value", "z_score", "anomaly_flag", "severity")
    writers.append(judged.where(F.col("anomaly_flag") == "LIBRE"), folder)
    writers.append(judged.where(F.col("anomaly_flag") == "ATIPICO"), folder)
    return readers.read_table(spark, folder).groupBy("anomaly_flag", "severity").agg(F.count("*").alias("n"))


def _arrivals(spark, sf):
    """Two deliveries of orders with repeated keys; the higher position is the later one."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("valor"), F.lit(0).alias("position"))
    first = orders.where(F.col("id") % 3 != 0)
    later = orders.where(F.col("id") % 2 == 0)
    again = later.where(F.col("id") % 4 == 0).select("id", (F.col("valor") + 1).alias("valor"), F.lit(2).alias("position"))
    changed = later.select("id", (F.col("valor") * 2).alias("valor"), F.lit(1).alias("position"))
    return first.unionByName(first.where(F.col("id") % 5 == 0).select(
        "id", (F.col("valor") + 7).alias("valor"), F.lit(1).alias("position"))), changed.unionByName(again)


@query("silver_upsert", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1
  WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 WHEN o_orderkey % 5 = 0 THEN o_totalprice + 7 ELSE o_totalprice END AS valor
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""")
def silver_upsert(spark, sf):
    """First load, a second batch with changes and new keys, and the second batch repeated."""
    folder = shared_dir(spark, "silver")
    first, second = _arrivals(spark, sf)
    for number, rows in enumerate([first, second]):
        writers.upsert(rows, folder, "id", ["position"], batch=f"orders-{number}")
    writers.upsert(second, folder, "id", ["position"], batch="orders-1")
    return writers.read_upserted(spark, folder).select("id", "valor")


@query("table_read", f"WITH {CONTRACTS} SELECT id_contrato, entidad, valor_contrato, fecha_firma FROM contracts")
def table_read(spark, sf):
    folder = shared_dir(spark, "contracts")
    writers.overwrite(contracts(spark, sf).select("id_contrato", "entidad", "valor_contrato", "fecha_firma"), folder)
    return readers.read_table(spark, folder)


@query("register_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def register_table(spark, sf):
    folder, name = shared_dir(spark, "suppliers"), f"overspend_{uuid.uuid4().hex}"
    writers.overwrite(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), folder)
    writers.register(spark, name, folder)
    found = spark.sql(f"SELECT s_suppkey, s_name, s_acctbal FROM {name}")
    # The plan is resolved; dropping the name leaves the stored files alone.
    spark.sql(f"DROP TABLE {name}")
    return found


@query("temp_view", "SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS saldo FROM customer GROUP BY c_mktsegment")
def temp_view(spark, sf):
    name = f"overspend_{uuid.uuid4().hex}"
    table(spark, sf, "customer").createOrReplaceTempView(name)
    found = spark.sql(f"SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS saldo FROM {name} GROUP BY c_mktsegment")
    spark.catalog.dropTempView(name)
    return found


@query("save_load_model", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM lineitem")
def save_load_model(spark, sf):
    """Scores of a fitted model and of its saved copy, compared row by row."""
    rows = table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features"), models.linear(),
    ]).fit(rows)
    folder = shared_dir(spark, "model")
    fitted.write().overwrite().save(folder)
    before = fitted.transform(rows).withColumnRenamed("prediction", "before").drop("features")
    after = PipelineModel.load(folder).transform(before)
    return after.agg(F.count("*").alias("n_rows"), F.count_if(F.col("before") != F.col("prediction")).alias("n_different"))


@query("gold_anomalies", f"""WITH {JUDGED} SELECT event_id, event_type, value AS valor_contrato,
  round(prediction, 6) AS valor_predicho, round(desviacion, 6) AS desviacion, round(z_score, 6) AS z_score,
  round(sigma_threshold, 6) AS sigma_threshold, anomaly_flag, severity, 'media_grupo_v1' AS model_version FROM judged""")
def gold_anomalies(spark, sf):
    judged = judged_events(spark, sf)
    return judged.select(
        "event_id", "event_type", F.col("value").alias("valor_contrato"), F.round("prediction", 6).alias("valor_predicho"),
        rounded("desviacion"), rounded("z_score"), rounded("sigma_threshold"), "anomaly_flag", "severity",
        F.lit("media_grupo_v1").alias("model_version"))


@query("gold_anomalies_faulty", f"""WITH {FAULTY}, {JUDGED} SELECT event_id, round(z_score, 6) AS z_score,
  round(sigma_threshold, 6) AS sigma_threshold, anomaly_flag, severity FROM judged""")
def gold_anomalies_faulty(spark, sf):
    """The same rule over events with NaN, null and zero values."""
    judged = detect_by_group(faulty_events(spark, sf), "value", "event_type", "ts")
    return judged.select("event_id", rounded("z_score"), rounded("sigma_threshold"), "anomaly_flag", "severity")
