"""Projections, filters and joins."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from overspend import fixed_values as fv
from overspend.functions.fields import parse_date
from overspend.functions.scores import share_pct, trip_kind
from overspend.operators import clean, profile, trips as trip_ops
from overspend.operators.lookup import attach_by_key, join_payment_name, join_region
from overspend.plans.domain import (
    BRONZE, CLEAN, CONTRACTS, FARES, contracts, department_of, department_sql, fares,
    records, round_columns, sql_rows, table, trips,
)
from overspend.plans.registry import query

REGION_ROWS = sql_rows(fv.DEPARTMENT_REGION + fv.DEPARTMENT_REGION_MORE)
PAYMENT_ROWS = sql_rows(fv.PAYMENT_NAMES)


@query("project", "SELECT l_linenumber AS passenger_count, l_quantity AS trip_distance, "
                  "l_extendedprice AS total_amount FROM lineitem")
def project(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("passenger_count"), F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("total_amount"))


@query("select_expr", f"WITH {FARES} SELECT trip_distance, trip_distance * CAST(1.60934 AS DOUBLE) AS "
                      "trip_distance_km, passenger_count AS pasajeros FROM fares")
def select_expr(spark, sf):
    return fares(spark, sf).selectExpr(
        "trip_distance", "trip_distance * 1.60934D AS trip_distance_km", "passenger_count AS pasajeros")


@query("ratio_pct", f"WITH {FARES} SELECT tip_amount, total_amount, tip_amount / nullif(total_amount, 0) * 100 "
                    "AS propina_pct, tip_amount / nullif(CAST(passenger_count - 1 AS DOUBLE), 0) * 100 "
                    "AS por_pasajero FROM fares")
def ratio_pct(spark, sf):
    return trip_ops.with_tip_pct(fares(spark, sf)).select(
        "tip_amount", "total_amount", "propina_pct",
        share_pct(F.col("tip_amount"), (F.col("passenger_count") - 1).cast("double")).alias("por_pasajero"))


@query("add_columns", f"WITH {FARES} SELECT fare_amount, tip_amount, fare_amount + tip_amount AS total_cost FROM fares")
def add_columns(spark, sf):
    return fares(spark, sf).select("fare_amount", "tip_amount").withColumn(
        "total_cost", F.col("fare_amount") + F.col("tip_amount"))


@query("literal_column", f"WITH {FARES} SELECT passenger_count, 'taxis_ny' AS fuente FROM fares")
def literal_column(spark, sf):
    return fares(spark, sf).withColumn("fuente", F.lit("taxis_ny")).select("passenger_count", "fuente")


@query("rename_drop", f"WITH {FARES} SELECT trip_distance, passenger_count AS pasajeros, payment_type FROM fares")
def rename_drop(spark, sf):
    chosen = fares(spark, sf).select("trip_distance", "passenger_count", "payment_type", "store_and_fwd_flag")
    return chosen.withColumnRenamed("passenger_count", "pasajeros").drop("store_and_fwd_flag")


@query("drop_redundant", """
WITH wide AS (
  SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS campo_vacio, 'VALOR_FIJO' AS constante_1,
         100 AS constante_2, o_orderkey AS duplicate_id, nullif(o_orderstatus, 'P') AS estado FROM orders)
SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS n_null,
       min(o_orderkey) = max(o_orderkey) AS is_constant, CAST(NULL AS VARCHAR) AS equal_to FROM wide
UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey), min(o_custkey) = max(o_custkey), NULL FROM wide
UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice), min(o_totalprice) = max(o_totalprice), NULL FROM wide
UNION ALL SELECT 'campo_vacio', count(*) - count(campo_vacio), count(campo_vacio) = 0, NULL FROM wide
UNION ALL SELECT 'constante_1', count(*) - count(constante_1), min(constante_1) = max(constante_1), NULL FROM wide
UNION ALL SELECT 'constante_2', count(*) - count(constante_2), min(constante_2) = max(constante_2), NULL FROM wide
UNION ALL SELECT 'duplicate_id', count(*) - count(duplicate_id), min(duplicate_id) = max(duplicate_id),
       CASE WHEN count(*) FILTER (duplicate_id IS DISTINCT FROM o_orderkey) = 0 THEN 'o_orderkey' END FROM wide
UNION ALL SELECT 'estado', count(*) - count(estado), min(estado) = max(estado) AND count(estado) = count(*), NULL
FROM wide""")
def drop_redundant(spark, sf):
    wide = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.lit(None).cast("string").alias("campo_vacio"),
        F.lit("VALOR_FIJO").alias("constante_1"), F.lit(100).alias("constante_2"),
        F.col("o_orderkey").alias("duplicate_id"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("estado"))
    return profile.redundant_columns(wide)


@query("filter_and", f"WITH {FARES} SELECT passenger_count, trip_distance, total_amount FROM fares "
                     "WHERE passenger_count > 1 AND trip_distance > 5")
def filter_and(spark, sf):
    return fares(spark, sf).filter((F.col("passenger_count") > 1) & (F.col("trip_distance") > 5)).select(
        "passenger_count", "trip_distance", "total_amount")


@query("filter_eq", f"WITH {FARES} SELECT payment_type, total_amount FROM fares WHERE payment_type = 1")
def filter_eq(spark, sf):
    return fares(spark, sf).where(F.col("payment_type") == 1).select("payment_type", "total_amount")


@query("filter_like", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE '%STEEL%' OR p_type LIKE 'S%'")
def filter_like(spark, sf):
    kind = F.col("p_type")
    return table(spark, sf, "part").filter(kind.like("%STEEL%") | kind.like("S%")).select("p_partkey", "p_type")


@query("filter_in", f"WITH {FARES} SELECT payment_type, total_amount FROM fares WHERE payment_type IN (1, 2)")
def filter_in(spark, sf):
    return fares(spark, sf).filter(F.col("payment_type").isin(1, 2)).select("payment_type", "total_amount")


@query("filter_null", f"""WITH {FARES}
SELECT 'nulo' AS clase, count(*) AS n FROM fares WHERE passenger_count IS NULL
UNION ALL SELECT 'no nulo', count(*) FROM fares WHERE passenger_count IS NOT NULL""")
def filter_null(spark, sf):
    given = fares(spark, sf).select("passenger_count")
    return (
        given.filter(F.col("passenger_count").isNull()).agg(F.lit("nulo").alias("clase"), F.count("*").alias("n"))
        .union(given.filter(F.col("passenger_count").isNotNull()).agg(F.lit("no nulo"), F.count("*")))
    )


@query("filter_range", f"WITH {FARES} SELECT trip_distance, tip_amount FROM fares "
                       "WHERE trip_distance > 2 AND trip_distance < 100")
def filter_range(spark, sf):
    return fares(spark, sf).filter((F.col("trip_distance") > 2) & (F.col("trip_distance") < 100)).select(
        "trip_distance", "tip_amount")


@query("quality_filter", f"""WITH {CONTRACTS}, shifted AS (
  SELECT CASE WHEN anno = 1998 AND duracion_dias IS NULL THEN NULL ELSE id_contrato END AS id_contrato,
         nullif(objeto_contrato, 'Suministro 2-HIGH BUILDING') AS objeto_contrato,
         CASE WHEN codigo_unspsc = '5-LOW' THEN NULL ELSE valor_contrato - 100000 END AS valor_contrato,
         CASE WHEN estado_contrato = 'P' THEN NULL ELSE fecha_firma END AS fecha_firma FROM contracts)
SELECT id_contrato, valor_contrato, fecha_firma FROM shifted
WHERE id_contrato IS NOT NULL AND objeto_contrato IS NOT NULL AND valor_contrato > 0 AND fecha_firma IS NOT NULL""")
def quality_filter(spark, sf):
    shifted = contracts(spark, sf).withColumns({
        "id_contrato": F.when(~((F.col("anno") == 1998) & F.col("duracion_dias").isNull()), F.col("id_contrato")),
        "objeto_contrato": F.nullif(F.col("objeto_contrato"), F.lit("Suministro 2-HIGH BUILDING")),
        "valor_contrato": F.when(F.col("codigo_unspsc") != "5-LOW", F.col("valor_contrato") - 100000),
        "fecha_firma": F.when(F.col("estado_contrato") != "P", F.col("fecha_firma")),
    })
    return shifted.where(clean.is_valid_contract()).select("id_contrato", "valor_contrato", "fecha_firma")


@query("trip_clean", f"WITH {CLEAN} SELECT tpep_pickup_datetime, trip_distance, total_amount, duracion_minutos, mes, "
                     "dia_semana, hora_del_dia, propina_pct FROM clean")
def trip_clean(spark, sf):
    return trip_ops.clean_trips(trips(spark, sf)).select(
        "tpep_pickup_datetime", "trip_distance", "total_amount", "duracion_minutos", "mes", "dia_semana",
        "hora_del_dia", "propina_pct")


@query("model_rows", f"WITH {CONTRACTS} SELECT id_contrato, valor_contrato - 100000 AS label FROM contracts "
                     "WHERE duracion_dias IS NOT NULL AND valor_contrato - 100000 > 0")
def model_rows(spark, sf):
    numbers = F.array(F.col("duracion_dias").cast("double"), F.col("anno").cast("double"))
    rows = contracts(spark, sf).select(
        "id_contrato", (F.col("valor_contrato") - 100000).alias("valor"),
        F.when(F.col("duracion_dias").isNotNull(), array_to_vector(numbers)).alias("vector"))
    return clean.model_rows(rows, "vector", "valor", ["id_contrato"]).select("id_contrato", "label")


@query("case_bucket", f"""WITH {FARES} SELECT trip_distance, CASE WHEN trip_distance > 20 THEN 'Largo (Aero)'
 WHEN trip_distance > 10 THEN 'Largo (No Aero)' WHEN trip_distance > 5 THEN 'Medio' ELSE 'Corto' END AS tipo_viaje
FROM fares""")
def case_bucket(spark, sf):
    return fares(spark, sf).select("trip_distance", trip_kind(F.col("trip_distance")).alias("tipo_viaje"))


@query("case_map", f"WITH {FARES} SELECT payment_type, CASE WHEN payment_type = 1 THEN 'Tarjeta' ELSE 'Efectivo' END "
                   "AS tipo_pago_nombre FROM fares WHERE payment_type IN (1, 2)")
def case_map(spark, sf):
    return fares(spark, sf).where(F.col("payment_type").isin(1, 2)).select(
        "payment_type", F.when(F.col("payment_type") == 1, "Tarjeta").otherwise("Efectivo").alias("tipo_pago_nombre"))


@query("cast_columns", "SELECT CAST(o_orderkey AS VARCHAR) AS id_text, CAST(o_orderdate AS DATE) AS fecha, "
                       "CAST(o_custkey AS DOUBLE) AS entidad_num, CAST(epoch(o_orderdate) AS BIGINT) AS segundos, "
                       "TRY_CAST(left(o_orderpriority, 2) AS INTEGER) AS prioridad FROM orders")
def cast_columns(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").cast("binary").cast("string").alias("id_text"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.col("o_custkey").cast("double").alias("entidad_num"),
        F.col("o_orderdate").cast("timestamp").cast("long").alias("segundos"),
        F.left("o_orderpriority", F.lit(2)).try_cast("int").alias("prioridad"))


@query("fill_null", f"WITH {CONTRACTS} SELECT id_contrato, coalesce(duracion_dias, 0) AS duracion_dias FROM contracts")
def fill_null(spark, sf):
    return contracts(spark, sf).fillna({"duracion_dias": 0}).select("id_contrato", "duracion_dias")


@query("expand_struct", f"""WITH {BRONZE} SELECT id_contrato, valor_contrato, duracion_dias, fecha_firma,
  "partition", "offset", sent_at AS kafka_timestamp FROM bronze""")
def expand_struct(spark, sf):
    return clean.parse_records(records(spark, sf)).select(
        "id_contrato", "valor_contrato", "duracion_dias", "fecha_firma", "partition", "offset",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"))


@query("modulo_columns", "SELECT event_id, CAST(event_id % 50 AS DOUBLE) AS fare_amount, "
                         "CAST(event_id % 10 AS DOUBLE) AS tip_amount FROM events")
def modulo_columns(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", (F.col("event_id") % 50).cast("double").alias("fare_amount"),
        (F.col("event_id") % 10).cast("double").alias("tip_amount"))


@query("join_dictionary", f"""WITH {FARES}, pagos(payment_id, nombre_pago) AS (VALUES {PAYMENT_ROWS})
SELECT passenger_count, total_amount, nombre_pago FROM fares LEFT JOIN pagos ON payment_type = payment_id""")
def join_dictionary(spark, sf):
    return join_payment_name(fares(spark, sf)).select("passenger_count", "total_amount", "nombre_pago")


@query("join_using_left", f"""WITH {FARES}, stats AS (
  SELECT "PULocationID", count(*) AS n_rows, round(avg(total_amount), 6) AS media FROM fares GROUP BY 1)
SELECT f.trip_distance, f."PULocationID", s.n_rows, s.media FROM fares f LEFT JOIN stats s USING ("PULocationID")""")
def join_using_left(spark, sf):
    trip = fares(spark, sf).select("trip_distance", "PULocationID", "total_amount")
    stats = trip.groupBy("PULocationID").agg(F.count("*").alias("n_rows"), F.avg("total_amount").alias("media"))
    joined = attach_by_key(trip.drop("total_amount"), stats, "PULocationID", "n_rows")
    return round_columns(joined, ["media"])


@query("join_region", f"""WITH dictionary(departamento, region) AS (VALUES {REGION_ROWS}),
placed AS (SELECT o_orderkey, {department_sql('o_custkey')} AS departamento FROM orders)
SELECT o_orderkey, p.departamento, coalesce(d.region, 'Desconocida') AS region
FROM placed p LEFT JOIN dictionary d ON p.departamento = d.departamento""")
def regions_joined(spark, sf):
    placed = table(spark, sf, "orders").select("o_orderkey", department_of(F.col("o_custkey")).alias("departamento"))
    return join_region(placed)


@query("join_region_strict", f"""
WITH dictionary(departamento, region) AS (VALUES {sql_rows(fv.DEPARTMENT_REGION)}),
placed AS (SELECT o_orderkey, {department_sql('o_custkey')} AS departamento FROM orders)
SELECT coalesce(d.region, 'Desconocida') AS region, count(*) AS n
FROM placed p LEFT JOIN dictionary d ON p.departamento = d.departamento GROUP BY 1""")
def regions_strict(spark, sf):
    placed = table(spark, sf, "orders").select("o_orderkey", department_of(F.col("o_custkey")).alias("departamento"))
    return join_region(placed, strict=True).groupBy("region").agg(F.count("*").alias("n"))


@query("upsert_match", """
WITH known AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0),
incoming AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 2 = 0)
SELECT i.k AS id, CASE WHEN known.k IS NULL THEN 'insert' ELSE 'update' END AS action
FROM incoming i LEFT JOIN known ON i.k = known.k""")
def upsert_match(spark, sf):
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    known, incoming = keys.where(F.col("id") % 3 != 0), keys.where(F.col("id") % 2 == 0)
    return (
        incoming.join(known, "id", "left_anti").withColumn("action", F.lit("insert"))
        .unionByName(incoming.join(known, "id", "left_semi").withColumn("action", F.lit("update")))
    )


@query("parse_date", f"""WITH {BRONZE} SELECT "partition", "offset",
  CAST(TRY_CAST(fecha_firma AS TIMESTAMP) AS DATE) AS fecha FROM bronze""")
def parsed_dates(spark, sf):
    return clean.parse_records(records(spark, sf)).select(
        "partition", "offset", parse_date(F.col("fecha_firma")).alias("fecha"))
