"""Aggregates, profiles, orderings and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from overspend.operators import anomaly, profile, trips as trip_ops
from overspend.operators.quantiles import approximate_quantiles, exact_quantiles
from overspend.plans.columns import PAYMENT_ROWS
from overspend.plans.domain import (
    BRONZE, CLEAN, CONTRACTS, FARES, JUDGED, contracts, fares, judged_events, records, round_columns, rounded, table,
    trips,
)
from overspend.plans.registry import query
from overspend.session import stored


@query("agg_global", f"WITH {FARES} SELECT round(avg(total_amount), 4) AS promedio_total_global, "
                     "round(sum(fare_amount), 2) AS total_tarifas_global, max(trip_distance) AS viaje_mas_largo "
                     "FROM fares")
def agg_global(spark, sf):
    return fares(spark, sf).agg(
        F.round(F.avg("total_amount"), 4).alias("promedio_total_global"),
        F.round(F.sum("fare_amount"), 2).alias("total_tarifas_global"),
        F.max("trip_distance").alias("viaje_mas_largo"))


@query("agg_multi", f"""WITH {FARES} SELECT "PULocationID", count(*) AS conteo_viajes,
  round(avg(total_amount), 4) AS promedio_total, round(sum(total_amount), 2) AS suma_total,
  max(trip_distance) AS distancia_maxima, count(DISTINCT payment_type) AS tipos_pago_unicos
FROM fares GROUP BY "PULocationID" """)
def agg_multi(spark, sf):
    report = trip_ops.BY_ZONE.of(fares(spark, sf))
    return round_columns(round_columns(report, ["promedio_total"], 4), ["suma_total"], 2)


@query("count_distinct", f"WITH {CONTRACTS} SELECT count(DISTINCT entidad) AS entidades, "
                         "count(DISTINCT departamento) AS departamentos, count(DISTINCT modalidad) AS modalidades "
                         "FROM contracts")
def count_distinct(spark, sf):
    return contracts(spark, sf).agg(*[
        F.count_distinct(c).alias(name) for c, name in
        (("entidad", "entidades"), ("departamento", "departamentos"), ("modalidad", "modalidades"))])


DIMENSIONS = ["entidad", "departamento", "region", "codigo_unspsc", "objeto_contrato", "tipo_contrato",
              "estado_contrato", "modalidad", "anno", "fecha_firma"]


@query("freq_table", f"WITH {CONTRACTS} " + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS n FROM contracts GROUP BY {d}"
    for d in DIMENSIONS))
def freq_table(spark, sf):
    return profile.frequency_tables(contracts(spark, sf), DIMENSIONS)


@query("trip_tip_by_passengers", f"""WITH {FARES} SELECT passenger_count,
  round(avg(tip_amount / nullif(total_amount, 0) * 100), 6) AS propina_promedio_pct, count(*) AS conteo_viajes
FROM fares WHERE passenger_count > 1 AND trip_distance > 5 GROUP BY passenger_count""")
def trip_tip_by_passengers(spark, sf):
    return round_columns(trip_ops.BY_PASSENGERS.of(fares(spark, sf)), ["propina_promedio_pct"])


@query("trip_by_month", f"""WITH {CLEAN} SELECT mes, count(*) AS total_viajes,
  round(avg(propina_pct), 6) AS propina_promedio, round(avg(trip_distance), 6) AS distancia_promedio
FROM clean GROUP BY mes""")
def trip_by_month(spark, sf):
    report = trip_ops.BY_MONTH.of(trip_ops.clean_trips(trips(spark, sf)))
    return round_columns(report, ["propina_promedio", "distancia_promedio"])


@query("trip_by_hour", f"WITH {CLEAN} SELECT hora_del_dia, count(*) AS total_viajes, "
                       "round(avg(propina_pct), 6) AS propina_promedio FROM clean GROUP BY hora_del_dia")
def trip_by_hour(spark, sf):
    return round_columns(trip_ops.BY_HOUR.of(trip_ops.clean_trips(trips(spark, sf))), ["propina_promedio"])


@query("trip_by_payment", f"""WITH {CLEAN} SELECT CASE WHEN payment_type = 1 THEN 'Tarjeta' ELSE 'Efectivo' END
  AS tipo_pago_nombre, round(avg(propina_pct), 6) AS propina_promedio, count(*) AS conteo_viajes
FROM clean WHERE payment_type IN (1, 2) GROUP BY 1""")
def trip_by_payment(spark, sf):
    return round_columns(trip_ops.BY_PAYMENT.of(trip_ops.clean_trips(trips(spark, sf))), ["propina_promedio"])


@query("trip_segments", f"""WITH {FARES} SELECT payment_type,
  CASE WHEN trip_distance > 20 THEN 'Largo' ELSE 'Medio' END AS tipo_viaje,
  round(avg(tip_amount), 4) AS propina_promedio, count(*) AS conteo_viajes
FROM fares WHERE trip_distance > 2 AND trip_distance < 100 GROUP BY 1, 2""")
def trip_segments(spark, sf):
    return round_columns(trip_ops.SEGMENTS.of(fares(spark, sf)), ["propina_promedio"], 4)


@query("trip_segments_sql", f"""WITH {FARES}, pagos(payment_id, nombre_pago) AS (VALUES {PAYMENT_ROWS})
SELECT payment_type, nombre_pago, CASE WHEN trip_distance > 20 THEN 'Largo' ELSE 'Medio' END AS tipo_viaje,
  round(avg(tip_amount), 4) AS propina_promedio, count(*) AS conteo_viajes
FROM fares LEFT JOIN pagos ON payment_type = payment_id
WHERE trip_distance > 2 AND trip_distance < 100 GROUP BY 1, 2, 3""")
def trip_segments_sql(spark, sf):
    return round_columns(trip_ops.segments_sql(fares(spark, sf)), ["propina_promedio"], 4)


NULLABLE = ["passenger_count", "RatecodeID", "trip_distance", "total_amount"]


@query("null_profile", f"WITH {FARES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS n_null, "
    f"round((count(*) - count(\"{c}\")) * CAST(100.0 AS DOUBLE) / count(*), 6) AS pct_null FROM fares"
    for c in NULLABLE))
def null_profile(spark, sf):
    return round_columns(profile.null_profile(fares(spark, sf), NULLABLE), ["pct_null"])


AMOUNTS = ["valor_contrato", "duracion_dias"]


@query("numeric_profile", f"WITH {CONTRACTS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, "
    f"round(avg({c}), 4) AS mean_value, round(stddev_samp({c}), 4) AS std_value FROM contracts" for c in AMOUNTS))
def numeric_profile(spark, sf):
    return round_columns(profile.numeric_profile(contracts(spark, sf), AMOUNTS), ["mean_value", "std_value"], 4)


@query("log_profile", "WITH logs AS (SELECT o_totalprice AS v, ln(1 + o_totalprice) AS l FROM orders) " + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, round(avg({c}), 4) AS mean_value, round(stddev_samp({c}), 4) AS std_value FROM logs"
    for name, c in (("valor_contrato", "v"), ("log_valor_contrato", "l"))))
def log_profile(spark, sf):
    values = table(spark, sf, "orders").select(
        F.col("o_totalprice").alias("valor_contrato"), F.log1p("o_totalprice").alias("log_valor_contrato"))
    report = profile.numeric_profile(values, ["valor_contrato", "log_valor_contrato"])
    return round_columns(report, ["mean_value", "std_value"], 4).drop("min_value", "max_value")


POINTS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("percentiles", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, quantile_disc(o_totalprice, {p}) AS valor_contrato FROM orders" for p in POINTS))
def percentiles(spark, sf):
    values = exact_quantiles(table(spark, sf, "orders"), "o_totalprice", POINTS)
    return spark.createDataFrame(list(zip(POINTS, values)), "p double, valor_contrato double")


@query("variance_check", "WITH wide AS (SELECT o_totalprice, o_custkey, 100 AS constante_2 FROM orders) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min_value, "
    f"CAST(max({c}) AS DOUBLE) AS max_value, round(var_samp({c}), 1) AS variance, "
    f"round(stddev_samp({c}), 4) AS std_value, "
    f"CASE WHEN var_samp({c}) > 0 THEN 'CONSERVAR' ELSE 'ELIMINAR' END AS decision FROM wide"
    for c in ("o_totalprice", "o_custkey", "constante_2")))
def variance_check(spark, sf):
    wide = table(spark, sf, "orders").select("o_totalprice", "o_custkey", F.lit(100).alias("constante_2"))
    report = profile.variance_check(wide, wide.columns)
    return round_columns(round_columns(report, ["variance"], 1), ["std_value"], 4)


@query("avg_text_length", "SELECT round(avg(length(text)), 6) AS avg_length FROM documents")
def avg_text_length(spark, sf):
    return round_columns(profile.mean_text_length(table(spark, sf, "documents"), "text"), ["avg_length"])


@query("table_stats", f"WITH {CONTRACTS} SELECT count(*) AS total_records, max(fecha_firma) AS latest_date FROM contracts")
def table_stats(spark, sf):
    return profile.table_stats(contracts(spark, sf), "fecha_firma")


@query("max_offset", f'WITH {BRONZE} SELECT "partition", max("offset") AS max_offset FROM bronze GROUP BY "partition"')
def max_offset(spark, sf):
    return profile.max_offsets(records(spark, sf))


def _gate_sql(amount: str) -> str:
    return f"""WITH seen AS (SELECT count(*) AS total, count({amount}) AS valid,
  min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date FROM orders)
SELECT *, CASE WHEN total < 10000 THEN 'TOO_FEW_ROWS' WHEN valid < total * 0.95 THEN 'TOO_FEW_VALID' ELSE 'OK' END
  AS verdict FROM seen"""


@query("quality_gate", _gate_sql("o_totalprice"))
def quality_gate(spark, sf):
    rows = table(spark, sf, "orders").select("o_totalprice", F.col("o_orderdate").cast("date").alias("fecha"))
    return profile.quality_gate(rows, "o_totalprice", "fecha")


@query("quality_gate_failed", _gate_sql("nullif(o_orderstatus, 'P')"))
def quality_gate_failed(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("valor"), F.col("o_orderdate").cast("date").alias("fecha"))
    return profile.quality_gate(rows, "valor", "fecha")


@query("retention_report", """WITH kept AS (
  SELECT count(*) AS n, count(*) FILTER (value - 5 > 0) AS k FROM events)
SELECT n AS rows_in, k AS rows_out, n - k AS rows_dropped, round(k * CAST(100.0 AS DOUBLE) / n, 6) AS pct_kept,
  round((n - k) * CAST(100.0 AS DOUBLE) / n, 6) AS pct_dropped FROM kept""")
def retention_report(spark, sf):
    report = profile.retention_report(table(spark, sf, "events"), F.col("value") - 5 > 0)
    return round_columns(report, ["pct_kept", "pct_dropped"])


NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


@query("corr_pearson", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 8) AS r FROM lineitem" for c in NUMBERS))
def corr_pearson(spark, sf):
    return round_columns(profile.correlations(table(spark, sf, "lineitem"), NUMBERS, "l_extendedprice"), ["r"], 8)


MATRIX = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 8) AS r FROM lineitem"
    for a in MATRIX for b in MATRIX))
def corr_matrix(spark, sf):
    return round_columns(profile.correlation_matrix(table(spark, sf, "lineitem"), MATRIX), ["r"], 8)


@query("corr_embedding", """
WITH flat AS (SELECT vec_id, CAST(label AS DOUBLE) AS y, unnest(embedding) AS x,
                     generate_subscripts(embedding, 1) - 1 AS position FROM embeddings)
SELECT CAST(position AS INTEGER) AS position, round(corr(CAST(x AS DOUBLE), y), 8) AS r FROM flat GROUP BY position""")
def corr_embedding(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return round_columns(profile.vector_correlations(vectors, "embedding", "label"), ["r"], 8)


@query("corr_spearman", """WITH ranked AS (
  SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
         rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b
  FROM lineitem)
SELECT round(corr(CAST(a AS DOUBLE), CAST(b AS DOUBLE)), 8) AS rho FROM ranked""")
def corr_spearman(spark, sf):
    return round_columns(profile.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), ["rho"], 8)


@query("flag_counts", f"""WITH {JUDGED} SELECT anomaly_flag, count(*) AS n,
  round(count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM judged), 6) AS pct FROM judged GROUP BY anomaly_flag""")
def flag_counts(spark, sf):
    return round_columns(anomaly.flag_counts(judged_events(spark, sf)), ["pct"])


@query("severity_distribution", f"WITH {JUDGED} SELECT severity, count(*) AS n FROM judged "
                                "WHERE anomaly_flag = 'ATIPICO' GROUP BY severity")
def severity_distribution(spark, sf):
    return anomaly.severity_distribution(judged_events(spark, sf))


@query("order_by", f"WITH {FARES} SELECT passenger_count, count(*) AS n FROM fares GROUP BY passenger_count ORDER BY 1 DESC")
def order_by(spark, sf):
    return fares(spark, sf).groupBy("passenger_count").agg(F.count("*").alias("n")).orderBy(F.desc("passenger_count"))


@query("top_k", f"WITH {CONTRACTS} SELECT entidad, count(*) AS n FROM contracts GROUP BY entidad "
                "ORDER BY n DESC, entidad LIMIT 10")
def top_k(spark, sf):
    return profile.top_values(contracts(spark, sf), "entidad", 10)


@query("top_anomalies", f"""WITH {JUDGED} SELECT event_id, value AS valor_contrato, round(prediction, 6) AS prediction,
  round(z_score, 6) AS z_score, severity FROM judged WHERE anomaly_flag = 'ATIPICO'
ORDER BY judged.z_score DESC, event_id LIMIT 10""")
def top_anomalies(spark, sf):
    return anomaly.top_anomalies(judged_events(spark, sf), "event_id").select(
        "event_id", F.col("value").alias("valor_contrato"), rounded("prediction"), rounded("z_score"), "severity")


PARTS = 8


@query("partition_profile", f"""WITH t AS (SELECT count(*) AS total FROM lineitem)
SELECT 'antes' AS etapa, total, TRUE AS completa, TRUE AS dentro FROM t UNION ALL SELECT 'despues', total, TRUE, TRUE FROM t""")
def partition_profile(spark, sf):
    """Rows per block of the stored files and per task after spreading. All rows are in some part; the largest block holds an even share or more, and after
    spreading the largest task holds at most an even share and one row per task that dealt rows out."""
    rows = table(spark, sf, "lineitem")
    blocks = stored(profile.block_profile(rows), "blocks")
    before = profile.evenness(blocks)
    after = profile.evenness(profile.partition_profile(rows.repartition(PARTS)))
    readers = max(blocks.count(), spark.sparkContext.defaultParallelism)
    whole = F.col("total") == rows.agg(F.count("*")).scalar()
    return before.select(F.lit("antes").alias("etapa"), "total", whole.alias("completa"), (F.col("largest") * F.col("parts") >= F.col("total")).alias("dentro")).unionByName(
        after.select(F.lit("despues").alias("etapa"), "total", whole.alias("completa"), (F.col("largest") <= F.col("total") / PARTS + readers).alias("dentro")))


@query("percentiles_approximate", " UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS p, TRUE AS dentro" for p in POINTS))
def percentiles_approximate(spark, sf):
    """Whether the rank of each approximate quantile is within the error that was asked for."""
    rows = table(spark, sf, "orders")
    values = approximate_quantiles(rows, "o_totalprice", POINTS, 0.01)
    tests = [((F.count_if(F.col("o_totalprice") < v) <= (p + 0.01) * F.count("*")) & (F.count_if(F.col("o_totalprice") <= v) >= (p - 0.01) * F.count("*")))
             for p, v in zip(POINTS, values)]
    return rows.agg(F.array(*[F.struct(F.lit(p).alias("p"), t.alias("dentro")) for p, t in zip(POINTS, tests)]).alias("r")).select(F.inline("r"))


@query("corr_ranked", """WITH flat AS (SELECT CAST(label AS DOUBLE) AS y, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS position FROM embeddings),
r AS (SELECT CAST(position AS INTEGER) AS position, corr(CAST(x AS DOUBLE), y) AS r FROM flat GROUP BY position)
SELECT CAST(row_number() OVER (ORDER BY abs(r) DESC, position) AS INTEGER) AS place, position, round(r, 8) AS r FROM r WHERE NOT isnan(r)
ORDER BY 1 LIMIT 5""")
def corr_ranked(spark, sf):
    """The vector positions that go most along with the target."""
    found = profile.vector_correlations(table(spark, sf, "embeddings"), "embedding", "label")
    return round_columns(profile.ranked_correlations(found, "position", 5).select("place", "position", "r"), ["r"], 8)


@query("sample", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE CAST('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) < 429496729""")
def sample(spark, sf):
    """About a tenth of the rows, chosen by a hash of their key."""
    return profile.sample_by_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 0.1).select("l_orderkey", "l_linenumber", "l_quantity")
