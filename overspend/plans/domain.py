"""The stored tables seen as contracts, trips and messages; each view as a DataFrame and as a SQL clause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overspend import fixed_values as fv

DEPARTMENTS = [name for name, _ in fv.DEPARTMENT_REGION + fv.DEPARTMENT_REGION_MORE] + ["Atlantis"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


def round_columns(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_rows(rows: list[tuple]) -> str:
    """Rows of a VALUES clause."""
    return ", ".join(
        "(" + ", ".join(sql_text(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def sql_list(values: list[str]) -> str:
    return ", ".join(sql_text(v) for v in values)


def department_of(number: Column) -> Column:
    """A department name picked by number, one of them unknown to the region table."""
    names = F.array(*[F.lit(name) for name in DEPARTMENTS])
    return F.element_at(names, (F.pmod(number, F.lit(len(DEPARTMENTS))) + 1).cast("int"))


def department_sql(number: str) -> str:
    return f"list_extract([{sql_list(DEPARTMENTS)}], CAST({number} % {len(DEPARTMENTS)} AS INTEGER) + 1)"


def fares(spark: SparkSession, folder: str) -> DataFrame:
    """Trips without their times: line items only, so nothing is joined."""
    tip = F.col("l_extendedprice") * F.col("l_discount") * 8
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 2 + 1).alias("VendorID"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.nullif(F.col("l_suppkey") % 10, F.lit(9).cast("long")).alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.col("l_suppkey").alias("PULocationID"),
        (F.col("l_orderkey") % 7).alias("payment_type"),
        (F.col("l_extendedprice") - tip).alias("fare_amount"),
        tip.alias("tip_amount"),
        F.col("l_extendedprice").alias("total_amount"),
        "l_orderkey", "l_partkey",
    )


FARES = """fares AS (
  SELECT l_orderkey % 2 + 1 AS "VendorID", nullif(l_linenumber, 7) AS passenger_count,
         l_quantity AS trip_distance, nullif(l_suppkey % 10, 9) AS "RatecodeID",
         CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         l_suppkey AS "PULocationID", l_orderkey % 7 AS payment_type,
         l_extendedprice - l_extendedprice * l_discount * 8 AS fare_amount,
         l_extendedprice * l_discount * 8 AS tip_amount, l_extendedprice AS total_amount, l_orderkey, l_partkey
  FROM lineitem)"""


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with pick-up and drop-off times."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = fares(spark, folder).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    timed = joined.withColumn(
        "tpep_pickup_datetime", F.expr("o_orderdate + make_dt_interval(0, 0, cast(l_partkey % 1440 AS int))"))
    return timed.withColumn(
        "tpep_dropoff_datetime",
        F.expr("tpep_pickup_datetime + make_dt_interval(0, 0, cast((trip_distance - 1) * 20 AS int))"),
    ).drop("l_orderkey", "l_partkey", "o_orderkey", "o_orderdate")


TRIPS = FARES + """, picked AS (
  SELECT f.*, o_orderdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS tpep_pickup_datetime
  FROM fares f JOIN orders ON l_orderkey = o_orderkey
), trips AS (
  SELECT * EXCLUDE (l_orderkey, l_partkey),
         tpep_pickup_datetime + to_minutes(CAST((trip_distance - 1) * 20 AS BIGINT)) AS tpep_dropoff_datetime
  FROM picked)"""

CLEAN = TRIPS + """, clean AS (
  SELECT * FROM (
    SELECT *, date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60 AS duracion_minutos,
           CAST(month(tpep_pickup_datetime) AS INTEGER) AS mes,
           CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS dia_semana,
           CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hora_del_dia,
           tip_amount / nullif(total_amount, 0) * 100 AS propina_pct
    FROM trips)
  WHERE duracion_minutos > 1 AND duracion_minutos < 720 AND trip_distance > 0 AND total_amount > 0
    AND propina_pct <= 50 AND passenger_count IS NOT NULL AND "RatecodeID" IS NOT NULL)"""


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer, nation and region as contracts."""
    key = F.col("o_orderkey")
    joined = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        key.cast("string").alias("id_contrato"),
        F.concat_ws(" ", F.lit("Suministro"), "o_orderpriority", "c_mktsegment").alias("objeto_contrato"),
        F.col("c_name").alias("entidad"),
        F.col("n_name").alias("departamento"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("codigo_unspsc"),
        F.col("o_totalprice").alias("valor_contrato"),
        F.when(key % 2 == 1, (key % 365).cast("int")).alias("duracion_dias"),
        F.col("o_orderdate").cast("date").alias("fecha_firma"),
        F.concat(F.lit("Tipo "), (key % 4).cast("string")).alias("tipo_contrato"),
        F.col("o_orderstatus").alias("estado_contrato"),
        F.col("c_mktsegment").alias("modalidad"),
        F.year("o_orderdate").alias("anno"),
    )


CONTRACTS = """contracts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_contrato,
         'Suministro ' || o_orderpriority || ' ' || c_mktsegment AS objeto_contrato,
         c_name AS entidad, n_name AS departamento, r_name AS region, o_orderpriority AS codigo_unspsc,
         o_totalprice AS valor_contrato,
         CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey % 365 AS INTEGER) END AS duracion_dias,
         CAST(o_orderdate AS DATE) AS fecha_firma, 'Tipo ' || CAST(o_orderkey % 4 AS VARCHAR) AS tipo_contrato,
         o_orderstatus AS estado_contrato, c_mktsegment AS modalidad, CAST(year(o_orderdate) AS INTEGER) AS anno
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""


def doc_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as contracts with long texts."""
    key = F.col("doc_id")
    return table(spark, folder, "documents").select(
        key.cast("string").alias("id_contrato"),
        F.col("text").alias("objeto_contrato"),
        F.col("source").alias("entidad"),
        F.concat_ws("-", "source", "lang").alias("codigo_unspsc"),
        F.col("n_chars").cast("double").alias("valor_contrato"),
        F.when(key % 2 == 1, (key % 360).cast("int")).alias("duracion_dias"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int")).alias("fecha_firma"),
        F.col("lang").alias("tipo_contrato"),
        F.concat(F.lit("E"), (key % 3).cast("string")).alias("estado_contrato"),
        F.concat(F.lit("M"), (key % 2).cast("string")).alias("modalidad"),
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as topic records whose JSON has the faults a feed has: bad JSON, wrong types, missing ids,
    zero values, unreadable dates and blank texts."""
    key = F.col("o_orderkey")
    message = F.to_json(F.struct(
        F.when(key % 103 != 0, key.cast("string")).alias("id_contrato"),
        F.when(key % 113 == 0, "").when(key % 127 == 0, "nan").otherwise(
            F.concat(F.lit("Suministro "), F.col("o_orderpriority"))).alias("objeto_contrato"),
        F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("entidad"),
        department_of(F.col("o_custkey")).alias("departamento"),
        F.when(key % 107 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("valor_contrato"),
        F.when(key % 2 == 1, (key % 365).cast("int")).alias("duracion_dias"),
        F.when(key % 109 == 0, "sin fecha").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("fecha_firma"),
        F.col("o_orderstatus").alias("estado_contrato"),
        F.year("o_orderdate").alias("anno"),
        F.concat(F.lit("SYS-"), key.cast("string")).alias("id_interno_sistema"),
        F.lit("VALOR_FIJO").alias("constante_1"),
        F.lit(100).alias("constante_2"),
        key.cast("string").alias("duplicate_id"),
    ))
    wrong_type = F.concat(F.lit('{"id_contrato": "'), key.cast("string"), F.lit('", "valor_contrato": "caro"}'))
    value = F.when(key % 101 == 0, F.lit("{bad")).when(key % 131 == 0, wrong_type).otherwise(message)
    return table(spark, folder, "orders").select(
        value.cast("binary").alias("value"),
        (key % 4).cast("int").alias("partition"),
        F.floor(key / 4).cast("long").alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


BRONZE = f"""bronze AS (
  SELECT CASE WHEN bad THEN NULL WHEN wrong THEN CAST(k AS VARCHAR) WHEN k % 103 <> 0 THEN CAST(k AS VARCHAR) END
           AS id_contrato,
         CASE WHEN bad OR wrong THEN NULL WHEN k % 113 = 0 THEN '' WHEN k % 127 = 0 THEN 'nan'
              ELSE 'Suministro ' || o_orderpriority END AS objeto_contrato,
         CASE WHEN bad OR wrong THEN NULL ELSE 'E' || CAST(o_custkey AS VARCHAR) END AS entidad,
         CASE WHEN bad OR wrong THEN NULL ELSE {department_sql('o_custkey')} END AS departamento,
         CASE WHEN bad OR wrong THEN NULL WHEN k % 107 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS valor_contrato,
         CASE WHEN bad OR wrong THEN NULL WHEN k % 2 = 1 THEN CAST(k % 365 AS INTEGER) END AS duracion_dias,
         CASE WHEN bad OR wrong THEN NULL WHEN k % 109 = 0 THEN 'sin fecha'
              ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') END AS fecha_firma,
         CASE WHEN bad OR wrong THEN NULL ELSE o_orderstatus END AS estado_contrato,
         CASE WHEN bad OR wrong THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS anno,
         CAST(k % 4 AS INTEGER) AS "partition", k // 4 AS "offset", o_orderdate AS sent_at
  FROM (SELECT *, o_orderkey AS k, o_orderkey % 101 = 0 AS bad,
               o_orderkey % 101 <> 0 AND o_orderkey % 131 = 0 AS wrong FROM orders))"""

SILVER = BRONZE + """, silver AS (
  SELECT id_contrato, objeto_contrato, entidad, departamento, valor_contrato, duracion_dias,
         CAST(TRY_CAST(fecha_firma AS TIMESTAMP) AS DATE) AS fecha_firma, estado_contrato, anno,
         "partition", "offset", sent_at
  FROM bronze
  WHERE id_contrato IS NOT NULL AND objeto_contrato IS NOT NULL AND lower(trim(objeto_contrato)) NOT IN ('', 'nan')
    AND valor_contrato > 0 AND TRY_CAST(fecha_firma AS TIMESTAMP) IS NOT NULL)"""


def judged_events(spark: SparkSession, folder: str, scale: str = "raw") -> DataFrame:
    """Events judged by the anomaly rule: group means by type, cut by time."""
    from overspend.operators.anomaly import detect_by_group

    return detect_by_group(table(spark, folder, "events"), "value", "event_type", "ts", scale)


def faulty_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events some of whose values are NaN, null or 0."""
    key, value = F.col("event_id"), F.col("value")
    return table(spark, folder, "events").withColumn(
        "value", F.when(key % 97 == 0, float("nan")).when(key % 89 == 0, F.lit(None)).when(key % 83 == 0, 0.0).otherwise(value))


FAULTY = """events AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 89 = 0 THEN NULL
  WHEN event_id % 83 = 0 THEN 0 ELSE value END AS value) FROM main.events)"""


def _judged_sql(label: str) -> str:
    return f"""valid AS (SELECT *, {label} AS label FROM events WHERE value > 0 AND NOT isnan(value)),
cut AS (SELECT quantile_disc(ts, 0.8) AS t80 FROM valid),
overall AS (SELECT avg(label) AS m FROM valid WHERE ts <= (SELECT t80 FROM cut)),
encoding AS (
  SELECT event_type, (count(label) * avg(label) + 50 * (SELECT m FROM overall)) / (count(label) + 50) AS prediction
  FROM valid WHERE ts <= (SELECT t80 FROM cut) GROUP BY event_type),
scored AS (
  SELECT v.*, coalesce(e.prediction, (SELECT m FROM overall)) AS prediction
  FROM valid v LEFT JOIN encoding e ON v.event_type = e.event_type),
spread AS (SELECT stddev_samp(label - prediction) AS sigma FROM scored WHERE ts <= (SELECT t80 FROM cut)),
judged AS (
  SELECT *, CASE WHEN desviacion > sigma_threshold THEN 'ATIPICO' ELSE 'LIBRE' END AS anomaly_flag,
         CASE WHEN z_score > 4.5 THEN 'SEVERO' WHEN z_score > 3.5 THEN 'MODERADO' WHEN z_score > 2.8 THEN 'LEVE'
              ELSE 'NORMAL' END AS severity
  FROM (SELECT *, label - prediction AS desviacion, (label - prediction) / nullif((SELECT sigma FROM spread), 0)
               AS z_score, 2.8 * (SELECT sigma FROM spread) AS sigma_threshold
        FROM scored WHERE ts > (SELECT t80 FROM cut)))"""


JUDGED = _judged_sql("value")
JUDGED_LOG = _judged_sql("ln(1 + value)")
