"""Scalar expressions: text, dates, parsers and user functions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from overspend import fixed_values as fv
from overspend.functions import text as txt
from overspend.functions.fields import parse_duration, parse_year
from overspend.functions.scores import tip_category, tip_category_udf
from overspend.functions.times import calendar_parts, days_between, epoch_seconds, minutes_between, seconds_between
from overspend.operators import anomaly, clean
from overspend.operators.encode import keep_positions
from overspend.plans.domain import (
    BRONZE, FARES, JUDGED, TRIPS, department_of, department_sql, fares, judged_events, records, sql_list,
    sql_rows, table, trips,
)
from overspend.plans.registry import query

NORMAL = (f"trim(regexp_replace(regexp_replace(translate(lower(text), '{fv.ACCENTED}', '{fv.UNACCENTED}'), "
          r"'[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))")
CLEAN_TEXT = f"""clean_text AS (SELECT doc_id, limpio FROM (SELECT doc_id, {NORMAL} AS limpio FROM documents)
  WHERE length(limpio) >= {fv.MIN_TEXT_LENGTH})"""
STOP = sql_list(txt.stopwords(fv.STOPWORDS_MEDIUM))
TOKENS = CLEAN_TEXT + r""", tokens AS (SELECT doc_id, string_split(limpio, ' ') AS palabras FROM clean_text)"""
FILTERED = TOKENS + f""", filtered AS (SELECT * FROM (
  SELECT doc_id, list_filter(palabras, lambda x: x NOT IN ({STOP}) AND length(x) >= {fv.MIN_TOKEN_LENGTH}) AS palabras
  FROM tokens) WHERE len(palabras) > 0)"""


def clean_docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return txt.with_clean_text(docs, "text").drop("text")


@query("text_normalize", f"WITH {CLEAN_TEXT} SELECT doc_id, limpio AS objeto_limpio FROM clean_text")
def text_normalize(spark, sf):
    return clean_docs(spark, sf)


@query("tokenize", f"WITH {TOKENS} SELECT doc_id, len(palabras) AS n_palabras, palabras[1] AS primera, "
                   "palabras[len(palabras)] AS ultima FROM tokens")
def tokenize(spark, sf):
    words = clean_docs(spark, sf).select("doc_id", txt.tokenize(F.col("objeto_limpio")).alias("palabras"))
    return words.select("doc_id", F.size("palabras").cast("long").alias("n_palabras"),
                        F.element_at("palabras", 1).alias("primera"), F.element_at("palabras", -1).alias("ultima"))


@query("remove_stopwords", f"""WITH {TOKENS} SELECT doc_id,
  array_to_string(list_filter(palabras, lambda x: x NOT IN ({STOP})), ' ') AS palabras FROM tokens""")
def remove_stopwords(spark, sf):
    words = txt.remove_stopwords(txt.tokenize(F.col("objeto_limpio")), txt.stopwords(fv.STOPWORDS_MEDIUM))
    return clean_docs(spark, sf).select("doc_id", F.array_join(words, " ").alias("palabras"))


@query("remove_stopwords_versions", f"WITH {TOKENS} " + " UNION ALL ".join(
    f"""SELECT '{name}' AS lista, CAST(sum(len(list_filter(palabras, lambda x: x NOT IN ({sql_list(words)})))) AS BIGINT)
  AS n_palabras FROM tokens""" for name, words in (
        ("corta", txt.stopwords(fv.STOPWORDS_SHORT)), ("media", txt.stopwords(fv.STOPWORDS_MEDIUM)),
        ("larga", txt.stopwords(fv.STOPWORDS_LONG)), ("media literal", fv.STOPWORDS_MEDIUM))))
def remove_stopwords_versions(spark, sf):
    tokens = clean_docs(spark, sf).select(txt.tokenize(F.col("objeto_limpio")).alias("palabras"))
    lists = {"corta": txt.stopwords(fv.STOPWORDS_SHORT), "media": txt.stopwords(fv.STOPWORDS_MEDIUM),
             "larga": txt.stopwords(fv.STOPWORDS_LONG), "media literal": txt.stopwords(fv.STOPWORDS_MEDIUM, strict=True)}
    sizes = F.array(*[
        F.struct(F.lit(name).alias("lista"),
                 F.sum(F.size(txt.remove_stopwords(F.col("palabras"), words))).alias("n_palabras"))
        for name, words in lists.items()])
    return tokens.agg(sizes.alias("s")).select(F.inline("s"))


@query("filter_short_tokens", f"WITH {FILTERED} SELECT doc_id, array_to_string(palabras, ' ') AS palabras FROM filtered")
def filter_short_tokens(spark, sf):
    kept = txt.with_tokens(clean_docs(spark, sf))
    return kept.select("doc_id", F.array_join("palabras_filtradas", " ").alias("palabras"))


@query("array_slice_size", f"""WITH {FILTERED} SELECT doc_id, array_to_string(palabras[1:10], ' ') AS muestra,
  CAST(len(palabras) AS INTEGER) AS dimension FROM filtered""")
def array_slice_size(spark, sf):
    kept = txt.with_tokens(clean_docs(spark, sf))
    return kept.select("doc_id", F.array_join(F.slice("palabras_filtradas", 1, 10), " ").alias("muestra"),
                       F.size("palabras_filtradas").alias("dimension"))


@query("date_parts", f"""WITH {TRIPS} SELECT tpep_pickup_datetime, CAST(year(tpep_pickup_datetime) AS INTEGER) AS anno,
  CAST(month(tpep_pickup_datetime) AS INTEGER) AS mes, CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS dia_semana,
  CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hora FROM trips""")
def date_parts(spark, sf):
    return trips(spark, sf).select("tpep_pickup_datetime").withColumns(calendar_parts(F.col("tpep_pickup_datetime")))


@query("duration", f"""WITH {TRIPS} SELECT date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)
  AS duracion_segundos, date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60 AS duracion_minutos
FROM trips""")
def duration(spark, sf):
    start, end = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips(spark, sf).select(seconds_between(start, end).alias("duracion_segundos"),
                                   minutes_between(start, end).alias("duracion_minutos"))


@query("duration_not_positive", f"""WITH {TRIPS} SELECT count(*) AS n FROM trips
WHERE date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) <= 0""")
def duration_not_positive(spark, sf):
    start, end = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips(spark, sf).where(seconds_between(start, end) <= 0).agg(F.count("*").alias("n"))


@query("date_diff_days", f"""WITH {TRIPS} SELECT tpep_pickup_datetime, CAST(date_diff('day',
  CAST(tpep_pickup_datetime AS DATE), CAST(tpep_dropoff_datetime AS DATE)) AS INTEGER) AS dias_de_viaje FROM trips""")
def date_diff_days(spark, sf):
    return trips(spark, sf).select("tpep_pickup_datetime", days_between(
        F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")).alias("dias_de_viaje"))


@query("epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS segundos FROM events")
def epochs(spark, sf):
    return table(spark, sf, "events").select("event_id", epoch_seconds(F.col("ts")).alias("segundos"))


@query("log_target", "SELECT o_orderkey, round(ln(1 + o_totalprice), 8) AS log_valor_contrato FROM orders")
def log_target(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.round(F.log1p("o_totalprice"), 8).alias("log_valor_contrato"))


@query("json_parse", f"""WITH {BRONZE} SELECT "partition", "offset", id_contrato, valor_contrato, anno FROM bronze""")
def json_parse(spark, sf):
    return clean.parse_records(records(spark, sf)).select("partition", "offset", "id_contrato", "valor_contrato", "anno")


@query("json_parse_events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_parse_events(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


def _free_text():
    """Text as people fill in a duration or year field."""
    key, number = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    return (
        F.when(key % 10 == 0, F.lit("")).when(key % 10 == 1, "No Definido").when(key % 10 == 2, " ND ")
        .when(key % 10 == 3, "sin definir").when(key % 10 == 4, number)
        .when(key % 10 == 5, F.concat(number, F.lit(" Dia(s)")))
        .when(key % 10 == 6, F.concat(F.lit("BPIN "), F.year("o_orderdate").cast("string"), F.lit("-1")))
        .when(key % 10 == 7, F.concat(F.lit("1"), F.lpad(number, 6, "0")))
        .when(key % 10 == 8, F.lit(None).cast("string")).otherwise("99999999999999999999"))


FREE_TEXT = """typed AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'No Definido' WHEN 2 THEN ' ND '
  WHEN 3 THEN 'sin definir' WHEN 4 THEN CAST(o_custkey AS VARCHAR) WHEN 5 THEN CAST(o_custkey AS VARCHAR) || ' Dia(s)'
  WHEN 6 THEN 'BPIN ' || CAST(year(o_orderdate) AS VARCHAR) || '-1' WHEN 7 THEN '1' || lpad(CAST(o_custkey AS VARCHAR), 6, '0')
  WHEN 8 THEN NULL ELSE '99999999999999999999' END AS t FROM orders)"""
DURATION_SQL = (f"CASE WHEN lower(trim(t)) NOT IN ({sql_list(fv.BLANK_DURATION_WORDS)}) "
                r"THEN TRY_CAST(regexp_extract(t, '\d+') AS INTEGER) END")
YEAR_SQL = (f"coalesce(CASE WHEN lower(trim(t)) NOT IN ({sql_list(fv.BLANK_YEAR_WORDS)}) "
            r"THEN TRY_CAST(regexp_extract(t, '\d{4}') AS INTEGER) END, 2024)")


@query("parse_duration", f"WITH {FREE_TEXT} SELECT o_orderkey, t AS texto, {DURATION_SQL} AS duracion_dias FROM typed")
def durations(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", _free_text().alias("texto"), parse_duration(_free_text()).alias("duracion_dias"))


@query("parse_year", f"WITH {FREE_TEXT} SELECT o_orderkey, t AS texto, {YEAR_SQL} AS anno FROM typed")
def years(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", _free_text().alias("texto"), parse_year(_free_text()).alias("anno"))


@query("normalize_message", f"""WITH {FREE_TEXT}, dictionary(departamento, region) AS
  (VALUES {sql_rows(fv.DEPARTMENT_REGION + fv.DEPARTMENT_REGION_MORE)}),
raw AS (SELECT o.*, t, CASE WHEN o.o_orderkey % 5 <> 0 THEN 'REF-' || CAST(o.o_orderkey AS VARCHAR) END AS ref,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE {department_sql('o_custkey')} END AS dep
  FROM orders o JOIN typed ON o.o_orderkey = typed.o_orderkey)
SELECT coalesce(ref, 'CT-' || CAST(o_orderkey AS VARCHAR)) AS id_contrato, coalesce(ref, '') AS duplicate_id,
  coalesce(dep, '') AS departamento, coalesce(region, 'Desconocida') AS region, o_orderpriority AS codigo_unspsc,
  CASE WHEN o_orderkey % 11 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS valor_contrato,
  {DURATION_SQL} AS duracion_dias, {YEAR_SQL} AS anno, 'SYS-' || CAST(o_orderkey AS VARCHAR) AS id_interno_sistema,
  CAST(NULL AS VARCHAR) AS campo_vacio, 'VALOR_FIJO' AS constante_1, 100 AS constante_2
FROM raw LEFT JOIN dictionary d ON dep = d.departamento""")
def normalize_message(spark, sf):
    key = F.col("o_orderkey")
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 5 != 0, F.concat(F.lit("REF-"), key.cast("string"))).alias("referencia_del_contrato"),
        F.lit("Suministro").alias("descripcion_del_procedimiento"),
        F.col("o_custkey").cast("string").alias("nombre_entidad"),
        F.when(key % 7 != 0, department_of(F.col("o_custkey"))).alias("departamento"),
        F.lit(None).cast("string").alias("municipio"),
        F.col("o_orderpriority").alias("codigo_de_categoria_principal"),
        F.lit("Proceso").alias("descripcion_del_proceso"),
        F.when(key % 11 != 0, F.col("o_totalprice").cast("string")).alias("valor_del_contrato"),
        _free_text().alias("duraci_n_del_contrato"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha_de_inicio_del_contrato"),
        F.lit("Obra").alias("tipo_de_contrato"),
        F.col("o_orderstatus").alias("estado_contrato"),
        F.lit("Directa").alias("modalidad_de_contratacion"),
        _free_text().alias("anno_bpin"),
    )
    return clean.normalize_source(raw, "o_orderkey").select(
        "id_contrato", "duplicate_id", "departamento", "region", "codigo_unspsc", "valor_contrato", "duracion_dias",
        "anno", "id_interno_sistema", "campo_vacio", "constante_1", "constante_2")


@query("stamp", f"WITH {JUDGED} SELECT event_id, anomaly_flag, TRUE AS sellado, 'media_grupo_v1' AS model_version FROM judged")
def stamp(spark, sf):
    """The stamp's time is that of the run, so it is tested and not shown."""
    now = F.current_timestamp()
    stamped = anomaly.stamp(judged_events(spark, sf), "media_grupo_v1")
    return stamped.select("event_id", "anomaly_flag", (F.col("detection_timestamp").isNotNull() & (F.col("detection_timestamp") <= now)).alias("sellado"), "model_version")


UDF_ROWS = FARES + """, odd AS (SELECT CASE WHEN passenger_count = 3 THEN NULL ELSE tip_amount END AS tip_amount,
  CASE WHEN passenger_count = 1 THEN 0.0::DOUBLE WHEN passenger_count = 2 THEN NULL ELSE total_amount END AS total_amount
  FROM fares)"""
UDF_SQL = f"""WITH {UDF_ROWS} SELECT tip_amount, total_amount, CASE WHEN total_amount IS NULL OR total_amount = 0 THEN 'N/A'
  WHEN coalesce(tip_amount, 0) / total_amount * 100 > 25 THEN 'Alta'
  WHEN coalesce(tip_amount, 0) / total_amount * 100 > 15 THEN 'Media'
  WHEN coalesce(tip_amount, 0) / total_amount * 100 > 0 THEN 'Baja' ELSE 'Ninguna' END AS categoria_propina FROM odd"""


def _odd_fares(spark, sf):
    passengers = F.col("passenger_count")
    return fares(spark, sf).select(
        F.when(passengers.eqNullSafe(3), None).otherwise(F.col("tip_amount")).alias("tip_amount"),
        F.when(passengers == 1, 0.0).when(passengers == 2, None).otherwise(F.col("total_amount")).alias("total_amount"))


@query("udf_tip_category", UDF_SQL)
def udf_tip_category(spark, sf):
    return _odd_fares(spark, sf).withColumn(
        "categoria_propina", tip_category(F.col("tip_amount"), F.col("total_amount")))


@query("udf_tip_category_python", UDF_SQL)
def udf_tip_category_python(spark, sf):
    return _odd_fares(spark, sf).withColumn(
        "categoria_propina", tip_category_udf(F.col("tip_amount"), F.col("total_amount")))


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))


@query("vector_to_array", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[1] AS DOUBLE) AS primero, "
                          "CAST(embedding[len(embedding)] AS DOUBLE) AS ultimo FROM embeddings")
def vectors_to_arrays(spark, sf):
    arrays = _vectors(spark, sf).select("vec_id", vector_to_array("v").alias("a"))
    return arrays.select("vec_id", F.size("a").alias("n"), F.element_at("a", 1).alias("primero"),
                         F.element_at("a", -1).alias("ultimo"))


@query("vector_select", """SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN 0 ELSE CAST(embedding[3] AS DOUBLE) END AS p2,
  CASE WHEN vec_id % 10 = 0 THEN 0 ELSE CAST(embedding[6] AS DOUBLE) END AS p5,
  CASE WHEN vec_id % 10 = 0 THEN 0 ELSE CAST(embedding[12] AS DOUBLE) END AS p11 FROM embeddings""")
def vector_select(spark, sf):
    some_null = _vectors(spark, sf).withColumn("v", F.when(F.col("vec_id") % 10 != 0, F.col("v")))
    kept = keep_positions(some_null, "v", [2, 5, 11], "k").select("vec_id", vector_to_array("k").alias("a"))
    return kept.select("vec_id", *[F.element_at("a", i + 1).alias(f"p{p}") for i, p in enumerate([2, 5, 11])])


@query("vector_append", "SELECT vec_id, CAST(len(embedding) + 1 AS INTEGER) AS n, CAST(label AS DOUBLE) AS ultimo FROM embeddings")
def vector_append(spark, sf):
    joined = VectorAssembler(inputCols=["v", "label"], outputCol="vl").transform(_vectors(spark, sf))
    return joined.select("vec_id", F.size(vector_to_array("vl")).alias("n"),
                         F.element_at(vector_to_array("vl"), -1).alias("ultimo"))
