"""Encodings, splits, metrics and the anomaly rule."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from overspend.operators import anomaly, encode, models, profile
from overspend.operators.lookup import attach_by_key
from overspend.plans.domain import (
    CONTRACTS, JUDGED, JUDGED_LOG, contracts, judged_events, round_columns, rounded, table,
)
from overspend.plans.registry import query


INDEXED = CONTRACTS + """, ranked AS (
  SELECT codigo_unspsc, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, codigo_unspsc) - 1 AS pos
  FROM contracts WHERE codigo_unspsc <> '5-LOW' GROUP BY codigo_unspsc)"""


def _indexed(spark, sf):
    """Fitted without one label, so that label takes the index for unseen ones."""
    rows = contracts(spark, sf).select("id_contrato", "codigo_unspsc")
    stages = encode.index_and_one_hot(["codigo_unspsc"])
    return Pipeline(stages=stages).fit(rows.where(F.col("codigo_unspsc") != "5-LOW")).transform(rows)


@query("string_index", f"""WITH {INDEXED} SELECT c.id_contrato, c.codigo_unspsc,
  CAST(coalesce(pos, (SELECT count(*) FROM ranked)) AS DOUBLE) AS codigo_unspsc_idx
FROM contracts c LEFT JOIN ranked r ON c.codigo_unspsc = r.codigo_unspsc""")
def string_index(spark, sf):
    return _indexed(spark, sf).select("id_contrato", "codigo_unspsc", "codigo_unspsc_idx")


@query("one_hot", f"""WITH {INDEXED} SELECT c.id_contrato, CAST((SELECT count(*) FROM ranked) AS INTEGER) AS ancho,
  CASE WHEN pos IS NULL THEN 0 ELSE 1.0::DOUBLE END AS suma, CAST(coalesce(pos, -1) AS INTEGER) AS posicion
FROM contracts c LEFT JOIN ranked r ON c.codigo_unspsc = r.codigo_unspsc""")
def one_hot(spark, sf):
    arrays = _indexed(spark, sf).select("id_contrato", vector_to_array("codigo_unspsc_ohe").alias("a"))
    return arrays.select("id_contrato", F.size("a").alias("ancho"),
                         F.aggregate("a", F.lit(0.0), lambda s, x: s + x).alias("suma"),
                         (F.array_position("a", 1.0) - 1).cast("int").alias("posicion"))


@query("frequency_encode", f"""WITH {CONTRACTS}, f AS (
  SELECT entidad, count(*) / (SELECT count(*) FROM contracts) AS entidad_freq FROM contracts GROUP BY entidad)
SELECT id_contrato, c.entidad, round(entidad_freq, 10) AS entidad_freq FROM contracts c LEFT JOIN f ON c.entidad = f.entidad""")
def frequency_encode(spark, sf):
    encoded = encode.frequency_encode(contracts(spark, sf).select("id_contrato", "entidad"), "entidad")
    return round_columns(encoded, ["entidad_freq"], 10)


@query("target_encode", f"""WITH {CONTRACTS}, g AS (SELECT avg(valor_contrato) AS m FROM contracts), s AS (
  SELECT entidad, (count(valor_contrato) * avg(valor_contrato) + 50 * (SELECT m FROM g)) / (count(valor_contrato) + 50)
    AS entidad_te FROM contracts GROUP BY entidad)
SELECT id_contrato, c.entidad, round(entidad_te, 4) AS entidad_te FROM contracts c LEFT JOIN s ON c.entidad = s.entidad""")
def target_encode(spark, sf):
    rows = contracts(spark, sf).select("id_contrato", "entidad", "valor_contrato")
    encoded = encode.target_encode(rows, "entidad", "valor_contrato")
    return round_columns(encoded.drop("valor_contrato"), ["entidad_te"], 4)


SPLIT = CONTRACTS + """, cut AS (SELECT quantile_disc(fecha_firma, 0.8) AS t80 FROM contracts)"""


@query("target_encode_split", f"""WITH {SPLIT}, train AS (
  SELECT *, ln(1 + valor_contrato) AS l FROM contracts
  WHERE fecha_firma <= (SELECT t80 FROM cut) AND codigo_unspsc <> '2-HIGH'),
s AS (SELECT codigo_unspsc, (count(l) * avg(l) + 50 * (SELECT avg(l) FROM train)) / (count(l) + 50) AS te
  FROM train GROUP BY codigo_unspsc)
SELECT id_contrato, c.codigo_unspsc, round(coalesce(te, (SELECT avg(l) FROM train)), 8) AS codigo_unspsc_te_log
FROM contracts c LEFT JOIN s ON c.codigo_unspsc = s.codigo_unspsc WHERE fecha_firma > (SELECT t80 FROM cut)""")
def target_encode_split(spark, sf):
    """One category is kept out of training, so later rows meet an unseen one."""
    rows = contracts(spark, sf).select("id_contrato", "codigo_unspsc", "fecha_firma", F.log1p("valor_contrato").alias("label"))
    train, test, _ = encode.temporal_split(rows, "fecha_firma")
    fitted = encode.fit_target_encoding(
        train.where(F.col("codigo_unspsc") != "2-HIGH"), "codigo_unspsc", "label", "codigo_unspsc_te_log")
    encoded = fitted.apply(test).select("id_contrato", "codigo_unspsc", "codigo_unspsc_te_log")
    return round_columns(encoded, ["codigo_unspsc_te_log"], 8)


@query("temporal_split", f"""WITH {SPLIT} SELECT CASE WHEN fecha_firma <= (SELECT t80 FROM cut) THEN 'train' ELSE 'test' END
  AS parte, count(*) AS n, min(fecha_firma) AS desde, max(fecha_firma) AS hasta FROM contracts GROUP BY 1""")
def temporal_split(spark, sf):
    rows = contracts(spark, sf).select("fecha_firma")
    train, test, _ = encode.temporal_split(rows, "fecha_firma")

    def described(part, name):
        return part.groupBy(F.lit(name).alias("parte")).agg(
            F.count("*").alias("n"), F.min("fecha_firma").alias("desde"), F.max("fecha_firma").alias("hasta"))

    return described(train, "train").unionByName(described(test, "test"))


@query("assemble", f"""WITH {CONTRACTS} SELECT id_contrato, 3 AS dimension,
  round(valor_contrato + duracion_dias + anno, 2) AS suma FROM contracts WHERE duracion_dias IS NOT NULL""")
def assemble(spark, sf):
    rows = encode.assemble(contracts(spark, sf), ["valor_contrato", "duracion_dias", "anno"])
    arrays = rows.select("id_contrato", vector_to_array("features_raw").alias("a"))
    return arrays.select("id_contrato", F.size("a").alias("dimension"),
                         F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 2).alias("suma"))


@query("standardize", """WITH cut AS (SELECT quantile_disc(o_orderdate, 0.8) AS t80 FROM orders),
s AS (SELECT avg(o_totalprice) AS m1, stddev_samp(o_totalprice) AS d1, avg(CAST(o_custkey AS DOUBLE)) AS m2,
        stddev_samp(CAST(o_custkey AS DOUBLE)) AS d2 FROM orders WHERE o_orderdate <= (SELECT t80 FROM cut))
SELECT o_orderkey, round((o_totalprice - (SELECT m1 FROM s)) / (SELECT d1 FROM s), 6) AS valor_z,
  round((o_custkey - (SELECT m2 FROM s)) / (SELECT d2 FROM s), 6) AS entidad_z
FROM orders WHERE o_orderdate > (SELECT t80 FROM cut)""")
def standardize(spark, sf):
    rows = encode.assemble(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"])
    train, test, _ = encode.temporal_split(rows, "o_orderdate")
    _, scaled, _ = encode.scale_split(train, test)
    arrays = scaled.select("o_orderkey", vector_to_array("features").alias("a"))
    return arrays.select("o_orderkey", F.round(F.element_at("a", 1), 6).alias("valor_z"),
                         F.round(F.element_at("a", 2), 6).alias("entidad_z"))


CANDIDATES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@query("select_features", "WITH r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, l_extendedprice * (1 - l_discount)) AS r FROM lineitem" for c in CANDIDATES)
    + ") SELECT feature, round(r, 8) AS r FROM r WHERE NOT isnan(r) AND abs(r) >= 0.05")
def select_features(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("venta", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    kept = profile.select_features(profile.correlations(rows, CANDIDATES, "venta"))
    return round_columns(kept, ["r"], 8)


@query("select_vector_features", """
WITH flat AS (SELECT CAST(label AS DOUBLE) AS y, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS position
              FROM embeddings),
r AS (SELECT CAST(position AS INTEGER) AS position, corr(CAST(x AS DOUBLE), y) AS r FROM flat GROUP BY position)
SELECT position, round(r, 8) AS r FROM r WHERE NOT isnan(r) AND abs(r) >= 0.05""")
def select_vector_features(spark, sf):
    kept = profile.select_features(profile.vector_correlations(table(spark, sf, "embeddings"), "embedding", "label"))
    return round_columns(kept, ["r"], 8)


def labelled_docs(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id")


@query("binary_metrics", """
WITH rows AS (SELECT d.source, quality AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT avg(y) AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM rows GROUP BY source),
g AS (SELECT score, sum(pos) AS pos, sum(neg) AS neg FROM s GROUP BY score),
c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
      FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
pts AS (SELECT score, tp / p AS recall, fp / n AS fpr, tp / (tp + fp) AS prec FROM c),
steps AS (SELECT recall, fpr, prec, coalesce(lag(recall) OVER o, 0) AS r0, coalesce(lag(fpr) OVER o, 0) AS f0,
                 coalesce(lag(prec) OVER o, prec) AS p0 FROM pts WINDOW o AS (ORDER BY score DESC))
SELECT round(sum((fpr - f0) * (recall + r0) / 2), 6) AS area_under_roc,
       round(sum((recall - r0) * (prec + p0) / 2), 6) AS area_under_pr FROM steps""")
def binary_metrics(spark, sf):
    """Quality predicted by the mean quality of a document's source."""
    rows = labelled_docs(spark, sf).select("source", F.col("label").cast("double").alias("label"))
    means = rows.groupBy("source").agg(F.avg("label").alias("score"), F.count("*").alias("n_rows"))
    scored = attach_by_key(rows, means, "source", "n_rows").persist()
    metrics = round_columns(models.binary_metrics(scored, "score"), ["area_under_roc", "area_under_pr"])
    scored.unpersist()
    return metrics


METRICS = """round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(label)), 8) AS r2,
  round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse, round(avg(abs(label - prediction)), 6) AS mae"""


@query("regression_metrics", f"WITH {JUDGED} SELECT {METRICS} FROM judged")
def regression_metrics(spark, sf):
    metrics = models.regression_metrics(judged_events(spark, sf))
    return round_columns(round_columns(metrics, ["r2"], 8), ["rmse", "mae"])


@query("residual_sigma", f"""WITH {JUDGED} SELECT round(sigma, 6) AS sigma, round(2.8 * sigma, 6) AS threshold FROM spread""")
def residual_sigma(spark, sf):
    train, _ = anomaly.group_mean_scores(table(spark, sf, "events"), "value", "event_type", "ts")
    return round_columns(anomaly.residual_sigma(train), ["sigma", "threshold"])


@query("anomaly_flag", f"WITH {JUDGED} SELECT event_id, anomaly_flag FROM judged")
def anomaly_flag(spark, sf):
    return judged_events(spark, sf).select("event_id", "anomaly_flag")


@query("anomaly_flag_log", f"WITH {JUDGED_LOG} SELECT event_id, round(desviacion, 6) AS desviacion, "
                           "round(z_score, 6) AS z_score, anomaly_flag FROM judged")
def anomaly_flag_log(spark, sf):
    return judged_events(spark, sf, "log1p").select("event_id", rounded("desviacion"), rounded("z_score"), "anomaly_flag")


@query("z_score", f"WITH {JUDGED} SELECT event_id, round(z_score, 6) AS z_score, "
                  "round(sigma_threshold, 6) AS sigma_threshold FROM judged")
def z_score(spark, sf):
    return judged_events(spark, sf).select("event_id", rounded("z_score"), rounded("sigma_threshold"))


@query("severity", f"WITH {JUDGED} SELECT event_id, severity FROM judged")
def severity(spark, sf):
    return judged_events(spark, sf).select("event_id", "severity")


@query("high_severity", f"WITH {JUDGED} SELECT event_id, severity, round(z_score, 6) AS z_score FROM judged "
                        "WHERE anomaly_flag = 'ATIPICO' AND severity IN ('SEVERO', 'MODERADO')")
def high_severity(spark, sf):
    return anomaly.high_severity(judged_events(spark, sf)).select("event_id", "severity", rounded("z_score"))


@query("champion_challenger", f"""WITH {JUDGED}, base AS (SELECT value AS label, (SELECT m FROM overall) AS prediction
  FROM valid WHERE ts > (SELECT t80 FROM cut)),
old AS (SELECT {METRICS} FROM base),
paired AS (SELECT r2 AS new_r2, rmse AS new_rmse, (SELECT r2 FROM old) AS old_r2, (SELECT rmse FROM old) AS old_rmse
  FROM (SELECT {METRICS} FROM judged))
SELECT *, CASE WHEN new_r2 > old_r2 AND new_rmse < old_rmse THEN 'PROMOTED' ELSE 'NOT_PROMOTED' END AS verdict
FROM paired""")
def champion_challenger(spark, sf):
    """Group means challenge the overall mean."""
    train, test = anomaly.group_mean_scores(table(spark, sf, "events"), "value", "event_type", "ts")
    overall = train.agg(F.avg("label")).first()[0]
    report = models.compare_models(test, test.withColumn("prediction", F.lit(overall)))
    return round_columns(round_columns(report, ["new_r2", "old_r2"], 8), ["new_rmse", "old_rmse"])
