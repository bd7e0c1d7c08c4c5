"""Fitted models. Their numbers are beyond SQL, so the queries give what SQL can state of every row: which rows take part, what they were fitted
from, and that each result obeys the conditions that define it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, functions as F

from overspend import fixed_values as fv
from overspend.functions import text as txt
from overspend.functions.scores import flag, severity
from overspend.operators import anomaly, encode, models, trees, trips as trip_ops
from overspend.operators.feature_tables import FeatureTables, word_parts
from overspend.plans.domain import CLEAN, CONTRACTS, contracts, doc_contracts, round_columns, table, trips
from overspend.plans.features import labelled_docs
from overspend.plans.registry import query
from overspend.plans.values import FILTERED, NORMAL, STOP, clean_docs
from overspend.session import shared_dir, stored

#: Rows of one part of a stored table that models are fitted from. The number of parts follows the rows, not the cluster.
ROWS_PER_PART = 25_000


def parts_of(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_PART))


#: Parts and rows of a part from which on the parts of the price rows grow longer: each is sorted in itself, and a longer one has more rows that are alike.
PRICE_PARTS, PRICE_ROWS_PER_PART = 48, 100_000


def price_parts(rows: int) -> int:
    return min(parts_of(rows), max(PRICE_PARTS, -(-rows // PRICE_ROWS_PER_PART)))


def micro(values: Column) -> Column:
    """Numbers in millionths as one text, so that whole arrays can be compared."""
    return F.array_join(F.transform(values, lambda x: F.round(x * 1_000_000).cast("long").cast("string")), " ")


@query("word2vec", f"WITH {FILTERED} SELECT doc_id, 100 AS dimension, len(palabras) AS n_palabras, 0.0::DOUBLE AS diferencia FROM filtered")
def word2vec(spark, sf):
    """Each document's vector, and how far it is from the mean of its words' vectors in the fitted vocabulary."""
    tokens = stored(txt.with_tokens(clean_docs(spark, sf)).select("doc_id", "palabras_filtradas"), "tokens")
    fitted = models.word2vec(numPartitions=word_parts(tokens)).fit(tokens)
    vocabulary = stored(fitted.getVectors(), "vocabulary")
    words = tokens.select("doc_id", F.explode("palabras_filtradas").alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    sums = words.join(vocabulary, "word").groupBy("doc_id").agg(Summarizer.mean(F.col("vector"), F.col("n").cast("double")).alias("v"), F.sum("n").alias("known"))
    sums = sums.select("doc_id", "known", vector_to_array("v").alias("mean"))
    given = fitted.transform(tokens).join(sums, "doc_id", "left")
    size = F.size("palabras_filtradas")
    own, mean = vector_to_array("embedding_raw"), F.coalesce("mean", F.array_repeat(F.lit(0.0), 100))
    off = F.array_max(F.zip_with(own, mean, lambda a, b: F.abs(a - b * F.coalesce("known", F.lit(0)) / size)))
    return given.select("doc_id", F.size(own).alias("dimension"), size.cast("long").alias("n_palabras"), F.round(off, 6).alias("diferencia"))


SMALL_VECTORS = {"vectorSize": 8, "maxIter": 1}
LISTED = {"tipo_contrato": "t", "estado_contrato": "e", "modalidad": "m"}
ENCODED = CONTRACTS + f""", tok AS (
  SELECT * FROM (
    SELECT *, list_filter(string_split(limpio, ' '), lambda x: x NOT IN ({STOP}) AND length(x) >= {fv.MIN_TOKEN_LENGTH}) AS palabras
    FROM (SELECT *, {NORMAL.replace('lower(text)', 'lower(objeto_contrato)')} AS limpio, ln(1 + valor_contrato) AS label FROM contracts)
    WHERE length(limpio) >= {fv.MIN_TEXT_LENGTH}) WHERE len(palabras) > 0),
cut AS (SELECT quantile_disc(fecha_firma, 0.8) AS t80 FROM tok),
train AS (SELECT * FROM tok WHERE fecha_firma <= (SELECT t80 FROM cut)),
freq AS (SELECT entidad, count(*) / (SELECT count(*) FROM train) AS f FROM train GROUP BY entidad),
enc AS (SELECT codigo_unspsc, (count(label) * avg(label) + 50 * (SELECT avg(label) FROM train)) / (count(label) + 50) AS te FROM train GROUP BY 1),
""" + ", ".join(f"{a} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS pos FROM train GROUP BY {c})" for c, a in LISTED.items())


def _features_sql(side: str) -> str:
    one_hot = ", ".join(f"list_transform(range((SELECT count(*) FROM {a})), lambda i: CASE WHEN i = {a}.pos THEN 1000000 ELSE 0 END)" for a in LISTED.values())
    numbers = ["coalesce(f, 0)", "coalesce(te, (SELECT avg(label) FROM train))", "coalesce(duracion_dias, 0)"]
    listed = ", ".join(f"CAST(round({n} * 1000000.0::DOUBLE) AS BIGINT)" for n in numbers)
    joins = " ".join(f"LEFT JOIN {a} ON k.{c} = {a}.{c}" for c, a in LISTED.items())
    return f"""WITH {ENCODED}
SELECT id_contrato, array_to_string(palabras, ' ') AS palabras, round(label, 8) AS label,
  array_to_string(flatten([{one_hot}, [{listed}]]), ' ') AS vector
FROM tok k LEFT JOIN freq ON k.entidad = freq.entidad LEFT JOIN enc ON k.codigo_unspsc = enc.codigo_unspsc {joins}
WHERE fecha_firma {side} (SELECT t80 FROM cut)"""


def _feature_rows(spark, sf, part: str):
    """One side of the stored tables: tokens, target, and all positions of the vector after the word vectors."""
    rows = contracts(spark, sf)
    tables = FeatureTables.build(rows, shared_dir(spark, "features"), w2v=SMALL_VECTORS, parts=parts_of(table(spark, sf, "orders").count()))
    values = vector_to_array("features_raw")
    return getattr(tables, part).select("id_contrato", F.array_join("palabras_filtradas", " ").alias("palabras"), F.round("label", 8).alias("label"),
                                        micro(F.slice(values, SMALL_VECTORS["vectorSize"] + 1, F.size(values))).alias("vector"))


@query("feature_table_train", _features_sql("<="))
def feature_table_train(spark, sf):
    return _feature_rows(spark, sf, "train")


@query("feature_table_test", _features_sql(">"))
def feature_table_test(spark, sf):
    return _feature_rows(spark, sf, "test")


PRICED = """priced AS (
  SELECT l_orderkey, l_linenumber, o_orderdate, l_quantity, l_discount, l_tax, l_partkey, l_extendedprice AS valor_contrato, ln(1 + l_extendedprice) AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cut AS (SELECT quantile_disc(o_orderdate, 0.8) AS t80 FROM priced)"""


PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_partkey"]


def price_tables(spark, sf):
    """Line items with their order's date as training and test rows of a price regression; the join is run once and its rows are stored.

    Neighbours in a stored part are alike in what a price follows, so a fit's passes take one row after the other down the same paths of its trees.
    """
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = stored(joined.select("o_orderdate", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_partkey",
                                F.log1p("l_extendedprice").alias("label"), F.col("l_extendedprice").alias("valor_contrato"))
                  .repartition(price_parts(lines.count())).sortWithinPartitions(*PRICE_FEATURES), "price-rows")
    train, test, _ = encode.temporal_split(encode.assemble(rows, PRICE_FEATURES), "o_orderdate")
    return encode.scale_split(train, test)[:2]


@query("linear_regression", f"""WITH {PRICED} SELECT count(*) FILTER (o_orderdate <= t80) AS n, 0.0::DOUBLE AS residual,
  count(*) FILTER (o_orderdate > t80) AS n_test FROM priced, cut""")
def linear_regression(spark, sf):
    """How far the fitted model is from the optimum of its objective over all training rows, and how many rows it scores."""
    train, test = price_tables(spark, sf)
    model = models.linear().fit(train.select("features", "label"))
    scored = model.transform(test).agg(F.count("prediction").alias("n_test"))
    return round_columns(models.optimality(train, model), ["residual"], 3).crossJoin(F.broadcast(scored))


@query("linear_slope", f"""WITH {PRICED} SELECT round(regr_slope(label, l_quantity), 8) AS pendiente,
  round(regr_intercept(label, l_quantity), 8) AS origen FROM priced, cut WHERE o_orderdate <= t80""")
def linear_slope(spark, sf):
    """One feature without penalty: the line of least squares."""
    train, _ = price_tables(spark, sf)
    model = models.linear("cantidad", regParam=0.0, solver="normal").fit(encode.assemble(train.select("l_quantity", "label"), ["l_quantity"], "cantidad"))
    return spark.createDataFrame([(round(float(model.coefficients[0]), 8), round(float(model.intercept), 8))], "pendiente double, origen double")


@query("random_forest", f"""WITH {PRICED} SELECT l_orderkey, l_linenumber, round(label, 8) AS label, 0.0::DOUBLE AS diferencia
FROM priced, cut WHERE o_orderdate > t80""")
def random_forest(spark, sf):
    """Later rows scored by the fitted forest, and the difference to the walk through its table of nodes."""
    train, test = price_tables(spark, sf)
    model = models.forest().fit(train.select("features", "label"))
    walked = trees.forest_expression(trees.node_table(spark, model), "features")
    return model.transform(test).select("l_orderkey", "l_linenumber", F.round("label", 8).alias("label"), F.abs(F.col("prediction") - walked).alias("diferencia"))


@query("forest_nodes", """SELECT CAST(t AS INTEGER) AS tree, TRUE AS valores, TRUE AS filas, TRUE AS hojas FROM range(30) AS r(t)""")
def forest_nodes(spark, sf):
    """Per tree of the fitted forest: values are means of their children by rows, rows add up, and there is one leaf more than splits."""
    train, _ = price_tables(spark, sf)
    nodes = stored(trees.node_table(spark, models.forest().fit(train.select("features", "label"))), "nodes")
    child = nodes.select("tree", "node", "value", "rows")
    both = nodes.join(child.toDF("tree", "left", "value_l", "rows_l"), ["tree", "left"], "left").join(
        child.toDF("tree", "right", "value_r", "rows_r"), ["tree", "right"], "left")
    inner = F.col("feature").isNotNull()
    mean = (F.col("value_l") * F.col("rows_l") + F.col("value_r") * F.col("rows_r")) / F.col("rows")
    return both.groupBy("tree").agg(F.bool_and(~inner | (F.abs(F.col("value") - mean) < 1e-6)).alias("valores"),
                                    F.bool_and(~inner | (F.col("rows") == F.col("rows_l") + F.col("rows_r"))).alias("filas"),
                                    (F.count_if(~inner) == F.count_if(inner) + 1).alias("hojas"))


def _obeys(sigma: Column) -> Column:
    """Whether deviation, limit, z-score, flag and severity of a row follow from its value and prediction."""
    off = F.col("valor_log") - F.col("valor_predicho_log")
    near = lambda a, b: F.abs(a - b) <= 1e-9 * (1 + F.abs(b))
    return (near(F.col("desviacion_log"), off) & near(F.col("sigma_threshold"), sigma * fv.SIGMA_MULTIPLIER) & near(F.col("z_score"), off / sigma)
            & (F.col("anomaly_flag") == flag(off, sigma * fv.SIGMA_MULTIPLIER)) & (F.col("severity") == severity(F.col("z_score")))
            & F.col("detection_timestamp").isNotNull())


@query("gold_anomalies_forest", f"""WITH {PRICED} SELECT valor_contrato, round(label, 8) AS valor_log, TRUE AS regla, 'rf_log_v1' AS model_version
FROM priced, cut WHERE o_orderdate > t80""")
def gold_anomalies_forest(spark, sf):
    """The anomaly table with the forest as predictor, and whether each row obeys the rule."""
    train, test = price_tables(spark, sf)
    fitted = models.forest().fit(train.select("features", "label"))
    sigma = anomaly.residual_sigma(fitted.transform(train)).first().sigma
    gold = anomaly.gold_table(anomaly.score_anomalies(fitted.transform(test), sigma), "valor_contrato", "rf_log_v1")
    return gold.select("valor_contrato", F.round("valor_log", 8).alias("valor_log"), _obeys(F.lit(sigma)).alias("regla"), "model_version")


DOC_TRAIN = f"""{FILTERED}, usable AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id_contrato, CAST(n_chars AS DOUBLE) AS valor_contrato,
         DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS fecha_firma
  FROM documents d JOIN filtered f ON d.doc_id = f.doc_id),
cut AS (SELECT quantile_disc(fecha_firma, 0.8) AS t80 FROM usable)"""


@query("train_and_score", f"""WITH {DOC_TRAIN} SELECT id_contrato, valor_contrato, round(ln(1 + valor_contrato), 8) AS valor_log, TRUE AS regla,
  0.0::DOUBLE AS diferencia, 'rf_log_v1' AS model_version FROM usable, cut WHERE fecha_firma > t80""")
def train_and_score(spark, sf):
    """Store the features of documents, fit the price model to the earlier ones, save it, load it and judge the later ones.

    ``diferencia`` is how far the loaded model's prediction from the raw text is from the fitted model's prediction from the stored features.
    """
    rows = doc_contracts(spark, sf)
    tables = FeatureTables.build(rows, shared_dir(spark, "features"))
    model = models.PriceModel.fit_tables(tables)
    folder = shared_dir(spark, "price-model")
    model.save(folder)
    loaded = models.PriceModel.load(spark, folder)
    judged = loaded.judge(loaded.predict_stored(tables.test))
    gold = anomaly.gold_table(judged, "valor_contrato", loaded.version, keep=["id_contrato"])
    keys = tables.test.select("id_contrato")
    again = loaded.predict(rows.join(keys, "id_contrato", "left_semi")).select("id_contrato", F.col("prediction").alias("again"))
    both = gold.join(again, "id_contrato", "left")
    return both.select("id_contrato", "valor_contrato", F.round("valor_log", 8).alias("valor_log"), _obeys(F.lit(loaded.sigma)).alias("regla"),
                       F.round(F.abs(F.col("again") - F.col("valor_predicho_log")), 9).alias("diferencia"), "model_version")


@query("logistic_regression", """SELECT source, count(*) AS n, CAST(sum(quality) AS BIGINT) AS positivos, CAST(sum(quality) AS DOUBLE) AS esperados
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY source""")
def logistic_regression(spark, sf):
    """Per category the labels and the sum of their probabilities, which are equal at the optimum of the likelihood."""
    rows = stored(labelled_docs(spark, sf), "labelled")
    scored = models.buyer_classifier("source", "n_chars", maxIter=500, tol=1e-12).fit(rows).transform(rows)
    chance = F.get(vector_to_array("probability"), F.lit(1))
    return scored.groupBy("source").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("positivos"), F.round(F.sum(chance), 2).alias("esperados"))


CLUSTERED = ["hora_del_dia", "dia_semana", "trip_distance", "duracion_minutos"]


def _clustered(spark, sf):
    """Clean trips with their cluster and whether its centre is the nearest; the clean rows are stored once."""
    cleaned = trip_ops.clean_trips(trips(spark, sf)).select(*CLUSTERED, "propina_pct")
    rows = stored(cleaned.repartition(parts_of(table(spark, sf, "lineitem").count())), "clean-trips")
    model = models.trip_clusters(CLUSTERED).fit(rows)
    return models.nearest_centre(model.transform(rows), model)


@query("kmeans", f"WITH {CLEAN} SELECT hora_del_dia, dia_semana, trip_distance, round(duracion_minutos, 6) AS duracion_minutos, TRUE AS nearest FROM clean")
def kmeans(spark, sf):
    return round_columns(_clustered(spark, sf).select(*CLUSTERED, "nearest"), ["duracion_minutos"])


PROFILED = {"hora_promedio": "hora_del_dia", "dia_semana_promedio": "dia_semana", "distancia_promedio": "trip_distance",
            "duracion_promedio": "duracion_minutos", "propina_promedio": "propina_pct"}


@query("cluster_profile", f"""WITH {CLEAN} SELECT 4 AS n_clusters, count(*) AS conteo, """
       + ", ".join(f"round(avg({c}), 6) AS {name}" for name, c in PROFILED.items()) + " FROM clean")
def cluster_profile(spark, sf):
    """The clusters' profiles put together again: counts add up, and means weighted by counts are the means of all rows."""
    profile = models.cluster_profile(_clustered(spark, sf))
    weighted = [F.round(F.sum(F.col(name) * F.col("conteo")) / F.sum("conteo"), 6).alias(name) for name in PROFILED]
    return profile.agg(F.count("*").cast("int").alias("n_clusters"), F.sum("conteo").alias("conteo"), *weighted)


PATH = """base AS (
  SELECT vec_id, CAST(label AS DOUBLE) AS y, embedding, vec_id % 7 AS grupo, CAST(vec_id % 365 AS DOUBLE) AS duracion FROM embeddings),
te AS (SELECT grupo, (count(*) * avg(y) + 50 * (SELECT avg(y) FROM base)) / (count(*) + 50) AS te FROM base GROUP BY grupo),
flat AS (
  SELECT vec_id, y, generate_subscripts(embedding, 1) - 1 AS position, CAST(unnest(embedding) AS DOUBLE) AS x FROM base
  UNION ALL SELECT vec_id, y, 64, te FROM base JOIN te USING (grupo)
  UNION ALL SELECT vec_id, y, 66, duracion FROM base),
kept AS (
  SELECT CAST(position AS INTEGER) AS position, avg(x) AS m, stddev_samp(x) AS s FROM flat GROUP BY position
  HAVING var_samp(x) > 0 AND abs(corr(x, y)) >= 0.05)"""


def second_path(spark, sf):
    """The fitted and reloaded selection path over embeddings, two categories and a number, and its rows."""
    key = F.col("vec_id")
    rows = stored(table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("objetivo"), array_to_vector(F.col("embedding").cast("array<double>")).alias("embedding_raw"),
        F.concat(F.lit("g"), key % 7).alias("grupo"), F.lit("unica").alias("constante"), (key % 365).cast("double").alias("duracion")), "path-rows")
    fitted = encode.selection_path("embedding_raw", ["grupo", "constante"], ["duracion"], "objetivo").fit(rows)
    folder = shared_dir(spark, "path")
    fitted.write().save(folder)
    return PipelineModel.load(folder), fitted, rows


@query("selected_positions", f"WITH {PATH} SELECT position FROM kept")
def selected_positions(spark, sf):
    """Positions that vary and go along with the target, from the saved pipeline."""
    loaded, _, _ = second_path(spark, sf)
    return spark.createDataFrame([(p,) for p in encode.kept_positions(loaded)], "position int")


@query("pca", f"""WITH {PATH} SELECT vec_id, (SELECT CAST(count(*) AS INTEGER) FROM kept) AS n, round(sum(((x - m) / s) ** 2), 6) AS norma, 0.0::DOUBLE AS diferencia
FROM flat JOIN kept USING (position) GROUP BY vec_id""")
def pca(spark, sf):
    """Each row's scores keep the squared length of its scaled features, and the saved pipeline gives the same scores."""
    loaded, fitted, rows = second_path(spark, sf)
    once = fitted.transform(rows).select("vec_id", vector_to_array("features_pca").alias("a"))
    again = loaded.transform(rows).select("vec_id", vector_to_array("features_pca").alias("b"))
    norm = F.aggregate("a", F.lit(0.0), lambda s, x: s + x * x)
    off = F.array_max(F.zip_with("a", "b", lambda a, b: F.abs(a - b)))
    return once.join(again, "vec_id").select("vec_id", F.size("a").alias("n"), F.round(norm, 6).alias("norma"), F.round(off, 9).alias("diferencia"))


@query("explained_variance", f"""WITH {PATH}, k AS (SELECT count(*) AS k FROM kept) SELECT CAST(k AS INTEGER) AS componentes, 1.0::DOUBLE AS partes, CAST(k AS DOUBLE) AS varianza,
  TRUE AS ordenadas, 0.0::DOUBLE AS media, 0.0::DOUBLE AS correlacion FROM k""")
def explained_variance(spark, sf):
    """Shares add up to 1 and fall, the scores' variances add up to that of the scaled features, and scores are centred and uncorrelated."""
    loaded, _, rows = second_path(spark, sf)
    shares = models.explained_variance(spark, loaded.stages[-1])
    scores = stored(loaded.transform(rows).select("features_pca"), "scores")
    seen = scores.agg(Summarizer.metrics("mean", "variance").summary(F.col("features_pca")).alias("s")).select("s.*").first()
    matrix = Correlation.corr(scores, "features_pca").first()[0].toArray()
    off = max((abs(matrix[i, j]) for i in range(len(matrix)) for j in range(i)), default=0.0)
    summed = shares.orderBy("component").agg(F.count("*").cast("int").alias("componentes"), F.round(F.sum("share"), 6).alias("partes"),
                                             F.array_agg("share").alias("all"))
    falling = F.forall(F.sequence(F.lit(1), F.size("all") - 1), lambda i: F.get("all", i) <= F.get("all", i - 1) + 1e-12)
    return summed.select("componentes", "partes", F.lit(round(float(sum(seen.variance)), 6)).alias("varianza"),
                         F.when(F.size("all") > 1, falling).otherwise(True).alias("ordenadas"),
                         F.lit(round(max(abs(m) for m in seen["mean"]), 6)).alias("media"), F.lit(round(float(off), 6)).alias("correlacion"))
