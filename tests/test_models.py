"""Models on small tables: properties rather than fitted numbers."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from overspend.operators import encode, feature_tables, models, profile, trees
from overspend.operators.feature_tables import FeatureTables
from overspend.plans import fitted
from overspend.session import shared_dir

SMALL = {"vectorSize": 8, "maxIter": 1}


@pytest.fixture(scope="module")
def contracts(spark):
    rng = random.Random(11)
    kinds = {"obra": 12.0, "consultoria": 10.0, "suministro papeleria": 8.0}
    data = []
    for i in range(240):
        kind = rng.choice(list(kinds))
        data.append((str(i), f"Contrato de {kind} municipal número {i % 7}", f"ent{i % 5}", f"c{i % 4}",
                     float(np.exp(kinds[kind] + rng.gauss(0, 0.1))), None if i % 3 else i % 90, i, kind, "E", f"M{i % 2}"))
    return spark.createDataFrame(data, (
        "id_contrato string, objeto_contrato string, entidad string, codigo_unspsc string, valor_contrato double, "
        "duracion_dias int, dia int, tipo_contrato string, estado_contrato string, modalidad string")).withColumn(
        "fecha_firma", F.date_add(F.lit("2024-01-01").cast("date"), F.col("dia")))


def test_scaler_is_fitted_on_training_rows(spark):
    rows = encode.assemble(spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), "id"), ["a", "b"])
    train, test, fitted = encode.scale_split(rows.where("id < 80"), rows.where("id >= 80"))
    a = np.array([r.features.toArray() for r in train.collect()])
    assert a.mean(axis=0) == pytest.approx([0, 0], abs=1e-12) and a.std(axis=0, ddof=1) == pytest.approx([1, 1])
    assert all(r.features[0] > 1.5 for r in test.collect())


def test_assemble_drops_rows_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert encode.assemble(df, ["a", "b"]).count() == 1


def test_keep_positions_of_null_vectors(spark):
    df = spark.createDataFrame([(0, Vectors.dense(1.0, 2.0, 3.0)), (1, None), (2, Vectors.sparse(3, {2: 9.0}))],
                               ["i", "v"])
    got = {r.i: list(r.k.toArray()) for r in encode.keep_positions(df, "v", [0, 2], "k").collect()}
    assert got == {0: [1.0, 3.0], 1: [0.0, 0.0], 2: [0.0, 9.0]}


def test_one_hot_of_unseen_labels(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("x",), ("x",), ("y",)], "c string")
    fitted = Pipeline(stages=encode.index_and_one_hot(["c"])).fit(train)
    got = {r.c: (r.c_idx, list(r.c_ohe.toArray())) for r in fitted.transform(
        spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")).collect()}
    assert got == {"x": (0.0, [1.0, 0.0]), "y": (1.0, [0.0, 1.0]), "z": (2.0, [0.0, 0.0]), None: (2.0, [0.0, 0.0])}


def test_regression_metrics_equal_the_evaluator(spark):
    rng = np.random.default_rng(1)
    scored = spark.createDataFrame([(float(a), float(a + e)) for a, e in zip(rng.normal(size=50), rng.normal(size=50) / 3)],
                                   "label double, prediction double")
    got = models.regression_metrics(scored).first().asDict()
    for name in ("r2", "rmse", "mae"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(scored))
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert models.regression_metrics(constant).first().r2 is None


def test_binary_metrics_of_a_perfect_score(spark):
    scored = spark.createDataFrame([(0.1, 0.0), (0.2, 0.0), (0.8, 1.0)], "score double, label double")
    assert tuple(models.binary_metrics(scored, "score").first()) == (1.0, 1.0)


@pytest.mark.parametrize("new,old,verdict", [
    ([(1.0, 1.0), (2.0, 2.1)], [(1.0, 2.0), (2.0, 1.0)], "PROMOTED"),
    ([(1.0, 2.0), (2.0, 1.0)], [(1.0, 1.0), (2.0, 2.1)], "NOT_PROMOTED"),
    ([(1.0, 1.5), (2.0, 2.0)], [(1.0, 1.5), (2.0, 2.0)], "NOT_PROMOTED"),
    ([(1.0, 2.0), (2.0, 1.0)], None, "PROMOTED_FIRST"),
])
def test_champion_and_challenger(spark, new, old, verdict):
    kind = "label double, prediction double"
    frames = [None if data is None else spark.createDataFrame(data, kind) for data in (new, old)]
    assert models.compare_models(*frames).first().verdict == verdict


def test_components_explain_less_and_less(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([(Vectors.dense(r),) for r in data], ["v"])
    fitted = models.pca(4, "v").fit(df)
    shares = models.explained_variance(spark, fitted).orderBy("component").collect()
    assert [r.share for r in shares] == sorted((r.share for r in shares), reverse=True)
    assert shares[-1].cumulative == pytest.approx(1.0)
    needed = [r for r in shares if r.needed]
    assert needed[-1].cumulative >= 0.95 and (len(needed) == 1 or needed[-2].cumulative < 0.95)


def test_classifier_accepts_an_unseen_category(spark):
    rows = spark.createDataFrame([(0, "Ventas", 30, 1), (1, "IT", 45, 1), (2, "Ventas", 22, 0), (3, "Mktg", 38, 0),
                                  (4, "IT", 51, 1), (5, "Mktg", 29, 1), (6, "Ventas", 40, 0), (7, "IT", 33, 1)],
                                 "id int, departamento string, edad int, label int")
    fitted = models.buyer_classifier("departamento", "edad").fit(rows)
    assert models.binary_metrics(fitted.transform(rows)).first().area_under_roc > 0.5
    fresh = spark.createDataFrame([(10, "IT", 33), (11, "Datos", 48)], "id int, departamento string, edad int")
    assert {r.id: r.prediction for r in fitted.transform(fresh).collect()}.keys() == {10, 11}


def test_clusters_cover_every_row(spark):
    df = spark.range(60).select(*[((F.col("id") * k) % 24).cast("double").alias(c) for k, c in (
        (1, "hora_del_dia"), (5, "dia_semana"), (7, "trip_distance"), (11, "duracion_minutos"))], F.lit(1.0).alias("propina_pct"))
    clustered = models.trip_clusters(df.columns[:4]).fit(df).transform(df)
    report = models.cluster_profile(clustered).collect()
    assert len(report) == 4 and sum(r.conteo for r in report) == 60


def test_sample_does_not_depend_on_the_partitioning(spark):
    df = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, "x").alias("k"))
    first, second = ({r.id for r in profile.sample_by_key(d, ["id", "k"], 0.1).collect()} for d in (df.coalesce(1), df.repartition(7, "k")))
    assert first == second and 800 < len(first) < 1200
    assert first != {r.id for r in profile.sample_by_key(df, ["id", "k"], 0.1, seed=7).collect()}
    whole = profile.sample_by_key(spark.createDataFrame([("a", i) for i in range(9)], "k string, i int"), ["k"], 0.5)
    assert whole.count() in (0, 9)


def test_word_vector_parts_are_a_parameter():
    """They do not follow the cores of the session."""
    assert models.word2vec().getNumPartitions() == models.WORD_PARTS and models.word2vec(numPartitions=3).getNumPartitions() == 3


def test_word_vector_parts_follow_the_words(spark, contracts, monkeypatch):
    """More words give more parts, so that more cores can share them; a number that is named holds."""
    tokens = spark.range(100).select(F.array_repeat(F.lit("obra"), 9_000).alias("palabras_filtradas"))
    assert feature_tables.word_parts(tokens) == 9 and feature_tables.word_parts(tokens.limit(0)) == models.WORD_PARTS
    monkeypatch.setattr(feature_tables, "WORDS_PER_PART", 10)

    def parts(**named):
        tables = models.FeatureTables.build(contracts, shared_dir(spark, "parts"), w2v=SMALL | named)
        return next(stage.getNumPartitions() for stage in tables.stages.stages if stage.hasParam("numPartitions"))

    assert parts() > models.WORD_PARTS and parts(numPartitions=3) == 3


def test_feature_tables_store_wide_rows_once(spark, contracts, monkeypatch):
    """Only the rows with their tokens are stored on the way; the scaler reads the features without a table of them."""
    removed, real = [], feature_tables.remove_path
    monkeypatch.setattr(feature_tables, "remove_path", lambda session, path: (removed.append(path.rsplit("/", 1)[1]), real(session, path)))
    tables = models.FeatureTables.build(contracts.coalesce(1), shared_dir(spark, "once"), w2v=SMALL, parts=4)
    assert removed == ["rows"] and tables.train.count() + tables.test.count() == contracts.count()
    seen = tables.train.agg(Summarizer.mean(F.col("features")).alias("m"), Summarizer.std(F.col("features")).alias("s")).first()
    assert max(abs(m) for m in seen.m) < 1e-6 and all(abs(d - 1) < 1e-6 or d == 0 for d in seen.s)


def test_price_model_round_trip(spark, contracts):
    """Fitted on earlier rows, saved and loaded: the same scores; a huge new value is flagged."""
    train, test, _ = encode.temporal_split(contracts, "fecha_firma")
    model = models.PriceModel.fit(train, models.forest(numTrees=5, maxDepth=4), w2v=SMALL)
    folder = shared_dir(spark, "model")
    model.save(folder)
    loaded = models.PriceModel.load(spark, folder)

    def scores(m, rows):
        return {r.id_contrato: r.prediction for r in m.predict(rows).collect()}

    assert scores(model, test) == scores(loaded, test) and len(scores(loaded, test)) == test.count()
    odd = test.limit(1).withColumns({"valor_contrato": F.lit(1e15), "entidad": F.lit("nueva"), "codigo_unspsc": F.lit("nuevo"),
                                     "tipo_contrato": F.lit("otro"), "duracion_dias": F.lit(None).cast("int")})
    judged = loaded.detect(odd).first()
    assert (judged.anomaly_flag, judged.severity, judged.model_version) == ("ATIPICO", "SEVERO", "rf_log_v1")
    assert loaded.detect(odd.withColumn("objeto_contrato", F.lit("corto"))).count() == 0
    gold = loaded.detect(test)
    assert gold.columns == ["valor_contrato", "valor_log", "valor_predicho_log", "desviacion_log", "z_score", "sigma_threshold",
                            "anomaly_flag", "severity", "detection_timestamp", "model_version"]
    assert gold.where(F.abs(F.col("desviacion_log") - (F.col("valor_log") - F.col("valor_predicho_log"))) > 1e-12).count() == 0


def test_text_stages_equal_the_column_functions(spark, contracts):
    from pyspark.ml import PipelineModel
    from overspend.functions import text as txt

    staged = PipelineModel(models.text_stages()).transform(contracts)
    direct = txt.with_tokens(txt.with_clean_text(contracts, "objeto_contrato"))
    columns = ["id_contrato", "objeto_limpio", "palabras_filtradas"]
    assert sorted(staged.select(columns).collect()) == sorted(direct.select(columns).collect())


def test_vector_to_array_of_an_assembled_target(spark):
    df = spark.createDataFrame([(Vectors.dense(1.0, 2.0), 5.0)], ["v", "y"])
    joined = encode.assemble(df, ["v", "y"], "vy")
    assert joined.select(vector_to_array("vy")).first()[0] == [1.0, 2.0, 5.0]


def vectors(spark, data, schema=("v", "y")):
    return spark.createDataFrame([(Vectors.dense(x), float(y)) for x, y in data], list(schema))


def test_forest_expression_equals_the_model(spark):
    """All predictions to the last bit; trees of different depth, a forest of single leaves, a row without a vector."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3))
    train = vectors(spark, zip(x, np.where(x[:, 0] > 0, x[:, 1] ** 2, -x[:, 2])))
    for params in ({"numTrees": 7, "maxDepth": 6}, {"numTrees": 3, "maxDepth": 0}):
        model = models.forest("v", "y", **params).fit(train)
        nodes = trees.node_table(spark, model)
        scored = model.transform(train).withColumn("own", trees.forest_expression(nodes, "v"))
        assert scored.where("own <> prediction or own is null").count() == 0
        assert {r.tree for r in nodes.select("tree").distinct().collect()} == set(range(params["numTrees"]))
        assert nodes.where("feature is null").count() == nodes.where("feature is not null").count() + params["numTrees"]
    none = spark.createDataFrame([(None, 1.0)], train.schema)
    assert none.select(trees.forest_expression(nodes, "v")).first()[0] is None


def test_forest_expression_walks_whole_batches(spark):
    """No step of a walk is run row by row; missing vectors, NaN, infinities and values at a threshold give what the model gives, over several batches."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, size=(400, 2)).astype(float)
    model = models.forest("v", "y", numTrees=5, maxDepth=5).fit(vectors(spark, zip(x, x[:, 0] * x[:, 1])))
    nodes = trees.node_table(spark, model)
    at = [r.threshold for r in nodes.where("threshold is not null").select("threshold").distinct().collect()]
    odd = [float("nan"), float("inf"), float("-inf"), -0.0, *at]
    later = vectors(spark, [((odd[i % len(odd)], odd[i % 7 % len(odd)]), i) for i in range(25_000)]).repartition(2)
    scored = model.transform(later).withColumn("own", trees.forest_expression(nodes, "v"))
    assert "lambda" not in scored._jdf.queryExecution().toString()
    assert scored.count() == 25_000 and scored.where("own <> prediction or own is null").count() == 0
    mixed = later.withColumn("v", F.expr("if(y % 3 = 0, null, v)")).withColumn("own", trees.forest_expression(nodes, "v"))
    assert mixed.where("(v is null) <> (own is null)").count() == 0
    known = model.transform(mixed.where("v is not null"))
    assert known.count() > 16_000 and known.where("own <> prediction").count() == 0


def test_price_rows_of_a_part_are_in_order(spark, tmp_path):
    """Every line with an order is in one part once, and like rows of a part stand together; long tables have longer parts."""
    rng = np.random.default_rng(6)
    lines = [(i % 500, i, float(rng.integers(1, 50)), 0.01 * int(rng.integers(0, 11)), 0.01 * int(rng.integers(0, 9)), int(rng.integers(1, 900)),
              100.0 + i) for i in range(30_000)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_partkey long, "
                                 "l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(490).select(F.col("id").alias("o_orderkey"), F.timestamp_seconds(F.col("id") * 86400).alias("o_orderdate")).write.parquet(
        f"{tmp_path}/orders.parquet")
    train, test = fitted.price_tables(spark, str(tmp_path))
    assert sorted(r.l_linenumber for r in train.union(test).collect()) == [i for i in range(30_000) if i % 500 < 490]
    for rows in (train, test):
        parts = {}
        for r in rows.withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect():
            parts.setdefault(r.file, []).append(tuple(r[c] for c in fitted.PRICE_FEATURES))
        assert len(parts) == 2 and all(p == sorted(p) for p in parts.values())
    assert [fitted.price_parts(n) for n in (0, 1, 600_000, 6_000_000, 216_000_000)] == [1, 1, 24, 60, 2160]


def test_split_by_category_is_refused(spark):
    from pyspark.ml.feature import VectorIndexer

    train = vectors(spark, [([float(i % 3)], 10.0 * (i % 3 == 1)) for i in range(60)], ("raw", "y"))
    indexed = VectorIndexer(inputCol="raw", outputCol="v", maxCategories=4).fit(train).transform(train)
    model = models.forest("v", "y", numTrees=2).fit(indexed)
    with pytest.raises(Exception, match="split by category"):
        trees.node_table(spark, model).collect()


def test_feature_tables_keep_tokens_vectors_and_attributes(spark, contracts):
    """After a reload: every row once, the cut between both parts, attributes of the positions, training means of 0, the same scores."""
    folder = shared_dir(spark, "features")
    built = FeatureTables.build(contracts, folder, w2v=SMALL, parts=3)
    loaded = FeatureTables.load(spark, folder)
    assert loaded.train.count() + loaded.test.count() == contracts.count()
    assert loaded.train.agg(F.max("fecha_firma")).first()[0] < loaded.test.agg(F.min("fecha_firma")).first()[0]
    attributes = loaded.train.schema["features_raw"].metadata["ml_attr"]
    assert attributes["num_attrs"] == len(loaded.train.first().features_raw) == len(loaded.test.first().features)
    names = [a["name"] for kind in attributes["attrs"].values() for a in kind]
    assert "entidad_freq" in names and any(n.startswith("modalidad_ohe_M") for n in names)
    matrix = np.array([r.features.toArray() for r in loaded.train.select("features").collect()])
    assert np.abs(matrix.mean(axis=0)).max() < 1e-9
    assert all(isinstance(t, str) for t in loaded.train.first().palabras_filtradas)

    small = models.forest(numTrees=4, maxDepth=3)
    first, again = models.PriceModel.fit_tables(built, small), models.PriceModel.fit_tables(loaded, small)
    raw = {r.id_contrato: r.prediction for r in first.predict(contracts).collect()}
    stored = {r.id_contrato: r.prediction for r in again.predict_stored(loaded.test).collect()}
    assert stored.keys() <= raw.keys() and all(raw[k] == pytest.approx(v, abs=1e-9) for k, v in stored.items())


def test_feature_tables_compute_the_source_once(spark, contracts):
    counted = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    rows = contracts.mapInArrow(touch, contracts.schema)
    FeatureTables.build(rows, shared_dir(spark, "features"), w2v=SMALL)
    assert counted.value == contracts.count()


def test_split_and_frequencies_compute_the_source_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    rows = spark.range(500).selectExpr("id", "date_add(DATE'2024-01-01', int(id % 50)) AS d").mapInArrow(touch, "id long, d date")
    _, _, cut = encode.temporal_split(rows, "d")
    assert counted.value == 500 and str(spark.range(1).select(cut).first()[0]) == "2024-02-09"
    encode.frequency_table(rows, "d").collect()
    assert counted.value == 1000


def test_selection_path_drops_constant_and_unrelated_positions(spark):
    rng = np.random.default_rng(6)
    y = rng.normal(size=900)
    noise = rng.normal(size=900)
    data = [(Vectors.dense([t + 0.1 * n, 7.0, n]), f"g{i % 3}", "same", float(t), float(-t)) for i, (t, n) in enumerate(zip(y, noise))]
    rows = spark.createDataFrame(data, ["v", "g", "c", "y", "minus"])
    fitted = encode.selection_path("v", ["g", "c"], ["minus"], "y", threshold=0.2).fit(rows)
    folder = shared_dir(spark, "path")
    fitted.write().save(folder)
    from pyspark.ml import PipelineModel
    loaded = PipelineModel.load(folder)
    assert encode.kept_positions(fitted) == encode.kept_positions(loaded) == [0, 5]
    unseen = rows.limit(3).withColumn("g", F.lit("new"))
    assert all(len(r.features_pca) == 2 for r in loaded.transform(unseen).collect())
    # Nothing goes along with the target: the strongest position stays.
    assert len(encode.kept_positions(encode.selection_path("v", ["g", "c"], ["minus"], "y", threshold=2.0).fit(rows))) == 1


def test_optimality_tells_fitted_from_unfitted(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 4)) * [1, 10, 0.1, 3] + [0, 5, 2, 0]
    train = vectors(spark, zip(x, x @ [2.0, 0.3, 0.0, -1.0] + rng.normal(size=400)), ("features", "label"))
    for params in ({}, {"regParam": 0.0}, {"regParam": 0.5, "elasticNetParam": 0.0}, {"regParam": 0.4, "elasticNetParam": 1.0}):
        row = models.optimality(train, models.linear(**({"solver": "l-bfgs"} | params)).fit(train)).first()
        assert row.n == 400 and row.residual < 1e-6
        assert models.optimality(train, models.linear(**params).fit(train)).first().residual < 1e-3
    rough = models.linear(maxIter=1, regParam=0.4, elasticNetParam=1.0).fit(train)
    assert models.optimality(train, rough).first().residual > 1e-3


def test_nearest_centre_sees_a_wrong_cluster(spark):
    df = spark.range(80).select(*[((F.col("id") * k) % 24).cast("double").alias(c) for k, c in ((1, "a"), (5, "b"))])
    model = models.trip_clusters(["a", "b"]).fit(df)
    clustered = model.transform(df)
    assert models.nearest_centre(clustered, model).where("not nearest").count() == 0
    assert models.nearest_centre(clustered.withColumn("cluster_id", (F.col("cluster_id") + 1) % 4), model).where("nearest").count() == 0
