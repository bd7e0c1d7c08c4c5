"""Feature stages, models, metrics and the saved price model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, PCAModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from overspend import fixed_values as fv
from overspend.operators.anomaly import gold_table, residual_sigma, score_anomalies
from overspend.operators.encode import TargetEncoding, standard_scaler
from overspend.operators.feature_tables import WORD_PARTS, FeatureTables, encode_rows, text_stages, word2vec  # noqa: F401  (part of this module's interface)
from overspend.session import shared_dir


def forest(features: str = "features", label: str = "label", **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol=features, labelCol=label, **(fv.FOREST | params))


def linear(features: str = "features", label: str = "label", **params) -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, **(fv.LINEAR | params))


def buyer_classifier(category: str, number: str, label: str = "label", **params) -> Pipeline:
    """Index, one-hot, assemble and classify."""
    return Pipeline(stages=[
        StringIndexer(inputCol=category, outputCol=f"{category}_idx", handleInvalid="keep"),
        OneHotEncoder(inputCol=f"{category}_idx", outputCol=f"{category}_vec"),
        VectorAssembler(inputCols=[f"{category}_vec", number], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, **(fv.LOGISTIC | params)),
    ])


def trip_clusters(features: Sequence[str]) -> Pipeline:
    """Assemble, scale and cluster."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features_unscaled"),
        standard_scaler("features_unscaled", "features"),
        KMeans(featuresCol="features", predictionCol="cluster_id", **fv.KMEANS),
    ])


def cluster_profile(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster_id").agg(
        F.count("*").alias("conteo"),
        F.avg("hora_del_dia").alias("hora_promedio"),
        F.avg("dia_semana").alias("dia_semana_promedio"),
        F.avg("trip_distance").alias("distancia_promedio"),
        F.avg("duracion_minutos").alias("duracion_promedio"),
        F.avg("propina_pct").alias("propina_promedio"),
    ).orderBy("cluster_id")


def nearest_centre(clustered: DataFrame, model: PipelineModel, features: str = "features") -> DataFrame:
    """Adds ``nearest``: whether no other centre of the fitted clusters is nearer than the row's own."""
    centres = [F.array(*[F.lit(float(c)) for c in centre]) for centre in model.stages[-1].clusterCenters()]
    squares = F.transform(F.array(*centres), lambda centre: F.aggregate(
        F.zip_with(vector_to_array(features), centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d))
    return clustered.withColumn("nearest", F.get(squares, F.col("cluster_id")) <= F.array_min(squares) * (1 + 1e-9) + 1e-12)


def optimality(train: DataFrame, model: LinearRegressionModel, features: str = "features", label: str = "label") -> DataFrame:
    """How far a fitted linear model is from the optimum of its own objective: (n, residual), 0 at the optimum.

    With features and label scaled to unit deviation, as the fit scales them, the correlation-like gradient of each feature must equal the ridge part plus the
    sign of its coefficient times the lasso part, or stay within the lasso part where the coefficient is 0; the mean residual must be 0.
    One pass for the moments and one for the gradient. The solver by normal equations scales by deviations of the population, so it departs
    by a share of about 1 / n.
    """
    lasso = model.getRegParam() * model.getElasticNetParam()
    ridge = model.getRegParam() * (1 - model.getElasticNetParam())
    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    beta, size = [float(b) for b in model.coefficients], model.numFeatures
    at = [F.get("x", F.lit(j)) for j in range(size)]
    seen = rows.agg(F.count("y").alias("n"), F.stddev_samp("y").alias("y"), F.array(*[F.avg(x) for x in at]).alias("means"),
                    F.array(*[F.stddev_samp(x) for x in at]).alias("x")).first()
    error = F.col("y") - F.lit(float(model.intercept)) - sum((x * F.lit(b) for x, b in zip(at, beta)), F.lit(0.0))
    gradients = [F.avg(error * (x - F.lit(m))) / F.lit(d) if d else F.lit(0.0) for x, m, d in zip(at, seen.means, seen.x)]
    off = [F.abs(g - F.lit(lasso * (1 if b > 0 else -1) + ridge * b * (d or 0) / (seen.y or 1))) if b else F.greatest(F.abs(g) - F.lit(lasso), F.lit(0.0))
           for g, b, d in zip(gradients, beta, seen.x)]
    worst = F.array_max(F.array(F.abs(F.avg(error)), *off))
    return rows.select("x", "y", error.alias("e")).agg(F.count("*").alias("n"), (worst / F.lit(seen.y or 1.0)).alias("residual"))


def pca(k: int, column: str, output: str = "features_pca") -> PCA:
    return PCA(k=k, inputCol=column, outputCol=output)


def explained_variance(spark: SparkSession, model: PCAModel, wanted: float = fv.VARIANCE_TARGET) -> DataFrame:
    """Share and running share per component, and whether it is needed to reach ``wanted``."""
    shares = model.explainedVariance.toArray()
    running = np.cumsum(shares)
    needed = int(np.searchsorted(running, wanted)) + 1
    rows = [(i + 1, float(s), float(c), i < needed) for i, (s, c) in enumerate(zip(shares, running))]
    return spark.createDataFrame(rows, "component int, share double, cumulative double, needed boolean")


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """r2, rmse and mae in one aggregate."""
    error = F.col(label) - F.col(prediction)
    squares = F.sum(error * error)
    return scored.agg(
        (1 - F.try_divide(squares, F.var_pop(label) * F.count(label))).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def binary_metrics(scored: DataFrame, score: str = "rawPrediction", label: str = "label") -> DataFrame:
    """Areas under the ROC and the precision-recall curve."""
    def area(metric: str) -> float:
        return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName=metric).evaluate(scored)

    return scored.sparkSession.createDataFrame(
        [(area("areaUnderROC"), area("areaUnderPR"))], "area_under_roc double, area_under_pr double")


def compare_models(challenger: DataFrame, champion: DataFrame | None) -> DataFrame:
    """Metrics of both scored tables and the verdict: promote only when r2 rises and rmse falls."""
    new = regression_metrics(challenger).first()
    old = regression_metrics(champion).first() if champion is not None else None
    if old is None:
        verdict = "PROMOTED_FIRST"
    else:
        verdict = "PROMOTED" if new.r2 > old.r2 and new.rmse < old.rmse else "NOT_PROMOTED"
    row = (new.r2, new.rmse, old and old.r2, old and old.rmse, verdict)
    return challenger.sparkSession.createDataFrame(
        [row], "new_r2 double, new_rmse double, old_r2 double, old_rmse double, verdict string")


@dataclass
class PriceModel:
    """Text, categories and duration to a value: all fitted parts as one unit that can be saved."""

    stages: PipelineModel
    frequency: DataFrame
    encoding: TargetEncoding
    sigma: float
    version: str = "rf_log_v1"

    @classmethod
    def fit(cls, train: DataFrame, regressor=None, version: str = "rf_log_v1", w2v: dict | None = None) -> PriceModel:
        """Fit every part on training rows only."""
        folder = shared_dir(train.sparkSession, "training")
        return cls.fit_tables(FeatureTables.build(train, folder, moment=None, w2v=w2v), regressor, version)

    @classmethod
    def fit_tables(cls, tables: FeatureTables, regressor=None, version: str = "rf_log_v1") -> PriceModel:
        """Fit the regressor to stored features; nothing before them is computed again."""
        matrix = tables.train.select("features", "label")
        fitted = (regressor or forest()).fit(matrix)
        sigma = residual_sigma(fitted.transform(matrix)).first().sigma
        return cls(PipelineModel([*tables.stages.stages, fitted]), tables.frequency, tables.encoding, sigma, version)

    def predict(self, rows: DataFrame) -> DataFrame:
        """Rows whose text is usable, with ``prediction`` on the log scale."""
        return self.stages.transform(encode_rows(rows, self.frequency, self.encoding))

    def predict_stored(self, features: DataFrame) -> DataFrame:
        """Rows of a stored feature table with ``prediction``; only the regressor runs."""
        return self.stages.stages[-1].transform(features)

    def detect(self, rows: DataFrame) -> DataFrame:
        """The anomaly table of new rows."""
        return gold_table(self.judge(self.predict(rows)), "valor_contrato", self.version)

    def judge(self, predicted: DataFrame) -> DataFrame:
        """Predicted rows with deviation, z-score, flag and severity."""
        return score_anomalies(predicted.withColumn("label", F.log1p("valor_contrato")), self.sigma)

    def save(self, path: str) -> None:
        """Write stages, both encoding tables and the numbers under one folder."""
        spark = self.frequency.sparkSession
        self.stages.write().overwrite().save(f"{path}/stages")
        self.frequency.write.mode("overwrite").parquet(f"{path}/frequency")
        self.encoding.table.write.mode("overwrite").parquet(f"{path}/encoding")
        spark.createDataFrame(
            [(self.sigma, self.encoding.overall, self.version)], "sigma double, overall double, version string",
        ).write.mode("overwrite").parquet(f"{path}/numbers")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PriceModel:
        numbers = spark.read.parquet(f"{path}/numbers").first()
        encoding = TargetEncoding("codigo_unspsc", "codigo_unspsc_te_log",
                                  spark.read.parquet(f"{path}/encoding"), numbers.overall)
        return cls(PipelineModel.load(f"{path}/stages"), spark.read.parquet(f"{path}/frequency"), encoding,
                   numbers.sigma, numbers.version)
