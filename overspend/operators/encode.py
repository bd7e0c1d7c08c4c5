"""Encodings of categories, the time-ordered split and scaling."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA, OneHotEncoder, PCAModel, StandardScaler, StandardScalerModel, StringIndexer, TargetEncoder, VarianceThresholdSelector,
    VarianceThresholdSelectorModel, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from overspend import fixed_values as fv
from overspend.operators.lookup import BROADCAST_ROWS, attach_by_key, has_few_rows
from overspend.operators.profile import vector_correlations
from overspend.operators.quantiles import time_quantile
from overspend.session import stored


def temporal_split(df: DataFrame, moment: str, share: float = fv.TRAIN_SHARE,
                   error: float = 0.0) -> tuple[DataFrame, DataFrame, Column]:
    """Rows up to the ``share`` quantile of time, the later rows, and the cut between them.

    The rows per moment are counted once and stored; the exact cut is found in that table, so ``df`` is computed once for it.
    """
    if error:
        cut = time_quantile(df, moment, share, error)
    else:
        counted = stored(df.groupBy(moment).agg(F.count("*").alias("n_rows")), "moments")
        cut = time_quantile(counted, moment, share, weight="n_rows")
    return df.where(F.col(moment) <= cut), df.where(F.col(moment) > cut), cut


def frequency_table(df: DataFrame, key: str, output: str | None = None) -> DataFrame:
    """Share of rows per key, with the row count ``n_rows``. The counts are stored, so ``df`` is computed once; the total is their sum."""
    counted = stored(df.groupBy(key).agg(F.count("*").alias("n_rows")), "frequencies")
    total = counted.agg(F.sum("n_rows")).scalar()
    return counted.withColumn(output or f"{key}_freq", F.col("n_rows") / total)


def frequency_encode(df: DataFrame, key: str, fitted: DataFrame | None = None) -> DataFrame:
    """Attach each row's key share; keys without an entry get null."""
    table = frequency_table(df, key) if fitted is None else fitted
    return attach_by_key(df, table, key, "n_rows").drop("n_rows")


@dataclass
class TargetEncoding:
    """Smoothed mean of the target per key: ``(n * mean + m * overall) / (n + m)``."""

    key: str
    output: str
    table: DataFrame
    overall: float
    few_keys: bool | None = None

    def apply(self, df: DataFrame, fill_unseen: bool = True) -> DataFrame:
        """Attach the encoding; unseen keys get the overall mean."""
        if self.few_keys is None:
            self.few_keys = has_few_rows(self.table)
        joined = attach_by_key(df, self.table, self.key, "n_rows", self.few_keys).drop("n_rows")
        if not fill_unseen:
            return joined
        return joined.withColumn(self.output, F.coalesce(F.col(self.output), F.lit(self.overall)))


def fit_target_encoding(train: DataFrame, key: str, target: str, output: str | None = None,
                        m: float = fv.SMOOTHING) -> TargetEncoding:
    """One pass over two columns for the overall mean and the number of keys; the table itself stays lazy."""
    output = output or f"{key}_te"
    head = train.agg(F.avg(target).alias("overall"), F.approx_count_distinct(key).alias("keys")).first()
    seen, mean = F.count(target), F.avg(target)
    smoothed = (seen * mean + F.lit(m * head.overall)) / (seen + m)
    table = train.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.coalesce(smoothed, F.lit(head.overall)).alias(output))
    return TargetEncoding(key, output, table, head.overall, head["keys"] <= BROADCAST_ROWS)


def target_encode(df: DataFrame, key: str, target: str, m: float = fv.SMOOTHING) -> DataFrame:
    """Encode with statistics of the same rows."""
    return fit_target_encoding(df, key, target, m=m).apply(df, fill_unseen=False)


def index_and_one_hot(columns: Sequence[str]) -> list:
    """Stages that index all columns together and one-hot encode them; unseen labels get an index of their own.

    Spark ML keeps the labels of a column in one array on the driver; for keys that grow with the data use frequency or target encoding.
   """
    indexed = [f"{c}_idx" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep",
                      stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_ohe" for c in columns], dropLast=True),
    ]


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features_raw") -> DataFrame:
    """Columns to one vector; rows with a null among them are dropped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip").transform(df)


def standard_scaler(column: str = "features_raw", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=output, withMean=True, withStd=True)


def scale_split(train: DataFrame, test: DataFrame, column: str = "features_raw", output: str = "features",
                ) -> tuple[DataFrame, DataFrame, StandardScalerModel]:
    """Scale both parts with means and deviations of the training rows."""
    fitted = standard_scaler(column, output).fit(train)
    return fitted.transform(train), fitted.transform(test), fitted


def keep_positions(df: DataFrame, vector: str, positions: Sequence[int], output: str) -> DataFrame:
    """Chosen vector positions; a null vector gives zeros."""
    size = max(positions) + 1
    zeros = F.array_repeat(F.lit(0.0), size)
    values = F.when(F.col(vector).isNotNull(), vector_to_array(F.col(vector))).otherwise(zeros)
    filled = df.withColumn("_filled", array_to_vector(values))
    sliced = VectorSlicer(inputCol="_filled", outputCol=output, indices=list(positions)).transform(filled)
    return sliced.drop("_filled")


class CorrelationSelector(Estimator):
    """Keeps the vector positions whose Pearson r with the target is at least ``threshold`` in size.

    Fitting gives a plain slicer, so a fitted pipeline is saved and loaded like any other. If no position qualifies, the one with the largest
    r in size stays, since a vector needs a position.
    """

    def __init__(self, inputCol: str, outputCol: str, target: str, threshold: float = fv.MIN_CORRELATION) -> None:
        super().__init__()
        self.input, self.output, self.target, self.threshold = inputCol, outputCol, target, threshold

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        found = [(r.position, 0.0 if math.isnan(r.r) else abs(r.r)) for r in vector_correlations(dataset, self.input, self.target).collect()]
        kept = sorted(i for i, r in found if r >= self.threshold) or [max(found, key=lambda f: f[1])[0]]
        return VectorSlicer(inputCol=self.input, outputCol=self.output, indices=kept)


class AllComponents(Estimator):
    """Principal components, as many as the vector has positions; fitting gives Spark's own model."""

    def __init__(self, inputCol: str, outputCol: str) -> None:
        super().__init__()
        self.input, self.output = inputCol, outputCol

    def _fit(self, dataset: DataFrame) -> PCAModel:
        return PCA(k=dataset.select(self.input).first()[0].size, inputCol=self.input, outputCol=self.output).fit(dataset)


def selection_path(vector: str, categories: Sequence[str], numbers: Sequence[str], target: str, threshold: float = fv.MIN_CORRELATION) -> Pipeline:
    """The second way to features, as one pipeline that is fitted and saved as a whole.

    Categories become smoothed target means (an unseen category gets the overall mean); everything is assembled, positions that never
    vary are dropped, the rest is scaled, positions that do not go along with the target are dropped, and what stays is scaled again and rotated
    to principal components. The columns are ``features_raw``, ``features_varying``, ``features_scaled``, ``features_selected``, ``features_scaled_filtered``
    and ``features_pca``.
    """
    indexed, encoded = [f"{c}_idx" for c in categories], [f"{c}_te" for c in categories]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
        TargetEncoder(inputCols=indexed, outputCols=encoded, labelCol=target, targetType="continuous", handleInvalid="keep", smoothing=float(fv.SMOOTHING)),
        VectorAssembler(inputCols=[vector, *encoded, *numbers], outputCol="features_raw", handleInvalid="skip"),
        VarianceThresholdSelector(featuresCol="features_raw", outputCol="features_varying", varianceThreshold=0.0),
        standard_scaler("features_varying", "features_scaled"),
        CorrelationSelector("features_scaled", "features_selected", target, threshold),
        standard_scaler("features_selected", "features_scaled_filtered"),
        AllComponents("features_scaled_filtered", "features_pca"),
    ])


def kept_positions(fitted: PipelineModel) -> list[int]:
    """Positions of ``features_raw`` that a fitted selection path keeps."""
    varying = next(s.selectedFeatures for s in fitted.stages if isinstance(s, VarianceThresholdSelectorModel))
    return [varying[i] for i in next(s.getIndices() for s in fitted.stages if isinstance(s, VectorSlicer))]
