"""The overpricing rule: flag what exceeds its prediction by 2.8 residual deviations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from overspend import fixed_values as fv
from overspend.functions.fields import valid_amount
from overspend.functions.scores import flag, scaled, severity, z_score
from overspend.operators.encode import fit_target_encoding, temporal_split


def residual_sigma(train_scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Sample deviation of training residuals and the limit that follows from it."""
    sigma = F.stddev_samp(F.col(label) - F.col(prediction))
    return train_scored.agg(sigma.alias("sigma"), (sigma * fv.SIGMA_MULTIPLIER).alias("threshold"))


def score_anomalies(scored: DataFrame, sigma: float, label: str = "label", prediction: str = "prediction",
                    multiplier: float = fv.SIGMA_MULTIPLIER) -> DataFrame:
    """Add deviation, limit, z-score, flag and severity."""
    measured = scored.withColumn("desviacion", F.col(label) - F.col(prediction)).withColumn(
        "sigma_threshold", F.lit(multiplier * sigma))
    return measured.withColumns({
        "z_score": z_score(F.col("desviacion"), F.lit(sigma)),
        "anomaly_flag": flag(F.col("desviacion"), F.col("sigma_threshold")),
    }).withColumn("severity", severity(F.col("z_score")))


def group_mean_scores(df: DataFrame, value: str, group: str, moment: str, scale: str = "raw",
                      m: float = fv.SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """Split by time and predict each value from its group's smoothed training mean: (train, test)."""
    valid = df.where(valid_amount(F.col(value))).withColumn("label", scaled(F.col(value), scale))
    train, test, _ = temporal_split(valid, moment)
    encoding = fit_target_encoding(train, group, "label", output="prediction", m=m)
    return encoding.apply(train), encoding.apply(test)


def detect_by_group(df: DataFrame, value: str, group: str, moment: str, scale: str = "raw") -> DataFrame:
    """Later rows judged by group means and residual deviation of earlier rows."""
    train, test = group_mean_scores(df, value, group, moment, scale)
    return score_anomalies(test, residual_sigma(train).first().sigma)


def stamp(df: DataFrame, model_version: str) -> DataFrame:
    return df.withColumns({"detection_timestamp": F.current_timestamp(), "model_version": F.lit(model_version)})


def gold_table(scored: DataFrame, value: str, model_version: str, keep: Sequence[str] = ()) -> DataFrame:
    """The ten columns of the anomaly table, after those named in ``keep``."""
    return stamp(scored, model_version).select(
        *keep,
        F.col(value).alias("valor_contrato"),
        F.col("label").alias("valor_log"),
        F.col("prediction").alias("valor_predicho_log"),
        F.col("desviacion").alias("desviacion_log"),
        "z_score", "sigma_threshold", "anomaly_flag", "severity", "detection_timestamp", "model_version",
    )


def flag_counts(scored: DataFrame) -> DataFrame:
    """Rows and share per flag; the shares refer to the same rows (at most two counts meet in the window)."""
    counted = scored.groupBy("anomaly_flag").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("pct", F.col("n") * 100.0 / total)


def anomalies_only(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("anomaly_flag") == fv.FLAGGED)


def severity_distribution(scored: DataFrame) -> DataFrame:
    return (anomalies_only(scored).groupBy("severity").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "severity"))


def top_anomalies(scored: DataFrame, tie_break: str, k: int = 10) -> DataFrame:
    """The ``k`` highest z-scores among flagged rows."""
    return anomalies_only(scored).orderBy(F.desc("z_score"), tie_break).limit(k)


def high_severity(scored: DataFrame) -> DataFrame:
    return anomalies_only(scored).where(F.col("severity").isin(fv.SEVERITY_NAMES[2:]))
