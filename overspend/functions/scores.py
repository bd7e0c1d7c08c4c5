"""Value scales, anomaly score, severity and tip classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from overspend import fixed_values as fv


def scaled(value: Column, scale: str) -> Column:
    """The value on the scale the model works in: ``raw`` or ``log1p``."""
    if scale == "raw":
        return value
    if scale == "log1p":
        return F.log1p(value)
    raise ValueError(f"unknown scale {scale!r}")


def z_score(deviation: Column, sigma: Column) -> Column:
    return F.try_divide(deviation, sigma)


def severity(z: Column) -> Column:
    """Severity name from the z-score; upper limits belong to the milder class."""
    mild, medium, strong = fv.SEVERITY_LIMITS
    normal, name_mild, name_medium, name_strong = fv.SEVERITY_NAMES
    return (
        F.when(z.isNull() | F.isnan(z) | (z <= mild), normal)
        .when(z <= medium, name_mild)
        .when(z <= strong, name_medium)
        .otherwise(name_strong)
    )


def flag(deviation: Column, limit: Column) -> Column:
    """One-sided, strict: only values above prediction plus limit are flagged."""
    return F.when(deviation > limit, fv.FLAGGED).otherwise(fv.NOT_FLAGGED)


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def tip_category(tip: Column, total: Column) -> Column:
    """Tip class by percentage of the total."""
    pct = share_pct(F.coalesce(tip, F.lit(0.0)), total)
    return (
        F.when(total.isNull() | (total == 0), "N/A")
        .when(pct > 25, "Alta")
        .when(pct > 15, "Media")
        .when(pct > 0, "Baja")
        .otherwise("Ninguna")
    )


@F.udf(T.StringType())
def tip_category_udf(tip, total):
    """Row-at-a-time form of ``tip_category``, kept only as the user-function example."""
    if not total:
        return "N/A"
    pct = (tip or 0.0) / total * 100
    return next((name for limit, name in ((25, "Alta"), (15, "Media"), (0, "Baja")) if pct > limit), "Ninguna")


def trip_kind(distance: Column) -> Column:
    """Four distance classes."""
    return (
        F.when(distance > 20, "Largo (Aero)")
        .when(distance > 10, "Largo (No Aero)")
        .when(distance > 5, "Medio")
        .otherwise("Corto")
    )
