"""Exact quantiles whose driver footprint does not grow with the data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Accuracy of the sketches (a share of 1 / ACCURACY of the rows), and rows that are read off one by one.
ACCURACY = 10_000
FINISH_ROWS = 10_000
#: Counted values weigh differently, so their cuts are spread evenly.
EVEN_CUTS = 15
#: Whole numbers below this size are exact as doubles.
EXACT = 1 << 53

def approximate_quantiles(df: DataFrame, column: str, probabilities: Sequence[float],
                          error: float = 0.01) -> list[float]:
    """Spark's own sketch; use it when a rank error is acceptable."""
    return df.approxQuantile(column, list(probabilities), error)


@dataclass
class _Range:
    """Where a wanted rank lies: values from ``lo`` to ``hi``, both of them in the data, the rank among them, their rows and weight."""

    lo: float | int
    hi: float | int
    rank: int
    rows: int
    n: int


def exact_quantiles(df: DataFrame, value: str | Column, probabilities: Sequence[float], weight: str | None = None,
                    finish_rows: int = FINISH_ROWS) -> list[float | int]:
    """The ``ceil(p * n)``-th smallest value for each ``p``; nulls and NaN are left out.

    ``weight`` names a column of row counts for values that were counted before. ``approxQuantile`` with error 0 keeps every
    row in one sketch, and a global sort window puts every row in one task. Here a sketch of bounded size proposes two cuts around each rank, one pass
    counts the rows below, at and between the cuts, and the rank is either at a cut, and so found, or in an open interval of a small share of the
    rows. Intervals of more than ``finish_rows`` rows are cut again; smaller ones are read off. So the passes follow the logarithm of the number of
    rows, however the values are spread or repeated, and at most ``finish_rows`` rows per quantile reach the driver.
    """
    column = F.col(value) if isinstance(value, str) else value
    values = df.select(column.alias("v"), (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("w"))
    double = isinstance(values.schema["v"].dataType, (T.DoubleType, T.FloatType))
    values = values.where(F.col("v").isNotNull() & (~F.isnan("v") if double else F.lit(True)))
    infinite = (F.abs("v") == math.inf) if double else F.lit(False)
    finite = F.when(~infinite, F.col("v"))
    shares = _shares(probabilities, weight is not None)
    head = values.agg(
        F.sum("w").alias("n"), F.count(finite).alias("rows"), F.min(finite).alias("lo"), F.max(finite).alias("hi"),
        F.coalesce(F.sum(F.when(infinite & (F.col("v") < 0), F.col("w"))), F.lit(0)).alias("low_end"),
        F.coalesce(F.sum(F.when(infinite & (F.col("v") > 0), F.col("w"))), F.lit(0)).alias("high_end"),
        F.percentile_approx(finite.cast("double"), shares or [0.5], ACCURACY).alias("cuts"),
    ).first()
    if not head.n:
        return []

    found: dict[int, float | int] = {}
    ranges: dict[int, _Range] = {}
    for position, p in enumerate(probabilities):
        rank = max(1, math.ceil(p * head.n))
        if rank <= head.low_end:
            found[position] = -math.inf
        elif rank > head.n - head.high_end:
            found[position] = math.inf
        else:
            ranges[position] = _Range(head.lo, head.hi, rank - head.low_end, head.rows, head.n - head.low_end - head.high_end)

    sketch = head.cuts
    while ranges:
        found |= {k: r.lo for k, r in ranges.items() if r.lo == r.hi}
        found |= _read_off(values, {k: r for k, r in ranges.items() if r.lo < r.hi and r.rows <= finish_rows})
        ranges = _narrowed(values, {k: r for k, r in ranges.items() if k not in found}, sketch, weight is not None)
        sketch = None
    return [found[position] for position in range(len(probabilities))]


def _shares(points: Sequence[float], even: bool) -> list[float]:
    """Shares at which a sketch is asked for cuts: a little beyond its error on both sides of each point."""
    if even:
        return [i / (EVEN_CUTS + 1) for i in range(1, EVEN_CUTS + 1)]
    return sorted({min(1.0, max(0.0, p + side * 2 / ACCURACY)) for p in points for side in (-1, 1)})


def _tagged(values: DataFrame, ranges: dict[int, _Range]) -> tuple[DataFrame, list[tuple]]:
    """The values inside any of the ranges, with the number of their range. Ranges of one pass are equal or disjoint."""
    bounds = sorted({(r.lo, r.hi) for r in ranges.values()})
    tags = [F.when(F.col("v").between(F.lit(lo), F.lit(hi)), F.lit(i)) for i, (lo, hi) in enumerate(bounds)]
    return values.select("v", "w", F.coalesce(*tags).alias("t")).where(F.col("t").isNotNull()), bounds


def _narrowed(values: DataFrame, ranges: dict[int, _Range], sketch: list[float] | None, even: bool) -> dict[int, _Range]:
    """Each rank's new range, from counts at and between cuts; the cuts come from ``sketch`` or from a pass of their own."""
    if not ranges:
        return {}
    inside, bounds = _tagged(values, ranges)
    # Whole numbers are measured from the start of their range, where doubles tell them apart.
    starts = [lo if sketch is None and isinstance(lo, int) and hi - lo < EXACT else None for lo, hi in bounds]
    if sketch is None:
        shares = _shares([r.rank / r.n for r in ranges.values()], even)
        measure = F.coalesce(*[F.when(F.col("t") == i, (F.col("v") if s is None else F.col("v") - F.lit(s)).cast("double")) for i, s in enumerate(starts)])
        sketches = {row.t: row.cuts for row in inside.groupBy("t").agg(F.percentile_approx(measure, shares, ACCURACY).alias("cuts")).collect()}
    else:
        sketches = dict.fromkeys(range(len(bounds)), sketch)
    cuts = [_cuts(lo, hi, starts[i] or 0, sketches[i]) for i, (lo, hi) in enumerate(bounds)]
    placed = inside.withColumn("b", F.coalesce(*[F.when(F.col("t") == i, _place(own)) for i, own in enumerate(cuts)]))
    rows = placed.groupBy("t", "b").agg(F.sum("w").alias("n"), F.count("*").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    out = {}
    for position, r in ranges.items():
        tag, rank = bounds.index((r.lo, r.hi)), r.rank
        for row in sorted((row for row in rows if row.t == tag), key=lambda row: row.b):
            if rank <= row.n:
                out[position] = _Range(row.lo, row.hi, rank, row.rows, row.n)
                break
            rank -= row.n
    return out


def _cuts(lo, hi, start: int, sketch: list[float]) -> list:
    """Rising values of the range's own kind, from ``lo`` to ``hi``; one is in the middle, so every pass gains."""
    if isinstance(lo, int):
        middle, own = (lo + hi + 1) // 2, [int(c) + start for c in sketch]
    elif isinstance(lo, float):
        middle, own = lo / 2 + hi / 2, list(sketch)
    else:
        middle, own = (lo + hi) / 2, [type(lo)(repr(c)) for c in sketch]
    return sorted({c for c in [*own, middle] if lo <= c <= hi})


def _place(cuts: list) -> Column:
    """0 below the first cut, 1 at it, 2 between it and the next, and so on."""
    place = F.when(F.col("v") < F.lit(cuts[0]), 0)
    for i, cut in enumerate(cuts):
        place = place.when(F.col("v") == F.lit(cut), 2 * i + 1)
        place = place.when(F.col("v") < F.lit(cuts[i + 1]), 2 * i + 2) if i + 1 < len(cuts) else place.otherwise(2 * i + 2)
    return place


def _read_off(values: DataFrame, ranges: dict[int, _Range]) -> dict[int, float | int]:
    """The ranks of ranges that hold few rows."""
    if not ranges:
        return {}
    inside, _ = _tagged(values, ranges)
    counts = sorted(inside.groupBy("v").agg(F.sum("w").alias("n")).collect(), key=lambda r: r.v)
    picked = {}
    for position, r in ranges.items():
        rank = r.rank
        for row in counts:
            if r.lo <= row.v <= r.hi:
                rank -= row.n
                if rank <= 0:
                    picked[position] = row.v
                    break
    return picked


def time_quantile(df: DataFrame, column: str, probability: float, error: float = 0.0, weight: str | None = None) -> Column:
    """A quantile of a date or time column, as a literal of the same type (so filters on it push down)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        number = F.unix_date(F.col(column)).cast("long")
    else:
        number = F.unix_micros(F.col(column).cast("timestamp"))
    if error:
        picked = approximate_quantiles(df.select(number.alias("t")), "t", [probability], error)
    else:
        picked = exact_quantiles(df, number, [probability], weight)
    if not picked:
        raise ValueError(f"{column} has no value to split at")
    at = int(picked[0])
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(at))
    return F.timestamp_micros(F.lit(at)).cast(kind)
