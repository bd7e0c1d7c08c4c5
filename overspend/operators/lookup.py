"""Joins with dictionaries and with per-key statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from overspend import fixed_values as fv, schemas

BROADCAST_ROWS = 100_000
HOT_KEYS = 1000
SPREAD = 4096


def region_table(spark: SparkSession, strict: bool = False) -> DataFrame:
    """Department to region; ``strict`` leaves out the departments that only the specification places."""
    rows = fv.DEPARTMENT_REGION + ([] if strict else fv.DEPARTMENT_REGION_MORE)
    return spark.createDataFrame(rows, schemas.REGION)


def payment_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.PAYMENT_NAMES, schemas.PAYMENT)


def join_region(df: DataFrame, regions: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Add ``region`` by department, with a default for departments not in the table.

    The built-in table has a fixed size and is broadcast; a table passed in is left to the optimizer.
    """
    if regions is None:
        regions = F.broadcast(region_table(df.sparkSession, strict))
    joined = df.drop("region").join(regions, "departamento", "left")
    return joined.withColumn("region", F.coalesce("region", F.lit(fv.UNKNOWN_REGION)))


def join_payment_name(df: DataFrame, code: str = "payment_type") -> DataFrame:
    """Left join with the seven payment names on differently named keys."""
    names = payment_table(df.sparkSession)
    return df.join(F.broadcast(names), F.col(code) == names.payment_id, "left_outer")


def has_few_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``limit`` rows; counting stops one row beyond."""
    return df.limit(limit + 1).count() <= limit


def attach_by_key(facts: DataFrame, stats: DataFrame, key: str, count: str, few: bool | None = None) -> DataFrame:
    """Left-join statistics that were aggregated per ``key``; ``count`` holds each key's row count.

    Few keys: the table is broadcast; unless ``few`` is given, its rows are counted first. Many keys: the keys that hold more
    than 1/1000 of all rows (so there are fewer than 1000 of them) are broadcast, and only the other rows meet
    the full table in a shuffle join. Rows already served, and rows without a key, are spread over the tasks
    of that join by a hash of their content, so no key can fill one task.
    """
    values = [name for name in stats.columns if name != key]
    if has_few_rows(stats) if few is None else few:
        return facts.join(F.broadcast(stats), key, "left")

    total = stats.agg(F.sum(count)).scalar()
    hot = stats.where(F.col(count) * HOT_KEYS > total).select(
        F.col(key), F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values])
    served = facts.join(F.broadcast(hot), key, "left")
    aside = F.col("_hot").isNotNull() | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(facts)]), F.lit(SPREAD))
    served = (
        served.withColumn("_key", F.when(~aside, F.col(key)))
        .withColumn("_spread", F.when(aside, spread).otherwise(F.lit(0)))
    )
    cold = stats.select(F.col(key).alias("_key"), F.lit(0).cast("long").alias("_spread"), *values)
    joined = served.join(cold, ["_key", "_spread"], "left")
    return joined.select(
        *[F.col(c) for c in facts.columns],
        *[F.coalesce(F.col(v), F.col(f"_hot_{v}")).alias(v) for v in values],
    )


def _hashable(df: DataFrame) -> list[str]:
    """Columns whose type ``xxhash64`` accepts."""
    unhashable = (T.MapType, T.VariantType, T.UserDefinedType)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, unhashable)]
    return plain or df.columns[:1]
