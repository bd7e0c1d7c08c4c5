"""Column statistics, each computed in one pass over the data where possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from overspend import fixed_values as fv
from overspend.operators.lookup import BROADCAST_ROWS, attach_by_key
from overspend.session import stored

#: Ranges in which values are ranked; None leaves the number to the session.
RANGES: int | None = None


def _rows(df: DataFrame, aggregates: dict[str, dict[str, Column]], name: str = "column_name") -> DataFrame:
    """Aggregate once, then turn ``{row: {field: aggregate}}`` into one output row per entry."""
    records = F.array(*[
        F.struct(F.lit(row).alias(name), *[agg.alias(field) for field, agg in fields.items()])
        for row, fields in aggregates.items()
    ])
    return df.agg(records.alias("records")).select(F.inline("records"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column and their percentage."""
    return _rows(df, {c: {
        "n_null": F.count_if(F.col(c).isNull()),
        "pct_null": F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count("*")),
    } for c in columns})


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest, largest, mean and sample deviation per column."""
    return _rows(df, {c: {
        "min_value": F.min(c).cast("double"),
        "max_value": F.max(c).cast("double"),
        "mean_value": F.avg(c),
        "std_value": F.stddev_samp(c),
    } for c in columns})


def variance_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance per column and whether the column is worth keeping."""
    def keep(c: str) -> Column:
        return F.coalesce(F.var_samp(c) > 0, F.lit(False))

    return _rows(df, {c: {
        "n": F.count(c),
        "min_value": F.min(c).cast("double"),
        "max_value": F.max(c).cast("double"),
        "variance": F.var_samp(c),
        "std_value": F.stddev_samp(c),
        "decision": F.when(keep(c), "CONSERVAR").otherwise("ELIMINAR"),
    } for c in columns})


def frequency_tables(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Value counts of every dimension from a single scan (one grouping set per dimension)."""
    names = [f"_d{i}" for i in range(len(dimensions))]
    texts = df.select([F.col(d).cast("string").alias(name) for d, name in zip(dimensions, names)])
    counted = texts.groupingSets([[F.col(name)] for name in names], *[F.col(name) for name in names]).agg(
        F.count("*").alias("n"), *[F.grouping(name).alias(f"{name}_out") for name in names])
    picked = [F.when(F.col(f"{name}_out") == 0, F.struct(F.lit(d).alias("dimension"), F.col(name).alias("value")))
              for d, name in zip(dimensions, names)]
    return counted.select(F.coalesce(*picked).alias("p"), "n").select("p.dimension", "p.value", "n")


def top_values(df: DataFrame, dimension: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value."""
    return df.groupBy(dimension).agg(F.count("*").alias("n")).orderBy(F.desc("n"), dimension).limit(k)


def redundant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Find columns that carry no information: constant, all null, or equal to an earlier column.

    The first pass takes counts, bounds and an order-free hash of each column. Only columns that agree in all
    of these can be equal, and a second pass compares just those pairs row by row.
    """
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    facts = df.agg(*[
        expression.alias(f"{part}_{i}")
        for i, c in enumerate(columns)
        for part, expression in (
            ("nulls", F.count_if(F.col(c).isNull())),
            ("same", F.min(c).eqNullSafe(F.max(c))),
            ("bits", F.bit_xor(F.xxhash64(c))),
            ("total", F.sum(F.pmod(F.xxhash64(c), F.lit(1 << 31)))),
        )
    ], F.count("*").alias("n")).first()
    prints: dict[tuple, list[int]] = {}
    for i, c in enumerate(columns):
        mark = (str(kinds[c]), facts[f"nulls_{i}"], facts[f"bits_{i}"], facts[f"total_{i}"])
        prints.setdefault(mark, []).append(i)
    pairs = [(a, b) for group in prints.values() for n, b in enumerate(group) for a in group[:n]]
    differing = df.agg(*[
        F.count_if(~F.col(columns[a]).eqNullSafe(F.col(columns[b]))).alias(f"{a}_{b}") for a, b in pairs
    ]).first().asDict() if pairs else {}
    equal_to: dict[int, str] = {}
    for a, b in pairs:
        if differing[f"{a}_{b}"] == 0 and b not in equal_to:
            equal_to[b] = columns[a]
    records = []
    for i, c in enumerate(columns):
        constant = bool(facts[f"same_{i}"]) and facts[f"nulls_{i}"] in (0, facts["n"])
        records.append((c, facts[f"nulls_{i}"], constant, equal_to.get(i)))
    return df.sparkSession.createDataFrame(
        records, "column_name string, n_null long, is_constant boolean, equal_to string")


def drop_redundant(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns that ``redundant_columns`` reports, except those in ``keep``."""
    found = redundant_columns(df).where(F.col("is_constant") | F.col("equal_to").isNotNull())
    return df.drop(*[r.column_name for r in found.collect() if r.column_name not in keep])


def table_stats(df: DataFrame, moment: str) -> DataFrame:
    return df.agg(F.count("*").alias("total_records"), F.max(moment).alias("latest_date"))


def max_offsets(df: DataFrame) -> DataFrame:
    """Highest offset of each topic partition."""
    return df.groupBy("partition").agg(F.max("offset").alias("max_offset"))


def quality_gate(df: DataFrame, amount: str, moment: str, min_rows: int = fv.GATE_MIN_ROWS,
                 min_valid_share: float = fv.GATE_MIN_VALID_SHARE) -> DataFrame:
    """Row count, valid values, date range and a verdict."""
    seen = df.agg(F.count("*").alias("total"), F.count(amount).alias("valid"),
                  F.min(moment).alias("min_date"), F.max(moment).alias("max_date"))
    verdict = (
        F.when(F.col("total") < min_rows, "TOO_FEW_ROWS")
        .when(F.col("valid") < F.col("total") * min_valid_share, "TOO_FEW_VALID")
        .otherwise("OK")
    )
    return seen.withColumn("verdict", verdict)


def require_quality(df: DataFrame, amount: str, moment: str, **limits) -> None:
    """Raise when the gate does not pass."""
    result = quality_gate(df, amount, moment, **limits).first()
    if result.verdict != "OK":
        raise ValueError(f"{result.verdict}: {result.valid} valid of {result.total} rows")


def retention_report(df: DataFrame, keep: Column) -> DataFrame:
    """Rows in, kept and dropped by a filter, with percentages, in one pass."""
    kept = F.count_if(F.coalesce(keep, F.lit(False)))
    total = F.count("*")
    return df.agg(
        total.alias("rows_in"), kept.alias("rows_out"), (total - kept).alias("rows_dropped"),
        F.try_divide(kept * 100.0, total).alias("pct_kept"),
        F.try_divide((total - kept) * 100.0, total).alias("pct_dropped"),
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows in each non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("n"))


def block_profile(stored: DataFrame) -> DataFrame:
    """Rows in each block of a stored table's files, as the scan deals them to tasks."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return stored.groupBy(*place).agg(F.count("*").alias("n"))


def evenness(counted: DataFrame) -> DataFrame:
    """Parts, rows, rows of the largest part and its share, from one row of ``n`` per part."""
    return counted.agg(F.count("*").alias("parts"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.max("n").alias("largest"),
                       F.try_divide(F.max("n"), F.sum("n")).alias("share"))


def pearson(a: str, b: str) -> Column:
    """Pearson r over rows that have both values; null when one of them never varies.

    The built-in ``corr`` divides by zero there, which is an error in ANSI mode.
    """
    x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
    y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each feature with the target, one pass."""
    return _rows(df, {f: {"r": pearson(f, target)} for f in features}, "feature")


def select_features(correlated: DataFrame, threshold: float = fv.MIN_CORRELATION) -> DataFrame:
    """Keep features whose correlation is a number of at least ``threshold`` in size."""
    return correlated.where(F.col("r").isNotNull() & ~F.isnan("r") & (F.abs("r") >= threshold))


def vector_correlations(df: DataFrame, vector: str, target: str) -> DataFrame:
    """Pearson r of each vector position with the target.

    All rows take part; only the (d+1) by (d+1) matrix reaches the driver.
    """
    features = F.col(vector)
    if isinstance(df.schema[vector].dataType, T.ArrayType):
        features = array_to_vector(features.cast("array<double>"))
    pairs = df.select(features.alias("x"), F.col(target).cast("double").alias("y"))
    joined = VectorAssembler(inputCols=["x", "y"], outputCol="xy", handleInvalid="skip").transform(pairs)
    matrix = Correlation.corr(joined, "xy", "pearson").first()[0].toArray()
    return df.sparkSession.createDataFrame(
        [(i, float(r)) for i, r in enumerate(matrix[-1, :-1])], "position int, r double")


def ranked_correlations(correlated: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The ``k`` strongest correlations by size, numbered from 1; ties by ``key``. One row per feature meets in the window."""
    usable = correlated.where(F.col("r").isNotNull() & ~F.isnan("r")).orderBy(F.desc(F.abs("r")), key).limit(k)
    return usable.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.abs("r")), key)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full Pearson matrix of numeric columns in long form."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="x", handleInvalid="skip").transform(df)
    matrix = Correlation.corr(vectors, "x", "pearson").first()[0].toArray()
    records = [(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(records, "feature_a string, feature_b string, r double")


def average_ranks(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Each distinct value with its row count ``n`` and the mean rank of its rows; ``weight`` names a column of row counts.

    Values are counted first, so ties cost one row. The counted values are dealt out by ranges and written; running sums are
    taken inside each range and shifted by the totals of earlier ranges, one row per range. The driver sees no more than the range bounds.
    """
    counted = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).groupBy(F.col(column).alias("value")).agg(
        (F.count("*") if weight is None else F.sum(weight)).alias("n"))
    dealt = counted.repartitionByRange(*([] if RANGES is None else [RANGES]), "value").withColumn("_range", F.spark_partition_id())
    ranged = stored(dealt, "ranks")
    inside = Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("n").alias("_size"))
    shifts = totals.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    running = ranged.withColumn("_earlier", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(shifts), "_range")
    return running.select("value", "n", (F.col("_earlier") + F.col("_shift") + (F.col("n") + 1) / 2.0).alias("mean_rank"))


def spearman(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rank correlation of two columns, ties sharing their mean rank.

    Equal pairs are counted before anything is joined, and ranks are centred so that sums stay accurate.
    """
    # NaN is no rank; casts let whole-number columns through the same test.
    usable = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (first, second)]
    both = df.where(usable[0] & usable[1])
    pairs = counted = stored(both.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count("*").alias("w")), "rank-pairs")
    seen = pairs.agg(F.sum("w").alias("size"), F.approx_count_distinct("a").alias("a"), F.approx_count_distinct("b").alias("b")).first()
    size = seen["size"] or 0
    for side in ("a", "b"):
        ranks = average_ranks(counted, side, "w").select(
            F.col("value").alias(side), F.col("n").alias(f"n_{side}"), ((F.col("mean_rank") - (size + 1) / 2.0) / max(size, 1)).alias(f"r_{side}"))
        pairs = attach_by_key(pairs, ranks, side, f"n_{side}", few=seen[side] <= BROADCAST_ROWS)
    w, ra, rb = F.col("w"), F.col("r_a"), F.col("r_b")
    return pairs.agg(
        F.try_divide(F.sum(w * ra * rb), F.sqrt(F.sum(w * ra * ra)) * F.sqrt(F.sum(w * rb * rb))).alias("rho"))


def mean_text_length(df: DataFrame, text: str) -> DataFrame:
    return df.agg(F.avg(F.length(text)).alias("avg_length"))


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Rows whose key hashes below a bound: about ``fraction`` of the keys, with all rows of each.

    The same rows are chosen on any partitioning, in any order and in any other engine with MD5. A null counts as an empty text.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.where(number < F.lit(int(fraction * (1 << 32))))
