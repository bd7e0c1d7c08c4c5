"""Quantiles, lookups, profiles, encodings and the anomaly rule against plain Python."""

import math
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from overspend import fixed_values as fv
from overspend.functions.fields import valid_amount
from overspend.operators import anomaly, clean, encode, lookup, profile, quantiles, trips as trip_ops

POINTS = [0.0, 0.01, 0.25, 0.5, 0.8, 0.99, 1.0]


def plain_quantiles(values):
    ordered = sorted(values)
    return [ordered[max(1, math.ceil(p * len(ordered))) - 1] for p in POINTS]


NUMBERS = random.Random(7)
CASES = {
    "spread": [NUMBERS.lognormvariate(10, 4) for _ in range(500)],
    "hot value": [5.0] * 200 + [NUMBERS.random() for _ in range(300)],
    "one value": [3.5] * 40,
    "two values": [1.0, 2.0],
    "negative": [NUMBERS.gauss(0, 1) for _ in range(301)],
    "huge range": [-1.7e308, 1.7e308, 0.0, 1e-300, 5.0, -3.0, 1e300],
    "infinite": [math.inf, -math.inf, -math.inf, 1.0, 2.0, 3.0, math.inf],
    "only infinite": [math.inf, -math.inf],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("finish", [1, 10_000])
def test_exact_quantiles(spark, name, finish):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert quantiles.exact_quantiles(df, "v", POINTS, finish_rows=finish) == plain_quantiles(values)


def jobs_of(spark, call):
    """The result of a call and the number of jobs it took."""
    group = f"jobs-{id(call)}"
    spark.sparkContext.setJobGroup(group, group)
    result = call()
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("kind,values,most", [
    ("double", [math.exp(i) for i in range(600)], 10),
    ("double", [math.exp(NUMBERS.uniform(-700, 700)) for _ in range(20_000)] + [0.0] * 9_000, 16),
    ("long", [NUMBERS.randrange(-2**63, 2**63) for _ in range(9_000)] + [-2**63, 2**63 - 1], 16),
    ("long", [2**62 + NUMBERS.randrange(5) for _ in range(9_000)] + [-2**63], 16),
    ("decimal(30,2)", [Decimal(NUMBERS.randrange(10**12)) / 100 for _ in range(2_000)], 16),
])
def test_quantile_passes_follow_the_rows(spark, kind, values, most):
    """Not the spread of the values, nor their repeats; the full range of longs is fine."""
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    got, jobs = jobs_of(spark, lambda: quantiles.exact_quantiles(df, "v", POINTS, finish_rows=1_000))
    assert got == plain_quantiles(values) and jobs <= most


def test_quantiles_of_counted_values(spark):
    values = [NUMBERS.randrange(50) ** 3 for _ in range(4_000)] + [7] * 3_000
    counted = spark.createDataFrame([(v,) for v in values], "v long").groupBy("v").count()
    for finish in (1, 10_000):
        assert quantiles.exact_quantiles(counted, "v", POINTS, weight="count", finish_rows=finish) == plain_quantiles(values)


def test_approximate_quantiles_keep_their_error(spark):
    df = spark.range(10_000)
    got = quantiles.approximate_quantiles(df, "id", POINTS, 0.01)
    assert all(abs(v - p * 10_000) <= 101 for v, p in zip(got, POINTS))


def test_exact_quantiles_of_long_numbers(spark):
    values = [2**62 + i * 3 for i in range(100)] + [-5, 0, 7]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert quantiles.exact_quantiles(df, "v", POINTS, finish_rows=1) == plain_quantiles(values)
    assert quantiles.exact_quantiles(df.where("v is null"), "v", POINTS) == []


def test_time_quantile_keeps_the_type(spark):
    df = spark.sql("SELECT date_add(DATE'2024-01-01', id::int) AS d, date_add(DATE'2024-01-01', id::int)::timestamp_ntz AS n, "
                   "date_add(DATE'2024-01-01', id::int)::timestamp AS t FROM range(10)")
    for column in ("d", "n", "t"):
        cut = quantiles.time_quantile(df, column, 0.8)
        picked = df.select(cut.alias("c"))
        assert picked.schema["c"].dataType == df.schema[column].dataType
        assert str(picked.first().c)[:10] == "2024-01-08"
    with pytest.raises(ValueError):
        quantiles.time_quantile(df.where("false"), "d", 0.8)


def test_temporal_split_covers_all_rows_with_ties(spark):
    df = spark.sql("SELECT id, date_add(DATE'2024-01-01', (id % 5)::int) AS d FROM range(100)")
    train, test, _ = encode.temporal_split(df, "d")
    assert (train.count(), test.count()) == (80, 20)
    assert train.agg(F.max("d")).first()[0] < test.agg(F.min("d")).first()[0]


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a tail of rare keys and rows without a key."""
    return spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 17 = 0 THEN NULL ELSE concat('k', id % 700) END "
                     "AS k, (id % 91)::double AS v FROM range(6000)")


def test_lookup_beyond_the_broadcast_size(spark, skewed, rows):
    stats = skewed.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    wanted = skewed.join(stats, "k", "left").select("id", "k", "v", "n", "s")
    assert rows(lookup.attach_by_key(skewed, stats, "k", "n", few=False).select("id", "k", "v", "n", "s")) == rows(wanted)
    assert rows(lookup.attach_by_key(skewed, stats, "k", "n").select("id", "k", "v", "n", "s")) == rows(wanted)


def test_lookup_spreads_hot_rows(spark, skewed):
    stats = skewed.groupBy("k").agg(F.count("*").alias("n"))
    plan = lookup.attach_by_key(skewed, stats, "k", "n", few=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r.n for r in profile.partition_profile(plan).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 6000 and max(sizes) < 1500


def test_regions(spark, rows):
    df = spark.createDataFrame([("Antioquia",), ("Meta",), ("Atlantis",), (None,)], "departamento string")
    assert rows(lookup.join_region(df)) == rows(spark.createDataFrame(
        [("Antioquia", "Eje Cafetero"), ("Meta", "Orinoquía"), ("Atlantis", "Desconocida"), (None, "Desconocida")],
        "departamento string, region string"))
    strict = dict(tuple(r) for r in lookup.join_region(df, strict=True).collect())
    assert strict["Meta"] == "Desconocida" and strict["Antioquia"] == "Eje Cafetero"
    names = [d for d, _ in fv.DEPARTMENT_REGION + fv.DEPARTMENT_REGION_MORE]
    assert len(set(names)) == len(names) == 34


def test_profiles_of_a_tiny_table(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (None, "b", None)], "n int, t string, e string")
    assert rows(profile.null_profile(df, ["n", "t"])) == [("n", 1, 100 / 3), ("t", 0, 0.0)]
    assert rows(profile.frequency_tables(df, ["n", "t"])) == sorted(
        [("n", "1", 1), ("n", "2", 1), ("n", None, 1), ("t", "a", 2), ("t", "b", 1)], key=repr)
    numbers = profile.variance_check(df.withColumn("c", F.lit(4)), ["n", "c"]).collect()
    assert [(r.column_name, r.decision) for r in numbers] == [("n", "CONSERVAR"), ("c", "ELIMINAR")]
    assert [r.column_name for r in profile.null_profile(df.where("false"), ["n"]).collect()] == ["n"]


def test_redundant_columns(spark):
    df = spark.createDataFrame(
        [(1, 1, 2, "x", None, 1), (2, 2, 1, "x", None, None), (2, 2, 2, "x", None, 1)],
        "a int, same int, swapped int, constant string, empty string, gap int")
    found = {r.column_name: (r.is_constant, r.equal_to) for r in profile.redundant_columns(df).collect()}
    assert found == {"a": (False, None), "same": (False, "a"), "swapped": (False, None), "constant": (True, None),
                     "empty": (True, None), "gap": (False, None)}
    assert profile.drop_redundant(df).columns == ["a", "swapped", "gap"]
    assert profile.drop_redundant(df, keep=["same"]).columns == ["a", "same", "swapped", "gap"]


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_spearman_with_ties(spark, ranges, monkeypatch):
    """The same for any number of ranges, whether ranks are broadcast or not."""
    monkeypatch.setattr(profile, "RANGES", ranges)
    if ranges == 3:
        monkeypatch.setattr(profile, "BROADCAST_ROWS", 10)
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, 400).astype(float)
    x[:140] = 5.0
    y = x * 2 + rng.normal(0, 20, 400).round(0)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    wanted = np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]
    assert profile.spearman(df, "x", "y").first().rho == pytest.approx(wanted, abs=1e-12)
    ranks = {r.value: r.mean_rank for r in profile.average_ranks(df, "x").collect()}
    assert ranks == dict(zip(x, pd.Series(x).rank()))


def test_vector_correlations(spark):
    rng = np.random.default_rng(4)
    vectors, y = rng.normal(size=(60, 3)), rng.normal(size=60)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(vectors, y)], "v array<double>, y double")
    got = [r.r for r in profile.vector_correlations(df, "v", "y").orderBy("position").collect()]
    assert got == pytest.approx([np.corrcoef(vectors[:, i], y)[0, 1] for i in range(3)])


def test_feature_selection_drops_nan_and_weak(spark):
    df = spark.createDataFrame([("a", 0.05), ("b", -0.2), ("c", 0.049), ("d", float("nan")), ("e", None)], "feature string, r double")
    assert sorted(r.feature for r in profile.select_features(df).collect()) == ["a", "b"]


@pytest.mark.parametrize("total,valid,verdict", [(100, 100, "TOO_FEW_ROWS"), (10_000, 9_500, "OK"), (10_000, 9_499, "TOO_FEW_VALID")])
def test_quality_gate(spark, total, valid, verdict):
    df = spark.range(total).select(F.when(F.col("id") < valid, 1.0).alias("v"), F.lit("2024-01-01").cast("date").alias("d"))
    assert profile.quality_gate(df, "v", "d").first().verdict == verdict
    if verdict != "OK":
        with pytest.raises(ValueError, match=verdict):
            profile.require_quality(df, "v", "d")


def test_retention_counts_nulls_as_dropped(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (float("nan"),)], "v double")
    assert tuple(profile.retention_report(df, valid_amount(F.col("v"))).first()) == (4, 1, 3, 25.0, 75.0)


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in profile.top_values(df, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_correlation_of_partial_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, 6.0, 1.0)], "a double, b double, c double")
    found = {r.feature: r.r for r in profile.correlations(df, ["a", "c"], "b").collect()}
    assert found["a"] == pytest.approx(1.0) and (found["c"] is None or math.isnan(found["c"]))


def test_bad_messages(spark):
    records = spark.createDataFrame([
        (b"{bad", 0, 0), (b'{"id_contrato": "1", "valor_contrato": "caro", "objeto_contrato": "obra"}', 0, 1),
        (b'{"id_contrato": "2", "objeto_contrato": "obra", "valor_contrato": 5, "fecha_firma": "2024-01-04T00:00:00.000"}', 0, 2),
        (b'{"id_contrato": "3", "objeto_contrato": " ", "valor_contrato": 5, "fecha_firma": "2024-01-04"}', 0, 3),
        (b'{"id_contrato": "4", "objeto_contrato": "obra", "valor_contrato": -1, "fecha_firma": "2024-01-04"}', 0, 4),
        (None, 0, 6),
        (b'{"id_contrato": "5", "objeto_contrato": "obra", "valor_contrato": 1, "fecha_firma": "ayer"}', 0, 5),
    ], "value binary, partition int, offset long").withColumn("timestamp", F.current_timestamp())
    bronze = clean.parse_records(records)
    assert [(r.id_contrato, r.valor_contrato, r.offset) for r in bronze.orderBy("offset").collect()][:2] == [
        (None, None, 0), ("1", None, 1)]
    assert bronze.count() == 7
    silver = clean.to_silver(bronze)
    assert [r.id_contrato for r in silver.collect()] == ["2"]
    assert not set(fv.REDUNDANT_COLUMNS) & set(silver.columns)
    assert sorted(r.id_contrato for r in clean.to_silver(bronze, strict=True).collect()) == ["2", "3"]


def test_incremental_rows(spark):
    df = spark.sql("SELECT date_add(DATE'2024-01-01', id::int) AS d FROM range(5)")
    empty = df.where("false")
    default = F.lit("2024-01-03").cast("date")
    assert clean.newer_than(df, "d", clean.high_watermark(empty, "d", default)).count() == 2
    assert clean.newer_than(df, "d", clean.high_watermark(empty, "d", default), inclusive=True).count() == 3
    assert clean.newer_than(df, "d", clean.high_watermark(df, "d", default)).count() == 0


def test_trip_limits(spark):
    base = {"m": 10, "dist": 1.0, "total": 10.0, "tip": 1.0, "pas": 1, "rate": 1}
    changes = [{}, {"m": 1}, {"m": 720}, {"m": 719}, {"dist": 0.0}, {"total": 0.0}, {"tip": 5.0}, {"tip": 5.1}, {"tip": None},
               {"pas": None}, {"rate": None}]
    data = [(i, *(base | c).values()) for i, c in enumerate(changes)]
    df = spark.createDataFrame(data, "i int, m int, trip_distance double, total_amount double, tip_amount double, passenger_count int, RatecodeID int")
    start = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    timed = df.withColumn("tpep_pickup_datetime", start).withColumn(
        "tpep_dropoff_datetime", F.expr("tpep_pickup_datetime + make_dt_interval(0, 0, m)"))
    assert sorted(r.i for r in trip_ops.clean_trips(timed).collect()) == [0, 3, 6]


def test_target_encoding(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 6.0), ("c", None)], "k string, y double")
    fitted = encode.fit_target_encoding(train, "k", "y", m=2)
    got = {r.k: r.k_te for r in fitted.apply(spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "k string")).collect()}
    assert fitted.overall == 5.0
    assert got == {"a": (2 * 2 + 2 * 5) / 4, "b": (10 + 2 * 5) / 3, "c": 5.0, "z": 5.0, None: 5.0}


def test_frequencies_sum_to_one(spark, skewed):
    table = encode.frequency_table(skewed, "k")
    assert table.agg(F.sum("k_freq")).first()[0] == pytest.approx(1.0)


def test_log_scale_fixture_has_real_outliers(spark):
    rng = random.Random(5)
    data = [(i, "g", math.exp(rng.gauss(10, 0.3))) for i in range(400)] + [(500 + i, "g", math.exp(13.0)) for i in range(3)]
    df = spark.createDataFrame(data, "i int, g string, v double").withColumn("t", F.timestamp_seconds(F.col("i")))
    judged = anomaly.detect_by_group(df, "v", "g", "t", scale="log1p")
    flagged = {r.i for r in anomaly.anomalies_only(judged).collect()}
    assert {500, 501, 502} <= flagged
    assert {r.severity for r in judged.where("i >= 500").collect()} == {"SEVERO"}


def test_fewer_flags_with_a_higher_multiplier(spark):
    scored = spark.range(1000).select((F.col("id") % 100).cast("double").alias("label"), F.lit(50.0).alias("prediction"))
    counts = [anomaly.anomalies_only(anomaly.score_anomalies(scored, 20.0, multiplier=m)).count() for m in (0.5, 1.0, 2.0, 2.8)]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1]


def test_sigma_is_the_sample_deviation(spark):
    scored = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (4.0, 0.0)], "label double, prediction double")
    result = anomaly.residual_sigma(scored).first()
    assert result.sigma == pytest.approx(np.std([1, 2, 4], ddof=1))
    assert result.threshold == pytest.approx(2.8 * result.sigma)


def test_rank_correlation_leaves_nan_out(spark, monkeypatch):
    rows = [(float(i), float((i * 7) % 50)) for i in range(50)] + [(float("nan"), 1.0), (2.0, float("nan")), (None, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    small = profile.spearman(df, "a", "b").first().rho
    monkeypatch.setattr(profile, "RANGES", 5)
    assert small == pytest.approx(profile.spearman(df, "a", "b").first().rho) and small == pytest.approx(profile.spearman(df.where("a < 50 and b < 50"), "a", "b").first().rho)


def test_one_nan_does_not_silence_the_rule(spark):
    from datetime import datetime, timedelta

    rows = [("g", 10.0 + i % 3, datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(200)]
    rows += [("g", value, datetime(2024, 1, 20)) for value in (float("nan"), None, 0.0, 500.0)]
    judged = anomaly.detect_by_group(spark.createDataFrame(rows, "k string, v double, at timestamp"), "v", "k", "at")
    assert [r.v for r in judged.where("anomaly_flag = 'ATIPICO'").collect()] == [500.0]


def test_numeric_source_fields_are_truncated(spark):
    row = {name: "x" for name in ("referencia_del_contrato", "descripcion_del_procedimiento", "nombre_entidad", "departamento", "municipio",
                                  "codigo_de_categoria_principal", "descripcion_del_proceso", "valor_del_contrato", "fecha_de_inicio_del_contrato",
                                  "tipo_de_contrato", "estado_contrato", "modalidad_de_contratacion")}
    raw = spark.createDataFrame([{**row, "id": 1, "duraci_n_del_contrato": 30.9, "anno_bpin": 30.0}, {**row, "id": 2, "duraci_n_del_contrato": float("nan"), "anno_bpin": float("nan")}])
    got = {r.id_interno_sistema: (r.duracion_dias, r.anno) for r in clean.normalize_source(raw, "id").collect()}
    assert got == {"SYS-1": (30, 30), "SYS-2": (None, 2024)}


def test_ranked_correlations_break_ties_and_drop_nan(spark):
    df = spark.createDataFrame([(0, 0.5), (1, -0.9), (2, float("nan")), (3, -0.5), (4, None), (5, 0.1)], "position int, r double")
    assert [(r.place, r.position) for r in profile.ranked_correlations(df, "position", 3).orderBy("place").collect()] == [(1, 1), (2, 0), (3, 3)]


def test_blocks_hold_all_rows(spark, tmp_path):
    spark.range(0, 1000, 1, 4).write.parquet(str(tmp_path / "t"))
    row = profile.evenness(profile.block_profile(spark.read.parquet(str(tmp_path / "t")))).first()
    assert (row.parts, row.total, row.largest, row.share) == (4, 1000, 250, 0.25)
    assert profile.evenness(profile.block_profile(spark.read.parquet(str(tmp_path / "t"))).limit(0)).first().total == 0
