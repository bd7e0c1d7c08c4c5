"""Field parsers, text rules and score limits on hand-made values."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from overspend import fixed_values as fv
from overspend.functions import fields, scores, text as txt, times

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
FIELD_TEXT = st.lists(st.one_of(
    st.sampled_from([None, "", " ", "No Definido", "ND", "no d", "sin definir", "30", " 45 ", "120 Dia(s)", "BPIN 2023-1",
                     "12345", "a1b2", "99999999999"]),
    st.text("0123456789 abND-", max_size=12)), min_size=1, max_size=60)


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("r")).collect()]


def plain_number(text, pattern):
    match = re.search(pattern, text)
    number = int(match.group(0)) if match else None
    return number if number is not None and number < 2**31 else None


def plain_duration(value):
    return None if value is None or value.strip().lower() in fv.BLANK_DURATION_WORDS else plain_number(value, r"\d+")


def plain_year(value):
    if value is None or value.strip().lower() in fv.BLANK_YEAR_WORDS:
        return 2024
    year = plain_number(value, r"\d{4}")
    return 2024 if year is None else year


@SLOW
@given(FIELD_TEXT)
def test_duration_and_year_follow_the_rule(spark, values):
    assert apply(spark, values, fields.parse_duration) == [plain_duration(v) for v in values]
    assert apply(spark, values, fields.parse_year) == [plain_year(v) for v in values]


def test_known_field_values(spark):
    texts = ["No Definido", "sin definir", "30", "120 Dia(s)", "BPIN 2023-1", "12345", None, ""]
    assert apply(spark, texts, fields.parse_duration) == [None, None, 30, 120, 2023, 12345, None, None]
    assert apply(spark, texts, fields.parse_year) == [2024, 2024, 2024, 2024, 2023, 1234, 2024, 2024]


def test_numbers_are_truncated_and_nan_is_missing(spark):
    values = [30.9, -2.5, float("nan"), None, 1e300]
    assert apply(spark, values, fields.whole_number, "double") == [30, -2, None, None, None]
    assert apply(spark, values, lambda c: fields.whole_number(c, 2024), "double") == [30, -2, 2024, 2024, 2024]


@SLOW
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x0bİ"), max_size=40), min_size=1, max_size=40))
def test_normalize_text_is_idempotent_and_plain(spark, values):
    once = apply(spark, values, txt.normalize_text)
    assert apply(spark, once, txt.normalize_text) == once
    assert all(re.fullmatch(r"[a-z0-9]*( [a-z0-9]+)*", v) for v in once)


def test_normalize_text_examples(spark):
    assert apply(spark, ["  Prestación de SERVICIOS, año 2024!! ", "ê ç è", None], txt.normalize_text) == [
        "prestacion de servicios ano 2024", "", None]


def test_stopwords_keep_repeats_and_match_without_accents(spark):
    words = ["obra", "obra", "prestacion", "tambien", "de", "via"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    kept = df.select(txt.remove_stopwords(F.col("w"), txt.stopwords(fv.STOPWORDS_MEDIUM))).first()[0]
    literal = df.select(txt.remove_stopwords(F.col("w"), txt.stopwords(fv.STOPWORDS_MEDIUM, strict=True))).first()[0]
    assert kept == ["obra", "obra", "via"]
    assert literal == ["obra", "obra", "tambien", "via"]
    assert (len(fv.STOPWORDS_SHORT), len(fv.STOPWORDS_MEDIUM), len(fv.STOPWORDS_LONG)) == (19, 55, 65)


def test_rows_without_long_tokens_are_dropped(spark):
    df = spark.createDataFrame([("el de la obra",), ("el de la y",), ("ab cd",)], "objeto_limpio string")
    assert [r.palabras_filtradas for r in txt.with_tokens(df).collect()] == [["obra"]]
    assert spark.range(1).select(txt.long_tokens(F.lit(None).cast("array<string>"))).first()[0] == []


def test_short_text_is_dropped_at_the_limit(spark):
    df = spark.createDataFrame([("123456789",), ("1234567890",), (None,)], "t string")
    assert [r.t for r in txt.with_clean_text(df, "t").collect()] == ["1234567890"]


def test_dates(spark):
    texts = ["2024-01-04T00:00:00.000", "", "sin fecha", None, "2024-02-30T00:00:00.000"]
    assert [str(v) for v in apply(spark, texts, fields.parse_date)] == ["2024-01-04", "None", "None", "None", "None"]


def test_blank_text_becomes_null(spark):
    assert apply(spark, ["", "  ", "nan", "NaN", "None", "obra", None], fields.blank_to_null) == [
        None, None, None, None, None, "obra", None]


def test_severity_limits(spark):
    values = [2.8, 2.8000001, 3.5, 3.5000001, 4.5, 4.5000001, -9.0, None, float("nan")]
    assert apply(spark, values, scores.severity, "double") == [
        "NORMAL", "LEVE", "LEVE", "MODERADO", "MODERADO", "SEVERO", "NORMAL", "NORMAL", "NORMAL"]


def test_flag_is_strict_and_one_sided(spark):
    assert apply(spark, [2.0, 2.0001, -9.0, None], lambda c: scores.flag(c, F.lit(2.0)), "double") == [
        "LIBRE", "ATIPICO", "LIBRE", "LIBRE"]
    assert apply(spark, [1.0], lambda c: scores.z_score(c, F.lit(0.0)), "double") == [None]


@pytest.mark.parametrize("category", [scores.tip_category, scores.tip_category_udf])
def test_tip_category(spark, category):
    pairs = [(25.0, 100.0), (25.1, 100.0), (15.0, 100.0), (15.1, 100.0), (0.0, 100.0), (None, 100.0), (1.0, 0.0),
             (1.0, None), (0.1, 100.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, tip double, total double")
    got = [r.c for r in df.select("i", category(F.col("tip"), F.col("total")).alias("c")).orderBy("i").collect()]
    assert got == ["Media", "Alta", "Baja", "Media", "Ninguna", "Ninguna", "N/A", "N/A", "Baja"]


def test_trip_kind_limits(spark):
    assert apply(spark, [5.0, 5.1, 10.0, 10.1, 20.0, 20.1], scores.trip_kind, "double") == [
        "Corto", "Medio", "Medio", "Largo (No Aero)", "Largo (No Aero)", "Largo (Aero)"]


def test_scales(spark):
    assert apply(spark, [0.0], lambda c: scores.scaled(c, "log1p"), "double") == [0.0]
    with pytest.raises(ValueError):
        scores.scaled(F.lit(1), "square")


def test_time_differences(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 23:59:00' AS a, TIMESTAMP_NTZ'2024-01-02 00:01:30' AS b")
    a, b = F.col("a"), F.col("b")
    assert tuple(df.select(times.seconds_between(a, b), times.minutes_between(a, b), times.days_between(a, b)).first()) == (
        150, 2.5, 1)
    assert df.select(*[c.alias(n) for n, c in times.calendar_parts(a).items()]).first().asDict() == {
        "anno": 2024, "mes": 1, "dia_semana": 2, "hora": 23}
