import pytest
from pyspark.sql import functions as F

from isobar.functions import expressions as X
from isobar.operators.trailing import usage_level


def evaluate(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_number_text(spark):
    texts = ["12,5", "12.5", "", "null", "Ip", None, "abc", "-3,0", "1.5.5", "12d", "0x1p3", "5.", " 7 ", "1e2"]
    assert evaluate(spark, texts, "string", X.number_text) == [
        12.5, 12.5, None, None, None, None, None, -3.0, None, None, None, 5.0, 7.0, 100.0,
    ]
    bad = evaluate(spark, texts, "string", lambda v: F.coalesce(X.is_bad_number(v), F.lit(False)))
    assert [t for t, b in zip(texts, bad) if b] == ["abc", "1.5.5", "12d", "0x1p3"]


def test_iso_date(spark):
    got = evaluate(
        spark, ["2024-02-29", "2023-02-29", "2024-1-5", "2024", "05/01/2024", None], "string", X.iso_date
    )
    assert [str(d) if d else None for d in got] == ["2024-02-29", None, "2024-01-05", None, None, None]


def test_dms(spark):
    texts = ["372214N", "055817W", "372214S", "372214n", "XX", "", None, "3722N", "37221AN", "003000E"]
    got = evaluate(spark, texts, "string", X.dms_to_decimal)
    north = 37 + 22 / 60 + 14 / 3600
    west = -(5 + 58 / 60 + 17 / 3600)
    assert got[:4] == pytest.approx([north, west, -north, north])
    assert got[4:9] == [None] * 5
    assert got[9] == pytest.approx(0.5)


def test_seasons(spark):
    names = evaluate(spark, list(range(1, 13)) + [None], "int", X.season)
    assert names == ["Invierno"] * 2 + ["Primavera"] * 3 + ["Verano"] * 3 + ["Otoño"] * 3 + ["Invierno", None]


def test_heat_is_graded_before_cold_and_bounds_are_exclusive(spark):
    df = spark.createDataFrame(
        [
            (1, 40.1, 0.0, "ALERTA ROJA - Temperatura Extremadamente Alta"),
            (2, 40.0, 0.0, "ALERTA ROJA - Temperatura Muy Alta"),
            (3, 35.0, 0.0, "ALERTA NARANJA - Temperatura Alta"),
            (4, 30.0, 0.0, "ALERTA AMARILLA - Temperatura Elevada"),
            (5, 25.0, 0.0, "Normal"),
            (6, 25.0, -0.1, "ALERTA AMARILLA - Temperatura Fría"),
            (7, 25.0, -5.0, "ALERTA AMARILLA - Temperatura Fría"),
            (8, 25.0, -5.1, "ALERTA NARANJA - Temperatura Baja"),
            (9, 25.0, -10.0, "ALERTA NARANJA - Temperatura Baja"),
            (10, 25.0, -10.1, "ALERTA ROJA - Temperatura Extremadamente Baja"),
            (11, 26.0, -10.1, "ALERTA AMARILLA - Temperatura Elevada"),
        ],
        "i int, tmax double, tmin double, want string",
    )
    got = df.withColumn("got", X.temperature_alert(F.col("tmax"), F.col("tmin")))
    assert [r.i for r in got.filter("got <> want").collect()] == []


def test_precipitation_and_humidity_alerts(spark):
    wet = evaluate(spark, [100.1, 100.0, 50.0, 25.0, None], "double", X.precipitation_alert)
    assert [w.split(" - ")[0] for w in wet] == ["ALERTA ROJA", "ALERTA NARANJA", "ALERTA AMARILLA", "Normal", "Normal"]
    damp = evaluate(spark, [95.1, 95.0, 20.0, 19.9, None], "double", X.humidity_alert)
    assert damp == [
        "ALERTA AMARILLA - Humedad Muy Alta", "Normal", "Normal", "ALERTA AMARILLA - Humedad Muy Baja", "Normal",
    ]


def test_overall_alert_and_severity(spark):
    rows = [
        (1, 41.0, 5.0, 0.0, 50.0, "ALERTA ROJA", 5),
        (2, 20.0, -10.5, 0.0, 50.0, "ALERTA ROJA", 5),
        (3, 20.0, 5.0, 100.5, 50.0, "ALERTA ROJA", 5),
        (4, 36.0, 5.0, 0.0, 50.0, "ALERTA NARANJA", 4),
        (5, 31.0, 5.0, 0.0, 50.0, "ALERTA AMARILLA", 3),
        (6, 20.0, 5.0, 0.0, 96.0, "ALERTA AMARILLA", 2),
        (7, 20.0, 5.0, 0.0, 10.0, "ALERTA AMARILLA", 2),
        (8, 26.0, 5.0, 0.0, 50.0, "Normal", 2),
        (9, 25.0, 0.0, 25.0, 95.0, "Normal", 1),
        (10, 31.0, 5.0, None, None, "ALERTA AMARILLA", 3),
        (11, 20.0, 5.0, None, None, "Normal", 1),
    ]
    df = spark.createDataFrame(rows, "i int, a double, b double, p double, h double, label string, severity int")
    args = [F.col(c) for c in "abph"]
    got = df.select("*", X.overall_alert(*args).alias("l"), X.alert_severity(*args).alias("s"))
    assert got.filter("l <> label or s <> severity").collect() == []


def test_climate_class(spark):
    rows = [
        (21.0, 499.0, "Clima Mediterráneo Seco"), (21.0, 500.0, "Clima Mediterráneo"), (20.0, 100.0, "Clima Mediterráneo"),
        (18.0, 100.0, "Clima Templado"), (19.0, 800.0, "Clima Templado"), (15.0, 100.0, "Clima Fresco"),
        (16.0, 1000.0, "Clima Fresco"), (10.0, 0.0, "Clima Frío"), (25.0, None, "Clima Fresco"), (None, 10.0, "Clima Frío"),
    ]
    df = spark.createDataFrame(rows, "t double, p double, want string")
    assert df.filter(X.climate_class(F.col("t"), F.col("p")) != F.col("want")).collect() == []


def test_comfort_score_bounds_are_inclusive(spark):
    rows = [
        (15.0, 300.0, 40.0, 100), (25.0, 800.0, 70.0, 100), (14.9, 300.0, 40.0, 80), (10.0, 200.0, 30.0, 80),
        (30.0, 1000.0, 80.0, 80), (5.0, 100.0, 20.0, 60), (35.0, 1200.0, 90.0, 60), (35.1, 1200.0, 90.0, 40),
        (20.0, None, 50.0, 40), (20.0, 500.0, None, 40), (20.0, 99.0, 50.0, 40), (20.0, 500.0, 90.1, 40),
    ]
    df = spark.createDataFrame(rows, "t double, p double, h double, want int")
    got = X.comfort_score(F.col("t"), F.col("p"), F.col("h"))
    assert df.filter(got != F.col("want")).collect() == []


def test_map_styles(spark):
    temps = [None, 9.9, 10.0, 19.9, 20.0, 29.9, 30.0]
    assert evaluate(spark, temps, "double", X.temperature_color) == [
        "gray", "blue", "green", "green", "orange", "orange", "red",
    ]
    assert evaluate(spark, [None, 49.0, 50.0, 100.0], "double", X.precipitation_color) == [
        "gray", "yellow", "orange", "red",
    ]
    assert evaluate(spark, [None, -20.0, 29.9, 90.0], "double", lambda v: X.marker_radius(v, "avg_temp")) == [5, 5, 9, 15]
    assert evaluate(spark, [None, 0.0, 99.0, 900.0], "double", lambda v: X.marker_radius(v, "total_precip")) == [5, 5, 9, 20]
    assert evaluate(spark, [None, 3.0], "double", lambda v: X.marker_radius(v, "max_temp")) == [5, 10]
    assert evaluate(spark, [None, 3.0, 25.0, 80.0], "double", X.climate_radius) == [8, 6, 12, 18]


def test_names(spark):
    names = ["VIC", "sant cugat", "L'hospitalet"]
    assert evaluate(spark, names, "string", X.capitalized) == ["Vic", "Sant cugat", "L'hospitalet"]
    assert evaluate(spark, names, "string", X.city_slug) == ["vic", "sant_cugat", "l'hospitalet"]


def test_rounding_ties(spark):
    values = [k / 40 for k in range(1, 40, 2)]
    from decimal import ROUND_HALF_UP, Decimal

    want = [float(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]
    assert evaluate(spark, values, "double", lambda v: F.round(v, 2)) == want


def test_usage_level(spark):
    got = evaluate(spark, [54, 55, 72, 73, 91], "long", lambda v: usage_level(v, F.lit(90)))
    assert got == ["normal", "moderate", "moderate", "high", "high"]
