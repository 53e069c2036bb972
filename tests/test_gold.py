import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from isobar.operators.quantiles import quantiles, value_counts
from isobar.operators.ranking import add_ranks, number_rows, rows_between, sorted_by, with_range
from isobar.plans import gold
from isobar.schemas import GOLD_SCHEMAS

from rows import one, silver, types


def month_of(spark):
    days = [
        dict(date=date(2021, 1, d), temp_avg_c=t, temp_min_c=t - 5, temp_max_c=t + 5, precip_mm=p, humidity_percent=h)
        for d, t, p, h in [(1, -4.0, 30.0, None), (2, 10.0, None, 85.0), (3, 26.0, 11.0, 50.0), (4, 12.0, 10.0, 80.0)]
    ]
    return silver(spark, *days)


@pytest.mark.parametrize("name", list(gold.GOLD_TABLES))
def test_schema(spark, name):
    assert types(gold.GOLD_TABLES[name](month_of(spark))) == types(GOLD_SCHEMAS[name])


def test_monthly_summary(spark):
    row = one(gold.city_yearly_summary(month_of(spark)))
    assert (row["year"], row["month"], row["days"]) == ("2021", 1, 4)
    assert (row["avg_temp"], row["max_temp"], row["min_temp"]) == (11.0, 31.0, -9.0)
    assert (row["total_precip"], row["avg_humidity"]) == (51.0, 71.67)


@pytest.mark.parametrize("name", gold.FROM_MONTHS)
def test_tables_from_station_months_equal_those_from_silver(spark, name):
    rng = random.Random(9)
    rows = [
        {"date": date(2020 + i % 2, 1 + i % 12, 1 + i % 28), "city": f"c{i % 3}", "station": f"S{i % 5}",
         "temp_avg_c": rng.randint(-20, 80) / 2, "temp_max_c": float(rng.randint(20, 45)), "temp_min_c": float(rng.randint(-9, 9)),
         "precip_mm": rng.choice([None, 0.0, 12.5, 40.0]), "humidity_percent": rng.choice([None, 50.0, 90.0]),
         "snow_depth_cm": rng.choice([None, None, 3.0]), "lat": rng.choice([None, 36.5, 37.0])}
        for i in range(400)
    ]
    df = silver(spark, *rows)
    direct, shared = gold.GOLD_TABLES[name](df), gold.GOLD_TABLES[name](gold.station_months(df), gold.MONTHLY)
    assert types(direct) == types(shared)
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in direct.dtypes]
    assert direct.select(rounded).exceptAll(shared.select(rounded)).count() == 0
    assert direct.count() == shared.count()


def test_two_sources_count_as_two_days(spark):
    df = silver(spark, {"source": "aemet"}, {"source": "meteostat"})
    assert one(gold.city_yearly_summary(df))["days"] == 2


def test_missing_measures_stay_missing(spark):
    row = one(gold.city_extreme_days(silver(spark, {"precip_mm": None})))
    assert row["total_precip_month"] is None


def test_seasonal(spark):
    row = one(gold.seasonal_analysis(month_of(spark)))
    temps = [-4.0, 10.0, 26.0, 12.0]
    assert row["season"] == "Invierno" and row["total_days"] == 4
    assert (row["hot_days"], row["cold_days"], row["rainy_days"], row["windy_days"], row["humid_days"]) == (1, 1, 2, 0, 1)
    assert row["temp_variability"] == pytest.approx(statistics.stdev(temps))
    assert (row["temp_75th_percentile"], row["temp_25th_percentile"]) == (15.5, 6.5)


def test_one_row_group_has_no_deviation(spark):
    assert one(gold.seasonal_analysis(silver(spark, {})))["temp_variability"] is None


def test_alert_rows(spark):
    base = dict(temp_max_c=20.0, temp_min_c=10.0, precip_mm=0.0, humidity_percent=50.0)
    days = [
        {**base}, {**base, "temp_max_c": 25.0}, {**base, "temp_min_c": 0.0}, {**base, "precip_mm": 25.0},
        {**base, "humidity_percent": 95.0}, {**base, "humidity_percent": 20.0},
        {**base, "precip_mm": None, "humidity_percent": None},
        {**base, "temp_max_c": 25.5}, {**base, "temp_min_c": -0.5}, {**base, "precip_mm": 25.5},
        {**base, "humidity_percent": 95.5}, {**base, "humidity_percent": 19.5},
        {**base, "precip_mm": None, "humidity_percent": None, "temp_max_c": 45.0},
    ]
    rows = silver(spark, *[{**d, "date": date(2021, 2, 1) + timedelta(i)} for i, d in enumerate(days)])
    found = {r.date.day - 1: r.alert_severity for r in gold.weather_alerts(rows).collect()}
    assert found == {7: 2, 8: 3, 9: 3, 10: 2, 11: 2, 12: 5}


def test_insights_order(spark):
    rows = [
        {"date": date(2021, m, 1), "city": c, "precip_mm": p}
        for m, c, p in [(6, "A", 5.0), (7, "A", 5.0), (8, "B", None), (6, "C", 9.0), (6, "D", 1.0), (7, "D", 2.0), (8, "D", 3.0),
                        (12, "A", None), (1, "B", 0.0), (2, "C", 4.0), (5, "Z", 99.0)]
    ]
    df = silver(spark, *rows)
    summer = [(r.city, r.month, r.insight_precip) for r in gold.min_precipitation(df).collect()]
    assert summer == [("C", "06", 9.0), ("A", "06", 5.0), ("A", "07", 5.0), ("D", "08", 3.0), ("D", "07", 2.0)]
    winter = [(r.city, r.insight_precip) for r in gold.max_precipitation(df).collect()]
    assert winter == [("B", 0.0), ("C", 4.0), ("A", None)]


def test_comparison(spark):
    rows = [
        {"city": "A", "station": "S1", "temp_avg_c": 20.0, "temp_max_c": 31.0, "precip_mm": 400.0, "humidity_percent": 50.0},
        {"city": "B", "station": "S2", "temp_avg_c": 20.0, "temp_max_c": 20.0, "precip_mm": None, "humidity_percent": None},
        {"city": "C", "station": "S3", "region": "R2", "temp_avg_c": 22.0, "lat": None},
        {"city": "D", "station": "S4", "region": "R2", "temp_avg_c": 25.0, "precip_mm": 10.0},
    ]
    found = {r.city: r for r in gold.climate_comparison(silver(spark, *rows)).collect()}
    assert sorted(found) == ["A", "B", "D"]
    assert [found[c].heat_rank_overall for c in "ABD"] == [2, 3, 1]
    assert [found[c].heat_rank_in_region for c in "ABD"] == [1, 2, 1]
    assert [found[c].precip_rank_overall for c in "ABD"] == [1, 3, 2]
    assert (found["A"].climate_classification, found["A"].climate_comfort_score) == ("Clima Mediterráneo", 100)
    assert (found["B"].climate_classification, found["B"].climate_comfort_score) == ("Clima Fresco", 40)
    assert (found["A"].pct_hot_days, found["B"].pct_hot_days) == (100.0, 0.0)


def _stations(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a third share one value, some have none, half sit in one region
        value = 7.0 if i % 3 == 0 else None if i % 11 == 0 else float(rng.randint(0, 50))
        rows.append((f"c{i:04d}", "hot" if i % 2 else rng.choice(["r1", "r2", None]), value, float(i % 7)))
    return spark.createDataFrame(rows, "city string, region string, m double, k double")


def test_range_ranks_equal_window_ranks(spark):
    df = _stations(spark)
    ranks = {"a": "m", "b": "k"}
    ranged = add_ranks(df, ranks, ["city"], "region")
    plain = df
    for name, metric in ranks.items():
        order = [F.desc_nulls_last(metric), F.asc("city")]
        plain = plain.withColumns({
            f"{name}_rank_overall": F.row_number().over(Window.orderBy(*order)).cast("long"),
            f"{name}_rank_in_region": F.row_number().over(Window.partitionBy("region").orderBy(*order)).cast("long"),
        })
    columns = sorted(plain.columns)
    assert sorted(plain.columns) == sorted(ranged.columns)
    assert plain.select(columns).exceptAll(ranged.select(columns)).count() == 0
    assert ranged.count() == df.count()


def test_numbers_in_groups(spark):
    df = _stations(spark)
    order = [("m", False), ("city", True)]
    numbered = number_rows(df, order, "n", "region", "g")
    assert [r.n for r in numbered.orderBy(*sorted_by(order)).collect()] == list(range(1, 601))
    for region, size in [(r.region, r["count"]) for r in df.groupBy("region").count().collect()]:
        inside = numbered.filter(F.col("region").eqNullSafe(region)).orderBy(*sorted_by(order)).collect()
        assert [r.g for r in inside] == list(range(1, size + 1))
    assert number_rows(df.limit(0), order, "n", "region", "g").count() == 0


@pytest.mark.parametrize("order", [[("m", False), ("city", True)], [("region", False), ("m", True), ("city", False)]])
def test_rows_between_positions(spark, order):
    df = _stations(spark, 2000)
    whole = [tuple(r) for r in df.orderBy(*sorted_by(order)).collect()]
    for first, last in ((1, 10), (95, 905), (1990, 2100), (2001, 2100)):
        assert [tuple(r) for r in rows_between(df, order, first, last).collect()] == whole[first - 1 : last]


def test_ranges_are_even_and_ties_are_split(spark):
    df = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, 7.0, cast(id % 50 as double)) as m")
    order = [("m", True), ("id", True)]
    sizes = with_range(df, order).groupBy("_range").count().select("count").collect()
    assert len(sizes) > 25 and max(r[0] for r in sizes) < 20_000 / 10


def test_quantiles_from_counts(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice("xy"), rng.choice([None, *[k / 4 for k in range(9)]])) for _ in range(500)] + [("c", "x", 1.0), ("d", "x", None)]
    df = spark.createDataFrame(rows, "city string, part string, t double")
    got = quantiles(value_counts(df, ["city", "part"], "t"), ["city"], "t", {"q": 0.75, "low": 0.1}).collect()
    want = df.filter("t is not null").groupBy("city").agg(F.percentile("t", 0.75).alias("q"), F.percentile("t", 0.1).alias("low")).collect()
    flat = lambda found: {(r.city, c): r[c] for r in found for c in ("q", "low")}
    assert flat(got) == pytest.approx(flat(want)) and len(got) == 3


def test_default_order(spark):
    df = gold.weather_alerts(silver(spark, *[{"date": date(2021, 1, d), "temp_max_c": t} for d, t in [(1, 41.0), (2, 26.0), (2, 36.0)]]))
    ordered = gold.in_default_order(df, "weather_alerts").collect()
    assert [(r.date.day, r.alert_severity) for r in ordered] == [(2, 4), (2, 2), (1, 5)]
    assert gold.in_default_order(df, "climate_profiles") is df
