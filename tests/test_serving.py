from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar.operators import paging
from isobar.operators.filters import Filters, apply_filters
from isobar.plans import charts, gold, maps

from rows import one, silver


@pytest.fixture(scope="module")
def base(spark):
    rows = [
        {"date": date(y, m, 3), "city": c, "region": r, "station": f"S{c}", "temp_avg_c": float(t), "temp_max_c": t + 9.0,
         "temp_min_c": t - 9.0, "precip_mm": float(m * 9 % 31), "lat": 37.0 + i, "lon": -3.0, "source": s}
        for i, (c, r) in enumerate([("L'Hospitalet", "Cataluña"), ("San Roque", "Andalucia"), ("VIC", "Cataluña")])
        for y in (2020, 2021, 2022)
        for m, t in [(1, 0), (4, 15), (8, 30), (11, 12)]
        for s in ("aemet", "meteostat")
    ]
    return silver(spark, *rows)


@pytest.fixture(scope="module")
def summary(base):
    return gold.city_yearly_summary(base)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_filters_combine(summary):
    got = apply_filters(summary, Filters(year="2021", month=[1, "8"], cities=["L'Hospitalet", "VIC"], region="Cataluña"))
    assert {(r.city, r.year, r.month) for r in got.collect()} == {
        (c, "2021", m) for c in ("L'Hospitalet", "VIC") for m in (1, 8)
    }


def test_zero_is_a_bound_and_none_is_not(summary):
    assert apply_filters(summary, Filters(min_temp=0)).count() == summary.count()
    assert apply_filters(summary, Filters(max_temp=0)).count() == 9
    assert apply_filters(summary, Filters()) is summary
    assert apply_filters(summary, Filters(cities=[])) is summary
    assert apply_filters(summary, None) is summary


def test_criteria_a_table_cannot_express_are_skipped(base):
    profiles = gold.climate_profiles(base)
    wanted = Filters(year=2021, month=1, season="Verano", alert_level="ALERTA ROJA", source="AEMET")
    assert apply_filters(profiles, wanted).count() == profiles.count()


def test_season_source_alert_and_dates(base):
    seasonal = gold.seasonal_analysis(base)
    assert {r.month for r in apply_filters(seasonal, Filters(season="Verano")).collect()} == {8}
    alerts = gold.weather_alerts(base)
    picked = apply_filters(
        alerts, Filters(source="Meteostat", alert_level="ALERTA NARANJA", date_range=(date(2021, 1, 1), date(2021, 12, 31)))
    )
    found = picked.collect()
    assert found and {(r.source, r.overall_alert, r.year) for r in found} == {("meteostat", "ALERTA NARANJA", 2021)}
    assert {r.date.month for r in apply_filters(base, Filters(month=4)).collect()} == {4}


def test_pages_join_to_the_sorted_table(summary):
    pages = []
    for number in range(1, 6):
        page = paging.page(summary, "summary", number, 10, sort_by="avg_temp", ascending=False)
        pages += [tuple(r) for r in page.collect()]
    order = [F.desc("avg_temp"), "city", "region", "station", "year", "month"]
    assert pages == [tuple(r) for r in summary.orderBy(*order).collect()]


def test_key_pages_join_to_the_table(summary):
    keys = paging.TABLE_KEYS["summary"]
    found = [tuple(r) for r in paging.page(summary, "summary", 1, 7).collect()]
    while True:
        last = dict(zip(summary.columns, found[-1]))
        more = [tuple(r) for r in paging.page_after(summary, "summary", {k: last[k] for k in keys}, 7).collect()]
        if not more:
            break
        found += more
    assert found == [tuple(r) for r in summary.orderBy(*keys).collect()]


def test_page_errors(summary):
    with pytest.raises(ValueError):
        paging.page(summary, "summary", sort_by="change_percentage")
    with pytest.raises(ValueError):
        paging.page(summary, "summary", number=0)
    assert paging.page(summary, "summary", number=99).count() == 0
    assert paging.sort_columns("trends", summary) == ["city", "year", "month"]


@pytest.mark.parametrize(
    "number, size, want",
    [(1, 10, (4, True, False, 1, 10)), (4, 10, (4, False, True, 31, 36)), (9, 10, (4, False, True, 0, 0)), (1, 36, (1, False, False, 1, 36))],
)
def test_page_metadata(summary, number, size, want):
    row = one(paging.page_metadata(summary, number, size))
    assert (row["total_pages"], row["has_next"], row["has_prev"], row["start_item"], row["end_item"]) == want
    assert (row["current_page"], row["total_items"], row["items_per_page"]) == (number, 36, size)


def test_page_metadata_of_nothing(summary):
    row = one(paging.page_metadata(summary, 1, 10, Filters(cities=["none"])))
    assert (row["total_pages"], row["total_items"], row["start_item"], row["end_item"]) == (0, 0, 0, 0)


def test_display(spark, summary, base):
    shown = paging.display(summary)
    assert shown.columns[:4] == ["Ciudad", "Región", "Año", "Mes"]
    assert [(r["Año"], r["Mes"]) for r in shown.collect()] == sorted((r.year, r.month) for r in summary.collect())
    seasonal = paging.display(gold.seasonal_analysis(base))
    assert {"Estación", "Estación del año"} <= set(seasonal.columns)
    rounded = spark.createDataFrame([("A", 1.23456, 7.23456)], "city string, lat double, total_sunshine double")
    assert tuple(paging.display(rounded).first()) == ("A", 7.23456, 1.23)


def test_table_view(summary):
    rows, about = paging.table_view(summary, "summary", 2, 10, Filters(region="Cataluña"), sort_by="city")
    assert rows.count() == 10 and one(about)["total_items"] == 24 and "Ciudad" in rows.columns


def test_kpis(spark, summary):
    row = one(charts.kpis(summary))
    assert row["avg_temp"] == pytest.approx(57 / 4)
    assert (row["temp_change"], row["precip_change"], row["alert_change"], row["active_alerts"]) == (0.0, 0.0, 0, 0)
    two = spark.createDataFrame(
        [("2020", 10.0, 5.0, None), ("2021", 12.0, None, 40.0), ("2021", 14.0, 8.0, 50.0), ("2019", 99.0, 1.0, 1.0)],
        "year string, avg_temp double, total_precip double, avg_humidity double",
    )
    row = one(charts.kpis(two))
    assert (row["temp_change"], row["precip_change"], row["humidity_change"]) == (3.0, 3.0, None)
    assert row["total_precip"] == 14.0
    single = one(charts.kpis(two.filter("year = 2020")))
    assert (single["temp_change"], single["precip_change"]) == (0.0, 0.0)


def test_kpis_without_columns(base):
    row = one(charts.kpis(gold.weather_alerts(base)))
    assert row["active_alerts"] == gold.weather_alerts(base).filter("overall_alert <> 'Normal'").count()
    assert (row["avg_temp"], row["total_precip"]) == (0.0, 0.0)


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in range(0, 41)] + [(None,)], "x double")
    bins = {r.bin: r for r in charts.histogram(df, "x").collect()}
    assert sorted(bins) == list(range(20)) and sum(b.rows for b in bins.values()) == 41
    assert bins[19].rows == 3 and (bins[0].bin_start, bins[19].bin_end) == (0.0, 40.0)
    flat = charts.histogram(spark.createDataFrame([(5.0,)] * 3, "x double"), "x").collect()
    assert [(r.bin, r.rows) for r in flat] == [(0, 3)]
    assert charts.histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_empty_sums_are_zero_and_empty_keys_are_left_out(spark):
    df = spark.createDataFrame([("2020", None), (None, 5.0)], "year string, total_precip double")
    assert rows_of(charts.precipitation_by_year(df)) == [("2020", 0.0)]


def test_season_radar(spark):
    df = spark.createDataFrame(
        [("Verano", 30.0, 0.0, 40.0), ("Invierno", 10.0, 100.0, 40.0), ("Otoño", 20.0, 50.0, 40.0)],
        "season string, avg_temp_season double, total_precip_season double, avg_humidity_season double",
    )
    assert rows_of(charts.season_radar(df)) == [
        ("Invierno", 0.0, 100.0, None), ("Otoño", 50.0, 50.0, None), ("Verano", 100.0, 0.0, None),
    ]


def test_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "city string")
    assert [tuple(r) for r in charts.value_counts(df, "city").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [r.city for r in charts.value_counts(df, "city", by_value=True).collect()] == ["a", "b", "c"]
    assert [r.city for r in charts.top_alert_cities(df, 2).collect()] == ["b", "a"]


def test_rainy_periods_and_lines(summary):
    assert [tuple(r) for r in charts.rainy_periods(summary).collect()] == [("L'Hospitalet", 12), ("San Roque", 12), ("VIC", 12)]
    assert {r.city for r in charts.temperature_lines(summary, 2).collect()} == {"L'Hospitalet", "San Roque"}


def test_filter_options(summary):
    found = {}
    for r in charts.filter_options(summary, region="Cataluña").collect():
        found.setdefault(r.option, []).append(r.value)
    assert found["cities"] == ["L'Hospitalet", "VIC"] and found["years"] == ["2020", "2021", "2022"]
    assert found["months"] == ["01", "04", "08", "11"] and len(found["seasons"]) == 4 and len(found["alert_levels"]) == 4


def test_every_topic_gives_its_charts(base, summary):
    tables = {
        "summary": summary, "trends": gold.weather_trends(base), "seasonal": gold.seasonal_analysis(base),
        "alerts": gold.weather_alerts(base), "comparison": gold.climate_comparison(base),
    }
    for topic in charts.TOPICS:
        for name, chart in charts.analyse(topic, tables.__getitem__, Filters(cities=["VIC"])).items():
            assert chart.count() > 0, (topic, name)
    assert set(charts.analyse("trends", tables.__getitem__)) == {"temp_by_year", "temp_histogram", "temp_by_city_year"}


def test_maps(spark, base, summary):
    places = spark.createDataFrame(
        [("VIC", 2.0, 9.0), ("VIC", 1.0, 8.0), ("San Roque", 3.0, 7.0)], "city string, lat double, lon double"
    )
    points = maps.temperature_map(summary, places).collect()
    assert {(r.city, r.lat, r.lon) for r in points} == {("VIC", 1.0, 8.0), ("San Roque", 3.0, 7.0)}
    hot = next(r for r in points if r.city == "San Roque" and r.month == 8)
    assert (hot.value, hot.color, hot.radius, hot.label) == (30.0, "red", 10, "San roque: 30.0°C")
    wet = maps.precipitation_map(summary.withColumn("total_precip", F.lit(None).cast("double")), places).first()
    assert (wet.color, wet.radius, wet.label.split(": ")[1]) == ("gray", 5, "N/A mm")
    warned = maps.alert_map(gold.weather_alerts(base), places).first()
    assert warned.radius == 8 + 2 * warned.alert_severity
    compared = maps.comparison_map(gold.climate_comparison(base), places)
    assert compared.count() == 2 and compared.first().label.endswith(compared.first().climate_classification)


def test_map_columns(summary):
    assert maps.map_columns(summary, "alerts").columns == ["city", "lat", "lon"]
    assert maps.map_columns(summary, "other").columns == summary.columns
