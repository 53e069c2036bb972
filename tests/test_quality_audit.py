import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from isobar.operators import trailing
from isobar.plans import quality
from isobar.sources import logs

from rows import one, silver


def test_coverage_extent_and_counts(spark):
    df = silver(spark, {}, {"lat": None}, {"city": "B", "lon": None, "source": "meteostat"}, {"city": "C", "lat": 38.0})
    assert one(quality.coordinate_coverage(df)) == {"total_rows": 4, "with_coordinates": 2, "coverage_pct": 50.0}
    by_city = {r.city: r.coverage_pct for r in quality.coordinate_coverage(df, "city").collect()}
    assert by_city == {"Sevilla": 50.0, "B": 0.0, "C": 100.0}
    assert {(r.city, r.lat_min, r.lat_max) for r in quality.coordinate_extent(df).collect()} == {
        ("Sevilla", 37.0, 37.0), ("C", 38.0, 38.0),
    }
    assert {(r.source, r.source_rows, r.cities) for r in quality.source_counts(df).collect()} == {
        ("aemet", 3, 2), ("meteostat", 1, 1),
    }
    assert quality.station_counts(df).count() == 2


def test_missing_months(spark):
    have = [("A", "2020", 1, 1.0), ("A", "2021", 2, None), ("B", "2020", 1, 1.0)]
    df = spark.createDataFrame(have, "city string, year string, month int, max_temp_month double").withColumns(
        {"min_temp_month": F.lit(1.0), "total_precip_month": F.lit(1.0)}
    )
    missing = {tuple(r) for r in quality.missing_months(df).collect()}
    assert missing == {("A", "2020", 2), ("A", "2021", 1), ("B", "2020", 2), ("B", "2021", 1), ("B", "2021", 2)}
    detail = quality.missing_detail(df).collect()
    # the month that has a row without a measure is part of the answer
    assert {(r.city, r.year, r.month) for r in detail} == missing | {("A", "2021", 2)}
    assert {r.max_temp_month for r in detail} == {None} and {r.min_temp_month for r in detail} == {None, 1.0}
    assert {(r.column_name, r.null_rows) for r in quality.null_counts(df).collect()} == {
        ("max_temp_month", 1), ("min_temp_month", 0), ("total_precip_month", 0),
    }


def test_samples_and_lookup(spark):
    df = silver(spark, *[{"date": date(2021, m, 1), "city": c} for c in ("Zafra", "Sevilla") for m in (3, 1, 2)])
    assert [(r.city, r.date.month) for r in quality.first_rows(df, "aemet").collect()] == [("Sevilla", m) for m in (1, 2, 3)]
    assert quality.first_rows(df, "meteostat").count() == 0
    assert quality.point_lookup(df, "sevilla", 2021, 2).count() == 1


def test_trailing_requests_equal_brute_force(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    # one busy source with a third of the rows at one instant, and steps that hit 60 s exactly
    events = [("a", start + timedelta(seconds=rng.randint(0, 3600))) for _ in range(300)]
    events += [("a", start + timedelta(seconds=660))] * 150 + [("b", start + timedelta(seconds=30 * i)) for i in range(60)]
    df = spark.createDataFrame(events, "source string, ts timestamp_ntz")
    minute = timedelta(seconds=60)
    want = {
        (s, t): (sum(e == (s, t) for e in events), sum(e[0] == s and t - minute <= e[1] <= t for e in events))
        for s, t in set(events)
    }
    got = {(r.source, r.ts): (r.requests, r.trailing_requests) for r in trailing.trailing_requests(df).collect()}
    assert got == want


def test_usage(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("meteostat", start + timedelta(seconds=i)) for i in range(30)], "source string, ts timestamp_ntz"
    )
    used = trailing.usage(df, trailing.source_cap(F.col("source"))).orderBy("ts").collect()
    assert [r.usage_level for r in (used[14], used[15], used[19], used[20])] == ["normal", "moderate", "moderate", "high"]
    assert [r.over_cap for r in (used[24], used[25])] == [False, True]
    assert used[0].usage_pct == 4.0


LINES = """2024-01-01 10:00:00,123 | INFO     | data_manager         | [DB] consulta: t (5 filas) | Context: {"k": "v", "n": 1}
2024-01-01 10:00:01,000 | ERROR    | extract              | run            :42   | [ERROR] Error en x: a | b | Context: {"city": "Vic"}
Traceback (most recent call last):
  File "x", line 1 | not | a | record
2024-01-02 10:00:02,000 | DEBUG    | cache                | put            :7    | [CACHE] limpiar: all
2024-01-02 10:00:03,000 | WARNING  | extract              | plain text without tag""".split("\n")


def test_log_lines(spark, tmp_path):
    path = tmp_path / "x.log"
    path.write_text("\n".join(LINES))
    records = logs.read_logs(spark, str(path)).orderBy("logged_at").collect()
    assert [(r.level, r.logger, r.tag, r.function, r.line) for r in records] == [
        ("INFO", "data_manager", "DB", None, None), ("ERROR", "extract", "ERROR", "run", 42),
        ("DEBUG", "cache", "CACHE", "put", 7), ("WARNING", "extract", None, None, None),
    ]
    assert records[0].message == "[DB] consulta: t (5 filas)" and records[0].context == {"k": "v", "n": "1"}
    assert records[1].message == "[ERROR] Error en x: a | b" and records[1].context == {"city": "Vic"}
    assert records[3].message == "plain text without tag" and records[3].context is None
    assert records[0].logged_at == datetime(2024, 1, 1, 10, 0, 0, 123000)
    per_day = {(str(r.day), r.level, r.tag): r.records for r in logs.records_by_tag(logs.read_logs(spark, str(path))).collect()}
    assert per_day[("2024-01-02", "WARNING", None)] == 1 and len(per_day) == 4
