import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from isobar.__main__ import nearest_of_cities
from isobar.operators import bronze
from isobar.plans import jobs
from isobar.plans.gold import GOLD_TABLES
from isobar.schemas import GOLD_SCHEMAS, SILVER_SCHEMA
from isobar.sources import catalog, months, rawstore, sinks
from isobar.sources.config import load_settings
from isobar.streaming import ingest

from rows import types

STATIONS = [("A1", "Sevilla", "Andalucia"), ("B2", "Vic", "Cataluña")]


@pytest.fixture
def clean_catalog(spark):
    jobs.clean_layers(spark)
    spark.sql("DROP DATABASE IF EXISTS bronze CASCADE")
    yield
    jobs.clean_layers(spark)
    spark.sql("DROP DATABASE IF EXISTS bronze CASCADE")


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(STATIONS, "station string, city string, region string")


def land_a(folder, station, days, temp, name="x"):
    target = folder / "provider=a" / f"station={station}"
    target.mkdir(parents=True, exist_ok=True)
    records = [
        {"fecha": f"2021-{m:02d}-{d:02d}", "tmed": f"{temp},5", "tmin": f"{temp - 4}", "tmax": f"{temp + 20}", "prec": "Ip"}
        for m, d in days
    ]
    (target / f"{name}.json").write_text(json.dumps(records))


def land_b(folder, station, days, temp):
    target = folder / "provider=b" / f"station={station}"
    target.mkdir(parents=True, exist_ok=True)
    rows = [
        {"date": f"2021-{m:02d}-{d:02d}", "tavg": temp, "tmin": temp - 3, "tmax": temp + 3, "prcp": 12.0, "pres": 1001.0}
        for m, d in days
    ]
    (target / "x.json").write_text(json.dumps({"data": rows}))


def landing(folder):
    return {"aemet": str(folder / "provider=a"), "meteostat": str(folder / "provider=b")}


def statuses(report):
    return {r.name: r.status for r in report.collect()}


def test_end_to_end(spark, tmp_path, stations, clean_catalog):
    land_a(tmp_path, "A1", [(1, 1), (1, 2), (7, 1)], 10)
    land_b(tmp_path, "B2", [(1, 1), (2, 1)], 5.0)
    cities = load_settings(spark).cities
    report = jobs.run(spark, ["bronze", "silver", "gold"], landing(tmp_path), cities, stations, clean_first=True)
    assert set(statuses(report).values()) == {"ok"}, report.filter("status <> 'ok'").collect()
    assert {r.name: r.row_count for r in report.filter("layer = 'bronze'").collect()} == {
        "aemet": 3, "meteostat": 2, "weather_raw.weather_data": 5,
    }
    silver = jobs.silver_table(spark)
    assert types(silver) == types(SILVER_SCHEMA) and silver.count() == 5
    assert {(r.city, r.region, r.lat) for r in silver.collect()} == {
        ("Sevilla", "Andalucia", 37.3886), ("Vic", "Cataluña", 41.9301),
    }
    for name, schema in GOLD_SCHEMAS.items():
        assert types(spark.table(f"gold.{name}")) == types(schema), name
    assert {r.table_name for r in catalog.layer_row_counts(spark, "gold").collect()} == set(GOLD_TABLES)
    assert spark.table("snapshots.weather_cleaned_snapshot").count() == 5
    assert catalog.table(spark, "summary").count() == 4
    assert catalog.table(spark, "coords").count() == 2
    with pytest.raises(ValueError):
        catalog.table(spark, "other")
    columns = catalog.listing(spark).filter("database = 'gold' and table = 'weather_trends'")
    assert [r.column for r in columns.collect()] == ["city", "year", "avg_temp", "total_precip"]
    assert not [d for d in catalog.databases(spark) if d.endswith("_staging")]

    # a second load changes one day and adds one; the older version stays as it was
    first = catalog.newest_raw_version(spark)
    land_a(tmp_path, "A1", [(1, 2), (9, 9)], 30)
    jobs.run(spark, ["bronze"], landing(tmp_path), cities, stations)
    second = catalog.newest_raw_version(spark)
    assert second > first and spark.table(f"{first}.weather_data").count() == 5
    raw = spark.table("weather_raw.weather_data")
    assert raw.count() == 6
    assert {str(r.date): r.tavg for r in raw.filter("city = 'Sevilla'").collect()} == {
        "2021-01-01": 10.5, "2021-01-02": 30.5, "2021-07-01": 10.5, "2021-09-09": 30.5,
    }


def test_no_row_is_lost_without_a_record(spark, tmp_path, clean_catalog):
    stations = spark.createDataFrame(
        [("aemet", "A1", "Sevilla", "Andalucia"), ("meteostat", "A1", "Vic", "Cataluña"), (None, "B2", "Vic", "Cataluña")],
        "source string, station string, city string, region string",
    )
    land_a(tmp_path, "A1", [(1, 1), (1, 2), (1, 2)], 10)
    bad = [{"fecha": "2021-01-03", "tmed": "abc"}, {"fecha": "2021/01/04", "tmed": "1"}]
    (tmp_path / "provider=a" / "station=A1" / "bad.json").write_text(json.dumps(bad))
    for station in ("A1", "B2", "X8", "X9"):
        land_b(tmp_path, station, [(1, 1), (1, 2), (1, 3)], 5.0)
    (tmp_path / "provider=b" / "station=B2" / "cut.json").write_text('{"data": [{"date": "2021-01-01", "tavg": 1.0')
    (tmp_path / "provider=b" / "station=B2" / "none.json").write_text('{"data": []}')
    report = jobs.load_bronze(spark, landing(tmp_path), load_settings(spark).cities, stations)
    assert set(statuses(report).values()) == {"ok"}, report.collect()
    version = catalog.newest_raw_version(spark)
    found = {r.source: r.asDict() for r in spark.table(f"{version}.load_report").collect()}
    assert found == {
        "aemet": {"source": "aemet", "read_rows": 5, "kept_rows": 2, "merged_rows": 1, "rejected_rows": 2, "unmatched_rows": 0},
        "meteostat": {"source": "meteostat", "read_rows": 13, "kept_rows": 3, "merged_rows": 3, "rejected_rows": 1, "unmatched_rows": 6},
    }
    raw = spark.table("weather_raw.weather_data")
    assert raw.count() == 5 and raw.filter("city is null").count() == 0
    kept_away = spark.table(f"{version}.load_rejects").collect()
    assert sorted((r.source, r.station, r.reason) for r in kept_away) == sorted(
        [("aemet", "A1", "bad date"), ("aemet", "A1", "bad number"), ("meteostat", "B2", "corrupt record")]
        + [("meteostat", s, "unknown station") for s in ("X8", "X9") for _ in range(3)]
    )
    assert all(r.file.endswith(".json") and r.record for r in kept_away)
    assert {(r.source, r.city, r.loaded_rows) for r in spark.table(f"{version}.load_cities").collect()} == {
        ("aemet", "Sevilla", 3), ("meteostat", "Vic", 6),
    }


def test_repeated_entries_of_the_station_map_are_staged_once(spark, tmp_path, stations, clean_catalog, monkeypatch):
    land_a(tmp_path, "A1", [(1, 1), (1, 2)], 10)
    land_b(tmp_path, "B2", [(1, 1), (1, 2), (1, 3)], 5.0)
    staged = []
    monkeypatch.setattr(jobs, "accepted", lambda rows: staged.append(rows.count()) or bronze.accepted(rows))
    thrice = stations.union(stations).union(stations)
    made = jobs.load_bronze(spark, landing(tmp_path), load_settings(spark).cities, thrice).collect()
    assert staged == [5]
    assert {r.name: r.row_count for r in made} == {"aemet": 6, "meteostat": 9, "weather_raw.weather_data": 5}
    report = spark.table(f"{catalog.newest_raw_version(spark)}.load_report").collect()
    assert {r.source: (r.read_rows, r.kept_rows, r.merged_rows) for r in report} == {"aemet": (6, 2, 4), "meteostat": (9, 3, 6)}


def test_a_failing_source_is_reported_and_the_rest_loads(spark, tmp_path, stations, clean_catalog):
    land_a(tmp_path, "A1", [(1, 1)], 10)
    report = jobs.load_bronze(spark, landing(tmp_path), load_settings(spark).cities, stations)
    assert statuses(report) == {"aemet": "ok", "meteostat": "failed", "weather_raw.weather_data": "ok"}
    assert spark.table("weather_raw.weather_data").count() == 1


def test_no_source_at_all(spark, tmp_path, stations, clean_catalog):
    report = jobs.load_bronze(spark, landing(tmp_path), load_settings(spark).cities, stations)
    assert statuses(report)["weather_raw.weather_data"] == "failed"
    silver = jobs.build_silver(spark)
    assert statuses(silver) == {"silver.weather_cleaned": "ok"} and jobs.silver_table(spark).count() == 0
    with pytest.raises(ValueError):
        jobs.run(spark, ["platinum"])


def test_steps_run_in_name_order(spark):
    seen = []

    def step(name, fail=False):
        def run():
            seen.append(name)
            if fail:
                raise RuntimeError("broken")
            return 7

        return run

    report = jobs.run_steps(spark, {"b": step("b"), "a": step("a", fail=True), "c": step("c")}).collect()
    assert seen == ["a", "b", "c"]
    assert [(r.name, r.status, r.row_count, r.error) for r in report] == [
        ("a", "failed", None, "broken"), ("b", "ok", 7, None), ("c", "ok", 7, None),
    ]


def test_raw_tables_are_found(spark, clean_catalog):
    assert catalog.raw_observations(spark).count() == 0
    assert catalog.layer_row_counts(spark, "weather_raw", "bronze").count() == 0
    df = spark.createDataFrame([("A", 1.0)], "city string, tavg double")
    for name in ("one", "two"):
        sinks.replace_table(df, f"bronze.{name}")
    assert catalog.raw_observations(spark).count() == 2
    assert catalog.layer_row_counts(spark, "weather_raw", "bronze").count() == 2
    sinks.replace_table(df, "weather_raw.Weather_Data_x")
    sinks.replace_table(df, "weather_raw.other")
    assert catalog.raw_observations(spark).count() == 1


def days(spark, rows):
    """rows: (month, day, city, tavg)"""
    df = spark.createDataFrame(
        [(date(2021, m, d) if m else None, c, "aemet", float(t)) for m, d, c, t in rows], "date date, city string, source string, tavg double"
    )
    return bronze.typed(df)


def test_versions(spark, clean_catalog):
    assert catalog.newest_raw_version(spark) is None
    for name in ("weather_raw_20240101", "weather_raw_20240301"):
        rawstore.store_load(days(spark, [(1, 1, "A", 1)]), name)
    for unfinished in ("weather_raw_20240501_staging", "weather_raw_20240601"):
        spark.sql(f"CREATE DATABASE {unfinished}")
    assert catalog.newest_raw_version(spark) == "weather_raw_20240301"
    with pytest.raises(ValueError):
        rawstore.store_load(days(spark, [(1, 1, "A", 1)]), "weather_raw_20240301")
    with pytest.raises(ValueError):
        sinks.drop_layers(spark, ["default"])


def held(spark, version):
    rows = spark.table(f"{version}.weather_data").collect()
    return sorted(((r.date.month, r.date.day) if r.date else (0, 0), r.city, r.tavg) for r in rows)


def test_a_load_reads_and_writes_only_its_months(spark, clean_catalog, monkeypatch):
    first = [(m, d, c, m) for m in (1, 2, 7) for d in (1, 2) for c in "AB"] + [(0, 0, "A", 0)]
    one = rawstore.store_load(days(spark, first), "weather_raw_1")
    read = []
    whole = rawstore.merge
    monkeypatch.setattr(rawstore, "merge", lambda old, new: read.extend(old.inputFiles()) or whole(old, new))
    two = rawstore.store_load(days(spark, [(2, 2, "A", 20), (2, 3, "A", 30)]), "weather_raw_2", one)
    assert read and all(f"{one}/ym=2021-02/" in f for f in read)
    listed = {r.ym: (r.written_by, r.row_count) for r in rawstore.manifest(spark, two).collect()}
    assert listed == {"2021-01": (one, 4), "2021-02": (two, 5), "2021-07": (one, 4), "none": (one, 1)}
    root = months.folder_of(spark, rawstore.LAYOUT, two).removeprefix("file:")
    assert sorted(p.name for p in Path(root).iterdir() if p.is_dir()) == ["ym=2021-02"]
    assert held(spark, two) == sorted(
        [((m, d), c, float(m)) for m in (1, 2, 7) for d in (1, 2) for c in "AB" if (m, d, c) != (2, 2, "A")]
        + [((0, 0), "A", 0.0), ((2, 2), "A", 20.0), ((2, 3), "A", 30.0)]
    )
    assert len(held(spark, one)) == 13 and (2, 3) not in {k for k, *_ in held(spark, one)}
    assert months.row_count(spark, f"{two}.weather_data") == 14
    # rows without a date are a month of their own; the same load again changes nothing
    again = rawstore.store_load(days(spark, [(2, 2, "A", 20), (2, 3, "A", 30)]), "weather_raw_3", two)
    assert held(spark, again) == held(spark, two)
    nothing = rawstore.store_load(days(spark, []).limit(0), "weather_raw_4", again)
    assert held(spark, nothing) == held(spark, two)
    assert spark.table(f"{two}.weather_data").filter("ym = '2021-07'").inputFiles()[0].count(f"{one}/ym=2021-07") == 1
    for old in (one, again):
        spark.sql(f"DROP DATABASE {old} CASCADE")
    assert held(spark, two) == held(spark, nothing)
    assert [r.folder for r in rawstore.unused_folders(spark).collect()] == ["weather_raw_1/ym=2021-02"]


def test_a_merge_equals_the_upsert(spark, clean_catalog):
    old = days(spark, [(m, d, c, m + d) for m in (1, 2, 3) for d in (1, 2, 3) for c in "AB"])
    new = days(spark, [(2, d, c, 50 + d) for d in (3, 4) for c in "BC"] + [(4, 1, "A", 1), (4, 1, "A", 2)])
    version = rawstore.store_load(new, None, rawstore.store_load(old))
    want = bronze.upsert(old, new).collect()
    assert held(spark, version) == sorted(((r.date.month, r.date.day), r.city, r.tavg) for r in want)


def test_publishing_writes_no_second_copy(spark, tmp_path, stations, clean_catalog):
    land_a(tmp_path, "A1", [(1, 1), (7, 1)], 10)
    jobs.load_bronze(spark, {"aemet": str(tmp_path / "provider=a")}, load_settings(spark).cities, stations)
    assert spark.catalog.getTable("weather_raw.weather_data").tableType == "VIEW"
    version = catalog.newest_raw_version(spark)
    shown = spark.table("weather_raw.weather_data")
    assert all("/raw_months.db/" in f or f"/{version}.db/load_places" in f for f in shown.inputFiles())
    assert [(str(r.date), r.lat, r.lon) for r in shown.orderBy("date").collect()] == [
        ("2021-01-01", 37.3886, -5.9823), ("2021-07-01", 37.3886, -5.9823),
    ]


def test_a_failed_build_leaves_the_old_rows(spark, clean_catalog):
    good = spark.createDataFrame([(1, "2021"), (2, "2022")], "x int, year string")
    sinks.replace_table(good, "gold.numbers", "year")
    broken = good.withColumn("x", F.when(F.col("x") == 1, F.col("x")).otherwise(F.raise_error("broken").cast("int")))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(broken, "gold.numbers", "year")
    assert sorted(r.x for r in spark.table("gold.numbers").collect()) == [1, 2]
    reader = spark.table("gold.numbers")
    sinks.replace_table(good.filter("x = 1"), "gold.numbers", "year")
    assert [r.x for r in spark.table("gold.numbers").collect()] == [1]
    assert sorted(r.x for r in reader.collect()) == [1, 2]  # a reader of the version before goes on
    for n in (3, 4):
        sinks.replace_table(good.filter(f"x < {n - 2}"), "gold.numbers", "year")
    assert len(catalog.stored_versions(spark, "gold", "numbers")) == 2
    assert catalog.tables(spark, "gold") == ["numbers"]
    # a plain table of the name, as older releases wrote, is taken over
    good.write.saveAsTable("gold.plain")
    sinks.replace_table(good, "gold.plain")
    assert spark.table("gold.plain").count() == 2


def test_a_table_may_be_rebuilt_from_itself(spark, clean_catalog):
    sinks.replace_table(spark.range(3), "gold.self")
    sinks.replace_table(spark.table("gold.self").selectExpr("id + 1 as id"), "gold.self")
    assert sorted(r.id for r in spark.table("gold.self").collect()) == [1, 2, 3]


def test_every_record_of_mixed_formats_is_loaded(spark, tmp_path, clean_catalog):
    stations = spark.createDataFrame(STATIONS + [("C3", "Vic", "Cataluña")], "station string, city string, region string")
    land_a(tmp_path, "A1", [(1, d) for d in range(1, 6)], 10)
    a = tmp_path / "provider=a" / "station=A1"
    lines = [json.dumps({"fecha": f"2021-02-{d:02d}", "tmed": f"{d},5"}) for d in range(1, 8)]
    (a / "lines.json").write_text("\n".join(lines))
    (a / "more.jsonl").write_text("\n".join(x.replace("-02-", "-03-") for x in lines) + "\n\n")
    (a / "cut.json").write_text("\n".join([lines[0].replace("-02-", "-04-"), lines[1][:15], lines[2].replace("-02-", "-04-")]))
    land_b(tmp_path, "B2", [(1, d) for d in range(1, 4)], 5.0)
    b = tmp_path / "provider=b"
    one = [{"data": [{"date": f"2021-05-{d:02d}", "tavg": d}], "station": "C3"} for d in range(1, 10)]
    (b / "lines.json").write_text("\n".join(map(json.dumps, one)))
    (b / "station=C3").mkdir()
    (b / "station=C3" / "array.json").write_text(json.dumps([{"data": [{"date": f"2021-06-{d:02d}"}]} for d in (1, 2)], indent=1))
    report = jobs.load_bronze(spark, landing(tmp_path), load_settings(spark).cities, stations)
    assert set(statuses(report).values()) == {"ok"}, report.collect()
    version = catalog.newest_raw_version(spark)
    found = {r.source: (r.read_rows, r.kept_rows, r.rejected_rows) for r in spark.table(f"{version}.load_report").collect()}
    assert found == {"aemet": (5 + 7 + 7 + 3, 21, 1), "meteostat": (3 + 9 + 2, 14, 0)}
    assert spark.table("weather_raw.weather_data").count() == 35 == months.row_count(spark, f"{version}.weather_data")
    rejected = spark.table(f"{version}.load_rejects").collect()
    assert [(r.reason, r.file.rsplit("/")[-1]) for r in rejected] == [("corrupt record", "cut.json")]


def stored(spark, names):
    return {n: sorted(map(repr, (tuple(r) for r in spark.table(f"gold.{n}").drop("ingestion_date").collect()))) for n in names}


def test_a_load_refreshes_only_its_months(spark, tmp_path, stations, clean_catalog, monkeypatch):
    cities = load_settings(spark).cities
    land_a(tmp_path, "A1", [(m, d) for m in (1, 2, 7) for d in (1, 2, 3)], 10)
    land_b(tmp_path, "B2", [(1, 1), (2, 1), (8, 1)], 35.0)
    first = jobs.run(spark, ["bronze", "silver", "gold"], landing(tmp_path), cities, stations)
    assert set(statuses(first).values()) == {"ok"}, first.filter("status <> 'ok'").collect()
    land_a(tmp_path, "A1", [(2, 3), (2, 4), (9, 1)], 30, "later")
    (tmp_path / "provider=a" / "station=A1" / "x.json").write_text("[]")
    (tmp_path / "provider=b" / "station=B2" / "x.json").write_text('{"data": []}')
    cleaned, summed = [], []
    clean, sum_up = jobs.clean, jobs.station_months
    monkeypatch.setattr(jobs, "clean", lambda raw: cleaned.extend(months.months_in(raw)) or clean(raw))
    monkeypatch.setattr(jobs, "station_months", lambda silver: summed.extend(months.months_in(silver)) or sum_up(silver))
    second = jobs.run(spark, ["bronze", "silver", "gold"], landing(tmp_path), cities, stations)
    assert set(statuses(second).values()) == {"ok"}, second.filter("status <> 'ok'").collect()
    assert cleaned == summed == ["2021-02", "2021-09"]
    incremental = stored(spark, GOLD_TABLES)
    silver = jobs.silver_table(spark)
    assert silver.count() == 14 and months.row_count(spark, "silver.weather_cleaned") == 14
    assert {r.table_name: r.row_count for r in catalog.layer_row_counts(spark, "gold").collect()} == {
        n: spark.table(f"gold.{n}").count() for n in GOLD_TABLES
    }
    for name in GOLD_TABLES:
        want = GOLD_TABLES[name](silver).drop("ingestion_date").collect()
        assert incremental[name] == sorted(map(repr, (tuple(r) for r in want))), name
    # nothing landed: nothing is made
    jobs.build_silver(spark), jobs.build_gold(spark)
    assert cleaned == summed == ["2021-02", "2021-09"]
    # other coordinates change every month
    moved = cities.withColumn("latitude", F.col("latitude") + 1)
    jobs.run(spark, ["bronze", "silver"], landing(tmp_path), moved, stations)
    assert len(cleaned) == 2 + 5 and {r.lat for r in jobs.silver_table(spark).filter("city = 'Vic'").collect()} == {42.9301}
    folders = spark.table("silver.weather_cleaned").inputFiles()
    assert all("year=2021/ym=2021-" in f for f in folders)


def test_only_lines(spark, tmp_path, stations, clean_catalog):
    folder = tmp_path / "provider=a" / "station=A1"
    folder.mkdir(parents=True)
    records = [json.dumps({"fecha": f"2021-01-{d:02d}", "tmed": "1,5"}) for d in range(1, 6)]
    for name, ending in (("x.json", ""), ("y.ndjson", "\n")):
        (folder / name).write_text("\n".join(records) + ending)
        records = [r.replace("-01-", "-02-") for r in records]
    jobs.load_bronze(spark, {"aemet": str(tmp_path / "provider=a")}, load_settings(spark).cities, stations)
    assert spark.table("weather_raw.weather_data").count() == 10


def test_file_sinks(spark, tmp_path):
    df = spark.createDataFrame([("San Roque", 1.5), ("Vic", 2.5), ("Córdoba", None)], "city string, tavg double")
    sinks.write_by_city(df, str(tmp_path / "by_city"))
    assert {p.name for p in (tmp_path / "by_city").iterdir() if p.is_dir()} == {
        "city_slug=san_roque", "city_slug=vic", "city_slug=c%C3%B3rdoba",
    } or (tmp_path / "by_city" / "city_slug=san_roque").is_dir()
    assert spark.read.parquet(str(tmp_path / "by_city")).count() == 3
    sinks.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["city", "tavg"] and back.filter("city = 'Córdoba' and tavg is null").count() == 1


def test_streamed_files_equal_the_batch(spark, tmp_path, stations, clean_catalog):
    def land(name, days, temp):
        target = tmp_path / "in" / "station=A1"
        target.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({"fecha": f"2021-01-{d:02d}", "tmed": f"{temp},5", "tmin": "1", "tmax": "2"}) for d in days]
        (target / name).write_text("\n".join(lines))

    land("1.json", [1, 2], 10)
    stream = ingest.provider_a_stream(spark, str(tmp_path / "in"), stations)
    ingest.ingest(stream, str(tmp_path / "cp")).awaitTermination(120)
    land("2.json", [2, 3], 20)
    ingest.ingest(stream, str(tmp_path / "cp")).awaitTermination(120)
    stored = spark.table(f"{catalog.newest_raw_version(spark)}.weather_data")
    assert {r.date.day: r.tavg for r in stored.collect()} == {1: 10.5, 2: 20.5, 3: 20.5}
    assert {(r.city, r.source) for r in stored.collect()} == {("Sevilla", "aemet")}


def test_cities_take_their_nearest_station(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text(json.dumps([
        {"indicativo": "S", "latitud": "372500N", "longitud": "055800W"},
        {"indicativo": "B", "latitud": "412300N", "longitud": "021000E"},
    ]))
    got = {r.city: r.station for r in nearest_of_cities(spark, str(path), load_settings(spark).cities).collect()}
    assert got["Sevilla"] == "S" and got["Barcelona"] == "B" and len(got) == 16
