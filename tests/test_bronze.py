import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar.operators import bronze
from isobar.operators.backfill import backfill_windows
from isobar.operators.silver import clean
from isobar.schemas import RAW_SCHEMA, SILVER_SCHEMA
from isobar.sources.config import load_settings
from isobar.sources.landing import read_provider_a, read_provider_b, read_station_inventory
from isobar.workspace import materialise, shared_folder

from rows import plan, types


def raw(spark, rows):
    """rows: (day, city, source, tavg)"""
    df = spark.createDataFrame(
        [(date(2021, 1, d), c, s, float(t)) for d, c, s, t in rows], "date date, city string, source string, tavg double"
    )
    return bronze.typed(df)


def keyed(df):
    return sorted((r.date.day, r.city, r.source, r.tavg) for r in df.collect())


def test_provider_a_files(spark, tmp_path):
    records = [
        {"fecha": "2021-01-01", "tmed": "12,5", "tmin": "10", "tmax": "15.0", "prec": "Ip", "dir": "", "velmedia": "2,1",
         "racha": "null", "hrMedia": "80", "indicativo": "x"},
        {"fecha": "2021-01-02", "tmed": "abc", "tmin": "1", "tmax": "2"},
        {"fecha": "2021/01/03", "tmed": "1,0", "tmin": "1", "tmax": "2"},
        {"fecha": "2021-01-04"},
    ]
    folder = tmp_path / "a" / "station=0016A"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text(json.dumps(records, indent=1))
    good, bad = bronze.normalise_provider_a(read_provider_a(spark, str(tmp_path / "a")))
    rows = {r.date.day: r for r in good.collect()}
    assert sorted(rows) == [1, 4]
    assert (rows[1].tavg, rows[1].tmax, rows[1].prcp, rows[1].wdir, rows[1].wspd, rows[1].wpgt) == (
        12.5, 15.0, None, None, 2.1, None,
    )
    assert rows[1].station == "0016A" and rows[4].tavg is None
    assert sorted(r.fecha for r in bad.collect()) == ["2021-01-02", "2021/01/03"]
    full = bronze.typed(bronze.with_lineage(good, "aemet"))
    assert types(full) == types(RAW_SCHEMA)
    assert {(r.pres, r.snow, r.tsun) for r in full.collect()} == {(None, None, None)}


def test_provider_b_files_reject_single_rows(spark, tmp_path):
    data = {"data": [
        {"date": "2021-01-01", "tavg": 1.5, "pres": 1000, "extra": "ignored"},
        {"date": "2021-01-02", "tavg": "warm"},
        {"date": None, "tavg": 2.0},
        {"date": "2021-01-03"},
    ]}
    folder = tmp_path / "b" / "station=08181"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text(json.dumps(data))
    good, bad = bronze.normalise_provider_b(read_provider_b(spark, str(tmp_path / "b")))
    assert sorted((r.date.day, r.tavg, r.pres, r.station) for r in good.collect()) == [
        (1, 1.5, 1000.0, "08181"), (3, None, None, "08181"),
    ]
    assert bad.count() == 2


def test_station_inventory_first_entry_counts(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text(json.dumps([
        {"indicativo": "A", "latitud": "010000N", "longitud": "020000W"},
        {"indicativo": "A", "latitud": "050000N", "longitud": "050000E"},
        {"indicativo": "B", "latitud": "bad", "longitud": "020000W"},
        {"indicativo": "C", "longitud": "020000W"},
    ]))
    inventory = read_station_inventory(spark, str(path))
    found = {r.station: (r.lat, r.lon) for r in bronze.station_coordinates(inventory).collect()}
    assert found == {"A": (1.0, -2.0), "B": (None, -2.0), "C": (None, -2.0)}
    rows = spark.createDataFrame([("A", 9.0, 9.0), ("Z", 9.0, 9.0)], "station string, lat double, lon double")
    placed = bronze.attach_station_coordinates(rows, inventory)
    assert sorted((r.station, r.lat, r.lon) for r in placed.collect()) == [("A", 1.0, -2.0), ("Z", None, None)]


def test_inventory_order_is_that_of_the_files(spark, tmp_path):
    entry = {"latitud": "010000N", "longitud": "020000W"}
    (tmp_path / "0.json").write_text(json.dumps([{"indicativo": i, **entry} for i in ("A", "B")]))
    (tmp_path / "1.json").write_text(json.dumps([{"indicativo": f"C{i:03d}", **entry} for i in range(300)]))
    rows = read_station_inventory(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r.indicativo for r in rows] == ["A", "B", *[f"C{i:03d}" for i in range(300)]]


def test_a_repeated_city_keeps_its_rows_single(spark):
    rows = spark.createDataFrame([("Vic", 1), ("Vic", 2)], "city string, n int")
    cities = spark.createDataFrame(
        [(1, "Vic", 9.0, 9.0), (0, "Vic", 1.0, 2.0)], "pos int, name string, latitude double, longitude double"
    )
    for table, want in ((cities, (1.0, 2.0)), (cities.drop("pos"), (1.0, 2.0))):
        got = bronze.attach_city_coordinates(rows, table).collect()
        assert sorted((r.n, r.lat, r.lon) for r in got) == [(1, *want), (2, *want)]


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, z int")
    got = sorted((r.x or 0, r.y, r.z or 0) for r in bronze.union_all([a, b]).collect())
    assert got == [(0, 3, 4), (1, 2, 0)]


def test_upsert_new_wins_and_is_idempotent(spark):
    old = raw(spark, [(1, "A", "aemet", 1), (2, "A", "aemet", 2)])
    new = raw(spark, [(2, "A", "aemet", 20), (3, "A", "aemet", 30), (2, "A", "meteostat", 5)])
    once = bronze.upsert(old, new)
    want = [(1, "A", "aemet", 1.0), (2, "A", "aemet", 20.0), (2, "A", "meteostat", 5.0), (3, "A", "aemet", 30.0)]
    assert keyed(once) == want
    assert keyed(bronze.upsert(once, new)) == want


def test_upsert_decides_equal_keys_in_one_load_the_same_way(spark):
    new = [(1, "A", "aemet", 7), (1, "A", "aemet", 3), (1, "A", "aemet", 5)]
    empty = raw(spark, new).limit(0)
    assert keyed(bronze.upsert(empty, raw(spark, new))) == keyed(bronze.upsert(empty, raw(spark, new[::-1])))


def test_upsert_leaves_untouched_months_alone(spark):
    days = "date date, city string, source string, tavg double"
    old = [(date(2021, m, 1), "A", "aemet", float(m)) for m in range(1, 6)] + [(None, "A", "aemet", 0.0)]
    new = [(date(2021, 2, 1), "A", "aemet", 20.0), (date(2021, 2, 2), "A", "aemet", 21.0), (None, "A", "aemet", 9.0)]
    existing, incoming = [bronze.typed(spark.createDataFrame(rows, days)) for rows in (old, new)]
    got = {str(r.date): r.tavg for r in bronze.upsert(existing, incoming).collect()}
    assert got == {
        "2021-01-01": 1.0, "2021-02-01": 20.0, "2021-02-02": 21.0, "2021-03-01": 3.0, "2021-04-01": 4.0,
        "2021-05-01": 5.0, "None": 9.0,
    }
    assert bronze.upsert(existing, incoming).count() == 7
    assert bronze.upsert(existing, incoming.limit(0)).count() == 6


def test_nan_becomes_null(spark):
    assert keyed(raw(spark, [(1, "A", "aemet", float("nan"))])) == [(1, "A", "aemet", None)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(3000).selectExpr(
        "date'2021-01-01' as date", "if(id % 3 = 0, 'hot', concat('c', id)) as city", "'aemet' as source", "id as n"
    )
    kept = bronze.newest_per_key(rows, [F.desc("n")])
    assert kept.count() == 2001
    assert kept.filter("city = 'hot'").first().n == 2997


def test_passes_keep_the_same_rows_and_sort_a_share_each(spark):
    rows = spark.range(3000).selectExpr(
        "if(id % 40 = 0, null, date_add(date'2021-01-01', int(id % 40))) as date",
        "if(id % 3 = 0, null, concat('c', id % 7)) as city", "'aemet' as source", "id as n",
    )
    whole, parts = (bronze.newest_per_key(rows, [F.desc("n")], passes=p) for p in (1, 4))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect())) and whole.count() == parts.count() == 40 * 8
    # the share is chosen by the first key alone, before the sort
    stored = materialise(bronze.typed(rows.withColumn("tavg", F.col("n").cast("double"))))
    text = plan(bronze.merge(stored.limit(0), stored))
    assert text.count("pmod(xxhash64(date") >= bronze.KEY_PASSES and bronze.merge(stored.limit(0), stored).count() == 40 * 8


def test_entries_of_a_station_are_counted_not_written_out(spark):
    stations = spark.createDataFrame(
        [("S1", "Vic", "Cataluña"), ("S1", "Vic", "Cataluña"), ("S2", "Vic", "Cataluña"), ("S2", "Sevilla", "Andalucia")],
        "station string, city string, region string",
    )
    rows = spark.createDataFrame(
        [("2021-01-01", "1,5", "S1"), ("2021-01-01", "x", "S1"), ("2021-01-01", "2", "S2"), ("2021-01-01", "2", None)],
        "fecha string, tmed string, station string",
    )
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in bronze.PROVIDER_A_FIELDS.values() if c != "tmed"})
    judged = bronze.judge_provider_a(rows)
    found, written = bronze.staged(judged, "aemet", bronze.station_map(stations)), bronze.staged(judged, "aemet", stations)
    assert sorted((r.station or "", r.city or "", r.copies) for r in found.collect()) == [
        ("", "", 1), ("S1", "Vic", 2), ("S1", "Vic", 2), ("S2", "Sevilla", 1), ("S2", "Vic", 1)
    ]
    assert written.count() == 7
    # what is made of them is the same as if each copy were a row
    for table in (bronze.rejects, bronze.load_report, bronze.city_report):
        assert sorted(map(repr, table(found).collect())) == sorted(map(repr, table(written).collect()))
    assert types(bronze.load_report(found)) == types(bronze.load_report(written))


def test_judging_compiles(spark, tmp_path):
    # the JVM leaves methods of more than 8000 bytes to its interpreter
    (tmp_path / "x.jsonl").write_text("{}\n")
    stations = spark.createDataFrame([("S1", "Vic", "Cataluña")], "station string, city string, region string")
    package = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    for read, judge in ((read_provider_a, bronze.judge_provider_a), (read_provider_b, bronze.judge_provider_b)):
        found = bronze.staged(judge(read(spark, str(tmp_path))), "aemet", stations)
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", False)
        try:
            text = package.codegenString(found.select("*")._jdf.queryExecution().executedPlan())
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000, sizes


def test_city_coordinates_replace_own(spark):
    settings = load_settings(spark)
    rows = spark.createDataFrame([("Vic", 1.0, 1.0), ("Nowhere", 1.0, 1.0)], "city string, lat double, lon double")
    got = {r.city: (r.lat, r.lon) for r in bronze.attach_city_coordinates(rows, settings.cities).collect()}
    assert got == {"Vic": (41.9301, 2.2549), "Nowhere": (None, None)}


def test_settings_files(spark, tmp_path):
    city = {"name": "X", "latitude": 1, "longitude": 2, "elevation": 3, "region": "R"}
    as_json = tmp_path / "c.json"
    as_json.write_text(json.dumps({"cities": [city], "start_date": "2020-01-01", "end_date": "2020-02-01"}))
    settings = load_settings(spark, str(as_json))
    assert settings.cities.first().name == "X" and settings.end_date == "2020-02-01"
    pytest.importorskip("yaml")
    as_yaml = tmp_path / "c.yaml"
    as_yaml.write_text('cities:\n  - {name: Y, latitude: 1, longitude: 2, elevation: 3, region: R}\n'
                       'start_date: "2020-01-01"\nend_date: "2020-02-01"\n')
    assert load_settings(spark, str(as_yaml)).cities.first().name == "Y"
    assert load_settings(spark).cities.count() == 16


def windows(spark, start, end):
    df = spark.createDataFrame([("S", date.fromisoformat(start), date.fromisoformat(end))],
                               "station string, start_date date, end_date date")
    return [(str(r.window_start), str(r.window_end)) for r in backfill_windows(df).orderBy("window_no").collect()]


@pytest.mark.parametrize(
    "start, end, want",
    [
        ("2021-01-10", "2021-07-31", [("2021-01-10", "2021-07-31")]),
        ("2021-01-10", "2021-01-10", [("2021-01-10", "2021-01-10")]),
        ("2021-01-10", "2021-08-05", [("2021-01-10", "2021-06-30"), ("2021-07-01", "2021-08-05")]),
        ("2021-06-15", "2022-01-01", [("2021-06-15", "2021-11-30"), ("2021-12-01", "2022-01-01")]),
        ("2021-01-31", "2022-01-01",
         [("2021-01-31", "2021-06-30"), ("2021-07-01", "2021-12-31"), ("2022-01-01", "2022-01-01")]),
        ("2021-02-01", "2021-01-01", []),
    ],
)
def test_backfill_windows(spark, start, end, want):
    assert windows(spark, start, end) == want


def test_silver_drops_incomplete_rows_and_types_columns(spark):
    base = {"date": date(2021, 3, 4), "city": "A", "tavg": 1.0, "tmin": 0.0, "tmax": 2.0}
    rows = [base] + [{**base, k: None} for k in ("date", "tavg", "tmin", "tmax")] + [{**base, "tavg": 99.0}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "date date, city string, tavg double, tmin double, tmax double")
    silver = clean(bronze.typed(df))
    assert types(silver) == types(SILVER_SCHEMA)
    assert [r.year for r in silver.collect()] == ["2021", "2021"]
    assert clean(bronze.typed(df), check_ranges=True).count() == 1
    assert clean(spark.createDataFrame([], RAW_SCHEMA)).count() == 0


def test_materialise_uses_the_named_folder(spark):
    df = materialise(spark.range(5))
    assert df.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in path for path in df.inputFiles())


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
