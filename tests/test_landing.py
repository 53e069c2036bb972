"""Landed files of every format, small and cut into records."""

import json
from collections import Counter

import pytest

from isobar.sources import landing

from rows import plan


def record(day):
    return {"fecha": f"2021-01-{day:02d}", "tmed": f"{day},5"}


def answer(first, last):
    return {"data": [{"date": f"2021-01-{d:02d}", "tavg": d} for d in range(first, last)]}


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    return write


def counted(df):
    return Counter((r.file.rsplit("/")[-1], r.station, r.corrupt is not None) for r in df.collect())


def formats(spark, folder, form, large):
    return {r.file.rsplit("/")[-1]: r.format for r in landing.file_formats(spark, str(folder), form, large).collect()}


@pytest.mark.parametrize("large", [None, 300])
def test_provider_a(spark, tmp_path, put, large):
    big = json.dumps([record(d) for d in range(1, 29)], indent=1)
    put("station=01/a [b].json", json.dumps([record(d) for d in range(1, 4)], indent=1))
    put("station=01/one_line.json", json.dumps([record(d) for d in range(1, 28)]))
    put("station=0%2F2 +/lines {x}.json", "\n".join(json.dumps(record(d)) for d in range(1, 8)) + "\n")
    put("station=02/first_cut.json", json.dumps(record(1))[:25] + "\n" + "\n\n".join(json.dumps(record(d)) for d in (2, 3)))
    put("station=02/two.json", json.dumps(record(1))[:25] + "\n" + json.dumps(record(2)))
    put("station=02/named.jsonl", "[]\n" + json.dumps(record(1)) + "\n" + json.dumps([record(2), record(3)]))
    put("station=03/big.json", big)
    put("station=03/braces.json", json.dumps([{**record(d), "tmed": "}{\"}"} for d in range(1, 20)], indent=1))
    put("station=03/cut.json", big[:700])
    put("station=03/cut_behind_a_record.json", big[: big.rindex("}", 0, 900) + 1] + "\n")
    put("station=04/object.json", json.dumps(record(3), indent=1))
    put("station=04/blank.json", " \n\n")
    put("station=04/none.json", "[]")
    put("station=05/arrays.json", "\n".join(json.dumps([record(d), record(d + 1)]) for d in range(1, 6)))
    put("station=05/mixed.json", "\n".join(["[]", json.dumps(record(1)), json.dumps([record(2), record(3)]), json.dumps(record(4))]))
    put("nowhere.json", json.dumps({**record(1), "station": "9"}))
    got = counted(landing.read_provider_a(spark, str(tmp_path), large=large))
    assert got == {
        ("a%20%5Bb%5D.json", "01", False): 3, ("one_line.json", "01", False): 27, ("lines%20%7Bx%7D.json", "0/2 +", False): 7,
        ("first_cut.json", "02", True): 1, ("first_cut.json", "02", False): 2, ("two.json", "02", True): 1, ("two.json", "02", False): 1,
        ("named.jsonl", "02", False): 3, ("big.json", "03", False): 28, ("braces.json", "03", False): 19,
        ("cut.json", "03", True): 1, ("cut_behind_a_record.json", "03", True): 1, ("object.json", "04", False): 1,
        ("arrays.json", "05", False): 10, ("mixed.json", "05", False): 4, ("nowhere.json", "9", False): 1,
    }
    kinds = formats(spark, tmp_path, landing.PROVIDER_A, large)
    assert kinds["lines%20%7Bx%7D.json"] == kinds["first_cut.json"] == kinds["two.json"] == "lines" and kinds["a%20%5Bb%5D.json"] == "document"
    assert kinds["big.json"] == kinds["braces.json"] == ("large document" if large else "document")


@pytest.mark.parametrize("large", [None, 300])
def test_provider_b(spark, tmp_path, put, large):
    put("station=08181/answer.json", json.dumps(answer(1, 6), indent=1))
    put("station=08181/one_line.json", json.dumps(answer(1, 28)))
    put("lines.json", "\n".join(json.dumps({**answer(d, d + 2), "station": "09"}) for d in range(1, 6)))
    put("rows.json", '{"data": [\n' + ",\n".join(json.dumps(x) for x in answer(1, 28)["data"]) + "\n]}\n")
    put("named.json", json.dumps({**answer(1, 28), "station": "07"}, indent=1))
    put("meta.json", json.dumps({"meta": {"generated": "x"}, **answer(1, 9)}, indent=1))
    put("none.json", '{"data": []}')
    put("array.json", json.dumps([answer(1, 3), answer(3, 5)], indent=1))
    put("cut.json", json.dumps(answer(1, 28), indent=1)[:900])
    got = counted(landing.read_provider_b(spark, str(tmp_path), large=large))
    assert got == {
        ("answer.json", "08181", False): 5, ("one_line.json", "08181", False): 27, ("lines.json", "09", False): 10,
        ("rows.json", None, False): 27, ("named.json", "07", False): 27, ("meta.json", None, False): 8, ("array.json", None, False): 4,
        ("cut.json", None, True): 1,
    }
    days = landing.read_provider_b(spark, str(tmp_path), large=large).filter("date = '2021-01-02'").collect()
    assert len(days) == 8 and {r.tavg for r in days} == {"2"}


def test_large_documents_are_read_in_splits(spark, tmp_path, put):
    put("station=1/x.json", json.dumps([record(1 + d % 28) for d in range(4000)], indent=1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = landing.read_provider_a(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 2 and df.filter("corrupt is null and fecha is not null").count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_empty_folder_has_no_records(spark, tmp_path):
    assert landing.read_provider_a(spark, str(tmp_path)).count() == landing.read_provider_b(spark, str(tmp_path)).count() == 0


def test_formats_are_told_without_sorting_the_pieces(spark, tmp_path, put):
    put("a.json", json.dumps([record(1), record(2)]))
    text = plan(landing.file_formats(spark, str(tmp_path), landing.PROVIDER_A))
    assert "HashAggregate" in text and "SortAggregate" not in text
