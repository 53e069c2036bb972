"""Raw layer: normalise provider rows, combine, de-duplicate, attach coordinates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import dms_to_decimal, is_bad_number, iso_date, number_text
from ..schemas import MEASURES, RAW_KEY, RAW_SCHEMA, conform

# --- Fixed values: provider A field of each measure (it reports no pres, snow, tsun) ---
PROVIDER_A_FIELDS = {
    "tavg": "tmed",
    "tmin": "tmin",
    "tmax": "tmax",
    "prcp": "prec",
    "wdir": "dir",
    "wspd": "velmedia",
    "wpgt": "racha",
    "rhum": "hrMedia",
}


#: Passes in which stored rows are cut to one a key.
KEY_PASSES = 4

#: Why a landed row is not loaded.
CORRUPT, BAD_DATE, BAD_NUMBER, UNKNOWN_STATION = "corrupt record", "bad date", "bad number", "unknown station"


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name (O1, O2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _judged(rows: DataFrame, date: Column, parsed: dict[str, Column], bad: Callable[[str], Column], fields: list[str]) -> DataFrame:
    """Typed rows in one pass, each with the reason it is rejected for and then its record as text.

    Values, reason and record are projections of their own: each is worked out once a row, and no
    generated method grows past what the JVM compiles (8000 bytes of code).
    """
    corrupt = F.col("corrupt") if "corrupt" in rows.columns else F.lit(None).cast("string")
    passed = [c for c in rows.columns if c in ("station", "city", "region", "file")]
    values = rows.select(
        date.alias("_date"), *[v.alias(f"_{m}") for m, v in parsed.items()], *passed, corrupt.alias("_corrupt"),
        F.struct(*fields).alias("_landed"),
    )
    wrong = reduce(lambda a, b: a | b, [F.coalesce(bad(m), F.lit(False)) for m in parsed])
    reason = (
        F.when(F.col("_corrupt").isNotNull(), CORRUPT).when(F.col("_date").isNull(), BAD_DATE).when(wrong, BAD_NUMBER)
    )
    reasoned = values.withColumn("reason", reason)
    record = F.when(F.col("reason").isNotNull(), F.coalesce("_corrupt", F.to_json("_landed")))
    return reasoned.select(
        F.col("_date").alias("date"), *[F.col(f"_{m}").alias(m) for m in parsed], *passed,
        "reason", record.alias("record"), "_landed",
    )


def judge_provider_a(rows: DataFrame) -> DataFrame:
    """Text rows of provider A as typed rows with ``reason`` and ``record`` of rejected ones.

    A row is rejected when its record, its date or any of its numbers does not parse.
    """
    # one function over the list of texts: eight copies of it would be too much code for one method
    numbers = rows.withColumn("_numbers", F.transform(F.array(*PROVIDER_A_FIELDS.values()), number_text))
    values = {measure: F.col("_numbers")[at] for at, measure in enumerate(PROVIDER_A_FIELDS)}
    bad = lambda m: is_bad_number(F.col("_landed")[PROVIDER_A_FIELDS[m]], F.col(f"_{m}"))
    return _judged(numbers, iso_date(F.col("fecha")), values, bad, ["fecha", *PROVIDER_A_FIELDS.values()])


def judge_provider_b(rows: DataFrame) -> DataFrame:
    """Rows of provider B checked one by one, as for provider A."""
    texts = {m: F.col(m).cast("string") for m in MEASURES if m in rows.columns}
    parsed = {m: t.try_cast("double") for m, t in texts.items()}
    bad = lambda m: F.col("_landed")[m].isNotNull() & F.col(f"_{m}").isNull()
    return _judged(rows, iso_date(F.col("date").cast("string")), parsed, bad, ["date", *texts])


def _split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    extra = [c for c in ("station", "file") if c in judged.columns]
    good = judged.filter(F.col("reason").isNull()).drop("reason", "record", "_landed", "file")
    return good, judged.filter(F.col("reason").isNotNull()).select("_landed.*", *extra, "reason")


def normalise_provider_a(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed raw rows of provider A, and the rejected rows with station, file and reason."""
    return _split(judge_provider_a(rows))


def normalise_provider_b(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed raw rows of provider B, and the rejected rows with station, file and reason."""
    return _split(judge_provider_b(rows))


def station_map(stations: DataFrame) -> DataFrame:
    """The providers' station map, a repeated place once with its number of ``copies``.

    Each entry of a station gives it its rows once more; counted, they need not be written out.
    """
    return stations.groupBy(*[c for c in ("station", "city", "region", "source") if c in stations.columns]).agg(
        F.count("*").alias("copies")
    )


def with_lineage(rows: DataFrame, source: str, stations: DataFrame | None = None) -> DataFrame:
    """Tag rows with their source and, by station, their city and region.

    Rows of a station that ``stations`` lacks have no city: keep them out of the keyed tables
    (``staged``).  ``stations`` may have a column ``source``, as each provider has stations of
    its own; null there means any.  A station of several cities gives each of them its rows; of a
    ``station_map`` the rows get ``copies``.  Pass a stored table, so that its size decides whether
    the rows are shuffled at all.
    """
    tagged = rows.withColumn("source", F.lit(source))
    if stations is None:
        return tagged
    if "source" in stations.columns:
        stations = stations.filter(F.coalesce("source", F.lit(source)) == source)
    places = [c for c in ("station", "city", "region", "copies") if c in stations.columns]
    return tagged.drop("city", "region").join(stations.select(*places), "station", "left")


def staged(judged: DataFrame, source: str, stations: DataFrame | None = None) -> DataFrame:
    """Every landed row of a source, typed, with the reason of those that cannot be loaded.

    Besides what the judging step rejects, these are the rows without a city: a city is part of
    the key, and rows of all unknown stations would count as one city's.  ``copies``: for how many
    rows one stands, by the station map.
    """
    rows = with_lineage(judged.drop("_landed"), source, stations)
    extra = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in ("file", "record", "copies")}
    rows = rows.withColumns(extra) if "city" in rows.columns else rows.withColumns({**extra, "city": F.lit(None).cast("string")})
    reason = F.coalesce("reason", F.when(F.col("city").isNull(), UNKNOWN_STATION)).alias("reason")
    record = F.coalesce("record", F.when(F.col("city").isNull(), F.to_json(F.struct("date", *MEASURES)))).alias("record")
    clean = typed(rows.withColumns({m: F.lit(None).cast("double") for m in MEASURES if m not in rows.columns}), "file", "reason", "record", "copies")
    copies = F.coalesce(F.col("copies").cast("long"), F.lit(1).cast("long"))
    return clean.withColumns({"reason": reason, "record": record, "copies": copies})


def accepted(rows: DataFrame) -> DataFrame:
    """The staged rows that can be loaded, copies once: they share a key, of which the merge keeps one row."""
    return conform(rows.filter(F.col("reason").isNull()), RAW_SCHEMA)


def rejects(rows: DataFrame) -> DataFrame:
    """The staged rows that cannot be loaded, every copy: source, station, file, reason and record."""
    columns = ["source", "station", "file", "reason", "record"]
    every = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy")
    return rows.filter(F.col("reason").isNotNull()).select(*columns, every).select(*columns)


def load_report(rows: DataFrame) -> DataFrame:
    """What became of the staged rows of each source; read = kept + merged + rejected + unmatched.

    Merged rows share date, city and source with a kept one.
    """
    keyed = rows.groupBy("source", "date", "city", F.col("reason").alias("why")).agg(F.sum("copies").alias("n"))
    loaded, unknown = F.col("why").isNull(), F.col("why").eqNullSafe(UNKNOWN_STATION)
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return keyed.groupBy("source").agg(
        F.sum("n").alias("read_rows"),
        F.count_if(loaded).alias("kept_rows"),
        (count(loaded) - F.count_if(loaded)).alias("merged_rows"),
        count(~loaded & ~unknown).alias("rejected_rows"),
        count(unknown).alias("unmatched_rows"),
    )


def city_report(rows: DataFrame) -> DataFrame:
    """Loaded days of each source and city, for the count of cities a load reached."""
    loaded = rows.filter(F.col("reason").isNull())
    return loaded.groupBy("source", "city").agg(
        F.sum("copies").alias("loaded_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )


def typed(rows: DataFrame, *texts: str) -> DataFrame:
    """Raw schema, and the named text columns, with NaN measures turned into NULL."""
    clean = {m: F.nullif(F.col(m), F.lit(float("nan"))) for m in [*MEASURES, "lat", "lon"]}
    schema = T.StructType([*RAW_SCHEMA.fields, *[T.StructField(t, T.StringType()) for t in texts]])
    return conform(rows, schema).withColumns(clean)


def newest_per_key(rows: DataFrame, order: list[Column], keys: list[str] = RAW_KEY, passes: int = 1) -> DataFrame:
    """One row per key, the first in ``order``.

    The ``= 1`` filter lets Spark cut every map task's output to one row per key before
    the shuffle, so a key with very many copies stays cheap.  The hash in front of the keys
    changes nothing but the sort: most comparisons end at its eight bytes.

    A map task sorts what it has read to cut it.  With ``passes`` it sorts one share of its split
    at a time, dealt by the first key alone so that the share is chosen as the files are read;
    ``rows`` are read once a pass: pass stored tables.
    """
    if passes > 1:
        share = F.pmod(F.xxhash64(keys[0]), F.lit(passes))
        return union_all([newest_per_key(rows.filter(share == at), order, keys) for at in range(passes)])
    w = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str] = RAW_KEY) -> DataFrame:
    """One row per key of both loads, the incoming row winning (K4).

    Two incoming rows with one key are decided by their values, so a repeated run gives the same
    table.
    """
    both = existing.withColumn("_load", F.lit(0)).unionByName(incoming.withColumn("_load", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys and c != "_load"]
    order = [F.desc("_load"), *[F.asc_nulls_last(c) for c in rest]]
    return newest_per_key(both, order, keys, KEY_PASSES).drop("_load")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str] = RAW_KEY) -> DataFrame:
    """Rows of both loads, the incoming row winning on equal keys (K4).

    ``date`` is one of the keys, so only months that occur in ``incoming`` can change:
    the rest of ``existing`` is passed on without a shuffle.  Both sides are read several times:
    pass stored tables.  Stored versions go by month folders instead (``sources.rawstore``).
    """
    month = F.coalesce(F.trunc("date", "month"), F.lit("0001-01-01").cast("date"))
    # a list of calendar months, short for any history
    touched = F.array_contains(incoming.agg(F.collect_set(month)).scalar(), month)
    return existing.filter(~touched).unionByName(merge(existing.filter(touched), incoming, keys), allowMissingColumns=True)


def city_places(cities: DataFrame) -> DataFrame:
    """city, lat and lon, one row a city.

    Of entries with one name the first counts: the smallest ``pos`` if ``cities`` has that
    column, else the smallest position on the map.
    """
    place = F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    order = F.struct("pos", place) if "pos" in cities.columns else place
    return cities.groupBy(F.col("name").alias("city")).agg(F.min_by(place, order).alias("place")).select("city", "place.*")


def attach_city_coordinates(rows: DataFrame, cities: DataFrame) -> DataFrame:
    """Replace lat/lon by the city's (see ``city_places``); rows of unknown cities get NULL."""
    return rows.drop("lat", "lon").join(city_places(cities), "city", "left")


def station_coordinates(inventory: DataFrame) -> DataFrame:
    """Decimal coordinates of each station id; its first inventory entry counts."""
    first = F.min_by(F.struct("latitud", "longitud"), "pos")
    return (
        inventory.groupBy(F.col("indicativo").alias("station"))
        .agg(first.alias("first"), F.min("pos").alias("pos"))
        .select(
            "station",
            dms_to_decimal(F.col("first.latitud")).alias("lat"),
            dms_to_decimal(F.col("first.longitud")).alias("lon"),
            "pos",
        )
    )


def attach_station_coordinates(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """Coordinates by station id, NULL for unknown stations."""
    return rows.drop("lat", "lon").join(station_coordinates(inventory).drop("pos"), "station", "left")
