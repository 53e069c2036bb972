"""Star-schema tables seen as weather inputs.

``lineitem`` joined with its supplier, nation and region becomes one raw observation per
row: nation = city, region = region, supplier = station.  Measures are whole or half
numbers, so sums are exact in any order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.expressions import first_match
from isobar.operators import bronze
from isobar.operators.bronze import KEY_PASSES, newest_per_key
from isobar.operators.silver import FILE_ORDER, clean, laid_out
from isobar.schemas import PROVIDER_B_FIELDS, RAW_KEY, SILVER_SCHEMA, conform
from isobar.plans import jobs
from isobar.sources.landing import read_provider_a, read_provider_b
from isobar.sources.logs import read_logs
from isobar.sources.sinks import rebalanced
from isobar.workspace import shared_folder

UNPLACED_NATION = 24
LOAD_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hundredths(column: str) -> Column:
    # hundredths of a (never negative) rate column as an integer; the cast also removes -0.0
    return F.floor(F.col(column) * 100 + 0.5).cast("int")


def _nation_lat() -> Column:
    return F.when(F.col("n_nationkey") != UNPLACED_NATION, F.col("n_nationkey") * 0.25 + 36.0)


def _nation_lon() -> Column:
    return F.when(F.col("n_nationkey") != UNPLACED_NATION, F.col("n_nationkey") * 0.5 - 6.0)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations plus the columns that order the loads."""
    # one small table at a time, so that each join's build side is that table
    rows = (
        read(spark, sf_dir, "lineitem")
        .join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    tavg = F.when(
        F.col("l_quantity") != 50, F.col("l_quantity") * 0.5 - 5 + (F.col("l_suppkey") % 9) * 2
    )
    wet = F.col("l_partkey") % (10 + F.col("l_suppkey") % 40) == 0
    precip = F.when(
        F.col("l_linenumber") != 7,
        F.when(wet, F.floor(F.col("l_extendedprice") / 800).cast("double")).otherwise(0.0),
    )
    humidity = F.when(
        F.col("l_linenumber") != 6,
        F.least(F.lit(100), _hundredths("l_discount") * 5 + (F.col("l_suppkey") % 6) * 15).cast("double"),
    )
    wind = (_hundredths("l_tax") * 5).cast("double")
    return rows.select(
        F.col("l_shipdate").cast("date").alias("date"),
        tavg.alias("tavg"),
        (tavg - F.col("l_linenumber")).alias("tmin"),
        (tavg + F.col("l_linenumber")).alias("tmax"),
        precip.alias("prcp"),
        (F.col("l_partkey") % 360).cast("double").alias("wdir"),
        wind.alias("wspd"),
        (wind * 1.5).alias("wpgt"),
        (F.col("l_partkey") % 40 + 990).cast("double").alias("pres"),
        F.when(F.col("l_quantity") <= 8, F.col("l_linenumber").cast("double")).alias("snow"),
        (F.col("l_partkey") % 720).cast("double").alias("tsun"),
        humidity.alias("rhum"),
        F.col("s_name").alias("station"),
        F.when(F.col("l_returnflag") == "N", "aemet").otherwise("meteostat").alias("source"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        _nation_lat().alias("lat"),
        _nation_lon().alias("lon"),
        *LOAD_ORDER,
    )


def deduplicated(spark: SparkSession, sf_dir: str, passes: int = 1) -> DataFrame:
    """One raw row per date, city and source: the first in load order."""
    order = [F.asc(c) for c in LOAD_ORDER]
    return newest_per_key(raw_rows(spark, sf_dir), order, RAW_KEY, passes).drop(*LOAD_ORDER)


_FOLDERS: dict[tuple[str, str, str], str] = {}
_FRAMES: dict[tuple[SparkSession, str, str], DataFrame] = {}


def _folder(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """A folder in the shared one, written once per application."""
    application = spark.sparkContext.applicationId
    key = (application, sf_dir, name)
    if key not in _FOLDERS:
        folder = f"{shared_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"
        write(folder)
        _FOLDERS[key] = folder
    return _FOLDERS[key]


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None],
            load: Callable[[str], DataFrame]) -> DataFrame:
    """A table written once per application to the shared folder and read from there."""
    folder = _folder(spark, sf_dir, name, write)
    frame = (spark, sf_dir, name)
    if frame not in _FRAMES:
        _FRAMES[frame] = load(folder)
    return _FRAMES[frame]


def stored_frame(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return _stored(spark, sf_dir, name, lambda folder: build().write.parquet(folder), spark.read.parquet)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw table, as the bronze job leaves it."""
    return _stored(
        spark, sf_dir, "raw", lambda folder: deduplicated(spark, sf_dir, KEY_PASSES).write.parquet(folder), spark.read.parquet
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver table, from which the gold and serving queries start."""

    def write(folder: str) -> None:
        table = clean(raw(spark, sf_dir), as_of=F.lit("2025-01-01 00:00:00").cast("timestamp"))
        even = rebalanced(laid_out(table).drop("ym"), "year").sortWithinPartitions("year", *FILE_ORDER)
        even.write.partitionBy("year").parquet(folder)

    def load(folder: str) -> DataFrame:
        return conform(spark.read.schema(SILVER_SCHEMA).parquet(folder), SILVER_SCHEMA)

    return _stored(spark, sf_dir, "silver", write, load)


def silver_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the folded city that the files are sorted by."""
    silver(spark, sf_dir)  # writes them
    schema = T.StructType([*SILVER_SCHEMA, T.StructField("city_key", T.StringType())])
    return _stored(spark, sf_dir, "silver-files", lambda f: None, lambda f: spark.read.schema(schema).parquet(
        _FOLDERS[spark.sparkContext.applicationId, sf_dir, "silver"]
    ))


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An older stored load (line numbers 1 to 3) and a newer one (from 4), each keyed."""

    def write(part: Column) -> Callable[[str], None]:
        order = [F.asc(c) for c in LOAD_ORDER]
        rows = raw_rows(spark, sf_dir).filter(part)
        return lambda folder: newest_per_key(rows, order, passes=KEY_PASSES).drop(*LOAD_ORDER).write.parquet(folder)

    late = F.col("l_linenumber") >= 4
    return (
        _stored(spark, sf_dir, "load-1", write(~late), spark.read.parquet),
        _stored(spark, sf_dir, "load-2", write(late), spark.read.parquet),
    )


def _one_value_a_file(lines: DataFrame, folder: str) -> None:
    """Each row's JSON text as a file of its own, as a provider's answer is landed."""
    lines.write.option("maxRecordsPerFile", 1).mode("append").text(folder)


def landed_folder_a(spark: SparkSession, sf_dir: str) -> str:
    """Provider A's rows as landed: those of the third to fifth line numbers as arrays of a station each, others as lines."""

    def write(folder: str) -> None:
        rows = raw_rows(spark, sf_dir).filter(F.col("source") == "aemet")
        arrays = F.col("l_linenumber").between(3, 5) & (F.substring_index("station", "#", -1).try_cast("int") < 40)
        provider_a_text(rows.filter(~F.coalesce(arrays, F.lit(False)))).write.json(folder)
        texts = provider_a_text(rows.filter(arrays))
        record = F.to_json(F.struct(*texts.columns))
        # pretty-printed, one record over several lines
        pretty = F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.replace(record, F.lit(',"'), F.lit(',\n "'))), ",\n"), F.lit("\n]"))
        _one_value_a_file(texts.groupBy("station").agg(pretty.alias("value")).select("value"), folder)

    return _folder(spark, sf_dir, "provider-a", write)


def landed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider A's rows, read back through the file source."""
    landed_folder_a(spark, sf_dir)  # writes it
    return _stored(spark, sf_dir, "provider-a", lambda _: None, lambda f: read_provider_a(spark, f))


def _landed_b(rows: DataFrame) -> DataFrame:
    """The records of provider B as JSON text; every fiftieth part's row has a pressure that is no number."""
    pressure = F.when(F.col("l_partkey") % 50 == 0, "n/a").otherwise(F.col("pres").cast("string"))
    fields = [F.col(c) if c != "pres" else pressure.alias("pres") for c in PROVIDER_B_FIELDS]
    return rows.select(F.to_json(F.struct(F.array(F.struct(*fields)).alias("data"), "station")).alias("value"), "l_partkey")


def landed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider B's rows landed as one ``{"data": [...]}`` line per record and read back."""

    def write(folder: str) -> None:
        _landed_b(raw_rows(spark, sf_dir).filter(F.col("source") == "meteostat")).select("value").write.text(folder)

    return _stored(spark, sf_dir, "provider-b", write, lambda f: read_provider_b(spark, f))


def landed_folder_b_cut(spark: SparkSession, sf_dir: str) -> str:
    """The same, with every fiftieth part's record cut off on its way."""

    def write(folder: str) -> None:
        landed = _landed_b(raw_rows(spark, sf_dir).filter(F.col("source") == "meteostat"))
        cut = F.when(F.col("l_partkey") % 50 == 7, F.left("value", F.lit(40))).otherwise(F.col("value"))
        landed.select(cut.alias("value")).write.text(folder)

    return _folder(spark, sf_dir, "provider-b-cut", write)


def known_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The providers' station map; suppliers 3 and 4 are in neither's."""
    skipped = read(spark, sf_dir, "supplier").filter(F.col("s_suppkey").isin(3, 4)).select(F.col("s_name").alias("station"))
    known = station_places(spark, sf_dir).join(skipped, "station", "left_anti")
    known = bronze.station_map(bronze.union_all([known.withColumn("source", F.lit(s)) for s in ("aemet", "meteostat")]))
    return _stored(spark, sf_dir, "stations", lambda f: known.write.parquet(f), spark.read.parquet)


def staged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both providers' landed files as the job stages them, stored."""

    def write(folder: str) -> None:
        known = known_stations(spark, sf_dir)
        a = jobs.stage(spark, "aemet", landed_folder_a(spark, sf_dir), known)
        b = jobs.stage(spark, "meteostat", landed_folder_b_cut(spark, sf_dir), known)
        bronze.union_all([a, b]).write.parquet(folder)

    return _stored(spark, sf_dir, "staged", write, spark.read.parquet)


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written as a log file and read back as records.

    ERROR and DEBUG lines carry function and line number, as job logs do.
    """

    def by_event(names: dict[str, str], otherwise: str) -> Column:
        return first_match([(F.col("event_type") == k, F.lit(v)) for k, v in names.items()], otherwise)

    def write(folder: str) -> None:
        level = by_event({"error": "ERROR", "view": "DEBUG"}, "INFO")
        tag = by_event({"error": "ERROR", "view": "CACHE", "click": "DB", "signup": "START"}, "SUCCESS")
        where = F.when(level.isin("ERROR", "DEBUG"), F.lit("run_step       :12   | ")).otherwise("")
        line = F.concat(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" | "), F.rpad(level, 8, " "),
            F.lit(" | data_manager         | "), where, F.lit("["), tag,
            F.lit("] consulta: t (5 filas) | Context: "), "props",
        )
        read(spark, sf_dir, "events").select(line.alias("value")).write.text(folder)

    return _stored(spark, sf_dir, "logs", write, lambda folder: read_logs(spark, folder))


def station_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and region of every station, stored as a job stores its station map."""

    def write(folder: str) -> None:
        _station_places(spark, sf_dir).write.parquet(folder)

    return _stored(spark, sf_dir, "station-places", write, spark.read.parquet)


def _station_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "supplier")
        .join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_name").alias("station"), F.col("n_name").alias("city"), F.col("r_name").alias("region"))
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension; the last nation stays out so that one city has no position."""
    named = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.filter(F.col("n_nationkey") < UNPLACED_NATION).select(
        F.col("n_name").alias("name"),
        _nation_lat().alias("latitude"),
        _nation_lon().alias("longitude"),
        F.lit(0.0).alias("elevation"),
        F.col("r_name").alias("region"),
    )


def repeated_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city dimension with every city listed a second time, elsewhere."""
    listed = cities(spark, sf_dir).withColumn("pos", F.lit(0))
    again = listed.withColumns({"pos": F.lit(1), "latitude": F.col("latitude") - 50, "longitude": F.lit(0.0)})
    return again.unionByName(listed)


def _padded(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def station_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One inventory entry per supplier with coordinates as degree-minute-second text."""
    key = F.col("s_suppkey")
    north = F.concat(_padded(key % 8 + 36), _padded(key * 7 % 60), _padded(key * 11 % 60), F.lit("N"))
    side = F.when(key % 2 == 0, "W").otherwise("E")
    east = F.concat(_padded(key % 10), _padded(key * 13 % 60), _padded(key * 17 % 60), side)
    return read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("indicativo"),
        F.when(key % 25 == 24, "XX").otherwise(north).alias("latitud"),
        east.alias("longitud"),
        key.alias("pos"),
    )


def inventory_file(spark: SparkSession, sf_dir: str) -> str:
    """The inventory landed as one JSON array, in the order of the suppliers."""

    def write(folder: str) -> None:
        entry = F.struct("pos", F.to_json(F.struct("indicativo", "latitud", "longitud")).alias("json"))
        listed = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["json"])
        rows = station_inventory(spark, sf_dir)
        rows.agg(F.concat(F.lit("["), F.array_join(listed, ",\n"), F.lit("]")).alias("value")).write.text(folder)

    return _folder(spark, sf_dir, "inventory", write)


def provider_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request for each raw row: those of a month arrive in the first twenty minutes of it, by their order."""
    rows = raw_rows(spark, sf_dir)
    second = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1200
    return rows.select("source", (F.date_trunc("month", "date") + F.make_dt_interval(secs=second)).cast("timestamp").alias("ts"))


def provider_a_text(rows: DataFrame) -> DataFrame:
    """Raw rows as provider A would send them: text, decimal comma, ``Ip`` for no rain figure.

    One part number in fifty has no number for tmax, another one no valid date.
    """

    def text(column: str) -> Column:
        return F.replace(F.col(column).cast("string"), F.lit("."), F.lit(","))

    kind = F.col("l_partkey") % 50
    return rows.select(
        F.when(kind == 1, "2024/13/01").otherwise(F.col("date").cast("string")).alias("fecha"),
        text("tavg").alias("tmed"),
        text("tmin").alias("tmin"),
        F.when(kind == 0, "abc").otherwise(text("tmax")).alias("tmax"),
        F.coalesce(text("prcp"), F.lit("Ip")).alias("prec"),
        text("wdir").alias("dir"),
        text("wspd").alias("velmedia"),
        text("wpgt").alias("racha"),
        F.coalesce(text("rhum"), F.lit("null")).alias("hrMedia"),
        "station",
    )
