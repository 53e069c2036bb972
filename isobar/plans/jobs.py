"""Batch jobs: landed files -> raw version -> silver -> gold, with a report per step."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import (
    accepted, city_report, judge_provider_a, judge_provider_b, load_report, rejects, staged, station_map, union_all,
)
from ..operators.silver import FILE_ORDER, clean, laid_out, snapshot
from ..schemas import GOLD_SCHEMAS, SILVER_SCHEMA, conform
from ..sources import catalog, months, rawstore, sinks
from ..sources.landing import read_provider_a, read_provider_b
from ..sources.months import Layout
from ..workspace import materialise
from .gold import FROM_MONTHS, GOLD_TABLES, MONTHLY, station_months

REPORT = "name string, status string, row_count bigint, seconds double, error string"
LAYERS = ("bronze", "silver", "gold")
SILVER_TABLE = "silver.weather_cleaned"
SNAPSHOT_TABLE = "snapshots.weather_cleaned_snapshot"
ALERTS_TABLE = "gold.weather_alerts"
STATION_MONTHS_TABLE = "gold_parts.station_months"
SILVER_LAYOUT = Layout("silver_months", {"year": "string"}, FILE_ORDER)
STATION_MONTHS_LAYOUT = Layout("gold_months")
ALERTS_LAYOUT = Layout("gold_months", {"year": "bigint"}, ("date",))
REJECTS_TABLE, REPORT_TABLE, CITIES_TABLE = "load_rejects", "load_report", "load_cities"
PROVIDERS = {
    "aemet": (read_provider_a, judge_provider_a),
    "meteostat": (read_provider_b, judge_provider_b),
}


def run_steps(spark: SparkSession, steps: dict[str, Callable[[], int | None]]) -> DataFrame:
    """Run named steps in name order; a failing one is reported and the rest go on."""
    report = []
    for name in sorted(steps):
        started = time.monotonic()
        try:
            rows, status, error = steps[name](), "ok", None
        except Exception as failure:  # reported, not hidden: the caller reads the status
            rows, status, error = None, "failed", str(failure)
        report.append((name, status, rows, round(time.monotonic() - started, 3), error))
    return spark.createDataFrame(report, REPORT)


def _store(spark: SparkSession, build: Callable[[], DataFrame], name: str, partition_by: str | None = None):
    def step() -> int:
        sinks.replace_table(build(), name, partition_by)
        return spark.table(name).count()

    return step


def stage(spark: SparkSession, source: str, folder: str, stations: DataFrame) -> DataFrame:
    """Every record landed in a source's folder, typed, with the reason of those that cannot be loaded."""
    reader, judge = PROVIDERS[source]
    return staged(judge(reader(spark, folder)), source, stations)


def load_bronze(spark: SparkSession, landing: dict[str, str], cities: DataFrame, stations: DataFrame) -> DataFrame:
    """Stage all sources, merge them into the months they hold, show the new version (G1, K3, K4).

    ``landing`` maps a source to its folder; ``stations`` has station, city, region and, if
    providers number their stations apart, source.  Each source is parsed once, into a staging
    table of its own; one that fails is reported and the others are loaded.

    Rows that cannot be loaded go to the version's ``load_rejects``; ``load_report`` accounts
    for every row that was read, and ``load_cities`` for the cities the load reached.
    """
    stations = materialise(station_map(stations))
    base = catalog.newest_raw_version(spark)
    version = sinks.new_raw_version()
    staging = version + catalog.STAGING_SUFFIX

    def stored(source: str) -> Callable[[], int]:
        def step() -> int:
            sinks.write_table(stage(spark, source, landing[source], stations), f"{staging}.{source}")
            return spark.table(f"{staging}.{source}").agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]

        return step

    report = run_steps(spark, {source: stored(source) for source in landing})

    def publish() -> int:
        sources = sorted(catalog.tables(spark, staging))
        if not sources:
            raise ValueError("no source could be read")
        landed = union_all([spark.table(f"{staging}.{source}") for source in sources])
        for name, table in ((REJECTS_TABLE, rejects), (REPORT_TABLE, load_report), (CITIES_TABLE, city_report)):
            sinks.write_table(table(landed), f"{version}.{name}")
        rawstore.store_load(accepted(landed), version, base)
        rows = rawstore.publish(spark, version, cities)
        sinks.drop_layers(spark, [staging])
        return rows

    return report.unionByName(run_steps(spark, {"weather_raw.weather_data": publish}))


def build_silver(spark: SparkSession) -> DataFrame:
    """Silver from the published raw tables, by year and month; only months that a load changed are cleaned."""

    def build() -> int:
        upstream = rawstore.shown_months(spark)
        if upstream is None:  # raw tables of another making: a full refresh
            sinks.replace_table(clean(catalog.raw_observations(spark)), SILVER_TABLE, "year")
            return spark.table(SILVER_TABLE).count()
        raw = spark.table(f"{catalog.RAW_DATABASE}.{catalog.RAW_TABLE}")
        rows = lambda made: laid_out(clean(raw.filter(F.col(months.MONTH).isin(made))))
        shown = [*SILVER_SCHEMA.names, "city_key", months.MONTH]
        return months.refresh(spark, SILVER_TABLE, SILVER_LAYOUT, upstream, rows, shown)

    return run_steps(spark, {SILVER_TABLE: build})


def silver_table(spark: SparkSession) -> DataFrame:
    """Silver as stored, in its declared column order and types."""
    return conform(spark.table(SILVER_TABLE), SILVER_SCHEMA)


def build_gold(spark: SparkSession) -> DataFrame:
    """All gold tables and the snapshot from the stored silver table.

    Eight of the ten tables are summed up from the station months, a table of which only the months
    that changed in silver are made anew; so it is with the alerts.
    """
    silver = silver_table(spark)
    listed = months.manifest(spark, SILVER_TABLE)
    upstream = None if listed is None else listed.select(months.MONTH, F.col("folder").alias("made_from"))

    def silver_of(made: list[str]) -> DataFrame:
        # the table's own month column prunes the folders
        return conform(spark.table(SILVER_TABLE).filter(F.col(months.MONTH).isin(made)), SILVER_SCHEMA)

    @lru_cache(maxsize=1)
    def station_months_table() -> DataFrame:
        if upstream is None:
            return materialise(station_months(silver))
        month = F.concat_ws("-", "year", F.lpad(F.col("month").cast("string"), 2, "0"))
        rows = lambda made: station_months(silver_of(made)).withColumn(months.MONTH, month)
        months.refresh(spark, STATION_MONTHS_TABLE, STATION_MONTHS_LAYOUT, upstream, rows)
        return spark.table(STATION_MONTHS_TABLE)

    def alerts() -> int:
        if upstream is None:
            return _store(spark, lambda: GOLD_TABLES["weather_alerts"](silver), ALERTS_TABLE, "year")()
        rows = lambda made: GOLD_TABLES["weather_alerts"](silver_of(made)).withColumn(
            months.MONTH, F.date_format("date", "yyyy-MM")
        )
        return months.refresh(spark, ALERTS_TABLE, ALERTS_LAYOUT, upstream, rows, GOLD_SCHEMAS["weather_alerts"].names)

    def make(name: str) -> DataFrame:
        if name in FROM_MONTHS:
            return GOLD_TABLES[name](station_months_table(), MONTHLY)
        return GOLD_TABLES[name](silver)

    steps: dict[str, Callable[[], int]] = {
        f"gold.{name}": _store(spark, lambda name=name: make(name), f"gold.{name}") for name in GOLD_TABLES
    }
    steps[ALERTS_TABLE] = alerts
    steps[SNAPSHOT_TABLE] = _store(spark, lambda: snapshot(silver), SNAPSHOT_TABLE, "year")
    return run_steps(spark, steps)


def clean_layers(spark: SparkSession) -> list[str]:
    """Drop this library's databases, load versions and their month folders included (K8)."""
    versions = [d for d in catalog.databases(spark) if d.startswith(catalog.VERSION_PREFIX)]
    stores = [catalog.STORE_DATABASE, SILVER_LAYOUT.store, STATION_MONTHS_LAYOUT.store]
    return sinks.drop_layers(spark, [catalog.RAW_DATABASE, "silver", "gold", "gold_parts", "snapshots", *versions, *stores])


def run(spark: SparkSession, layers: list[str], landing: dict[str, str] | None = None,
        cities: DataFrame | None = None, stations: DataFrame | None = None, clean_first: bool = False) -> DataFrame:
    """The chosen layers in order; returns the combined report."""
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    if clean_first:
        clean_layers(spark)
    reports = []
    for layer in LAYERS:
        if layer not in layers:
            continue
        if layer == "bronze":
            part = load_bronze(spark, landing or {}, cities, stations)
        else:
            part = build_silver(spark) if layer == "silver" else build_gold(spark)
        reports.append(part.withColumn("layer", F.lit(layer)))
    return union_all(reports)
