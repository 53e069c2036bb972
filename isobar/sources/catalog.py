"""Databases and tables of the session catalogue: S5-S9, D5.

Raw loads are versioned: each load writes a database ``weather_raw_<yyyyMMddHHmmss>``.  Refreshed
tables are views of the newest of their stored versions, ``<table>__stored_<yyyyMMddHHmmss>``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import union_all
from ..schemas import RAW_SCHEMA

RAW_DATABASE = "weather_raw"
RAW_TABLE = "weather_data"
VERSION_PREFIX = "weather_raw_"
STAGING_SUFFIX, UNFINISHED_SUFFIX = "_staging", "__unfinished"
STORE_DATABASE = "raw_months"
PLACES_TABLE = "load_places"
STORED_MARK, MONTHS_SUFFIX = "__stored_", "__months"

# The short keys under which the serving layer knows its tables.
SERVING_TABLES = {
    "summary": "gold.city_yearly_summary",
    "extreme": "gold.city_extreme_days",
    "trends": "gold.weather_trends",
    "climate": "gold.climate_profiles",
    "alerts": "gold.weather_alerts",
    "seasonal": "gold.seasonal_analysis",
    "comparison": "gold.climate_comparison",
}


def table(spark: SparkSession, key: str) -> DataFrame:
    """Whole table behind a serving key (S5); ``coords`` is derived from silver."""
    from ..plans.maps import city_coordinates

    if key == "coords":
        return city_coordinates(spark.table("silver.weather_cleaned"))
    if key not in SERVING_TABLES:
        raise ValueError(f"unknown table key {key!r}; known: coords, {', '.join(SERVING_TABLES)}")
    return spark.table(SERVING_TABLES[key])


def databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def _listed(spark: SparkSession, database: str) -> list[str]:
    if database not in databases(spark):
        return []
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def tables(spark: SparkSession, database: str) -> list[str]:
    """Tables and views by the names that readers use: without stored versions, manifests and unfinished tables."""
    hidden = (UNFINISHED_SUFFIX, MONTHS_SUFFIX)
    return [t for t in _listed(spark, database) if STORED_MARK not in t and not t.endswith(hidden)]


def stored_versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """The stored versions of a refreshed table, oldest first."""
    named = (t for t in _listed(spark, database) if t.startswith(f"{table}{STORED_MARK}"))
    return sorted(t for t in named if not t.endswith(MONTHS_SUFFIX))


def definition(spark: SparkSession, view: str) -> str:
    """The statement that makes a view; empty for tables."""
    if not spark.catalog.tableExists(view) or spark.catalog.getTable(view).tableType != "VIEW":
        return ""
    return spark.sql(f"SHOW CREATE TABLE {view}").first()[0]


def shown_version(spark: SparkSession, name: str) -> str | None:
    """The stored version that a refreshed table shows."""
    database, table = name.split(".")
    text = definition(spark, name)
    return next((v for v in reversed(stored_versions(spark, database, table)) if f"`{v}`" in text), None)


def raw_versions(spark: SparkSession) -> list[str]:
    """Finished load versions, oldest first; staging areas and loads without their table are none."""
    named = sorted(d for d in databases(spark) if d.startswith(VERSION_PREFIX) and not d.endswith(STAGING_SUFFIX))
    return [d for d in named if RAW_TABLE in tables(spark, d)]


def newest_raw_version(spark: SparkSession) -> str | None:
    """Highest-named finished load version."""
    return max(raw_versions(spark), default=None)


def raw_observations(spark: SparkSession) -> DataFrame:
    """Union of the raw weather tables, else of all bronze tables, else empty."""
    raw = tables(spark, RAW_DATABASE)
    if raw:
        names = [f"{RAW_DATABASE}.{t}" for t in raw if RAW_TABLE in t.lower()]
    else:
        names = [f"bronze.{t}" for t in tables(spark, "bronze")]
    if not names:
        return spark.createDataFrame([], RAW_SCHEMA)
    return union_all([spark.table(name) for name in names])


def listing(spark: SparkSession) -> DataFrame:
    """Every column of every table."""
    rows = [
        (database, name, column.name, column.dataType)
        for database in databases(spark)
        for name in tables(spark, database)
        for column in spark.catalog.listColumns(f"{database}.{name}")
    ]
    return spark.createDataFrame(rows, "database string, table string, column string, type string")


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in named.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_row_counts(spark: SparkSession, database: str, fallback: str | None = None) -> DataFrame:
    """Rows of every table of a layer, or of the fallback layer when the first is empty.

    Tables in month folders are counted by their manifests, others by their files' footers.
    """
    from . import months

    names = tables(spark, database)
    if not names and fallback:
        database, names = fallback, tables(spark, fallback)
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")

    def counted(name: str) -> DataFrame:
        listed = months.manifest(spark, f"{database}.{name}")
        rows = spark.table(f"{database}.{name}").agg(F.count("*").alias("row_count")) if listed is None else listed.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
        )
        return rows.select(F.lit(name).alias("table_name"), "row_count")

    return reduce(DataFrame.unionByName, [counted(name) for name in sorted(names)])
