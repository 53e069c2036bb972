"""Load versions of the raw table: databases that list month folders (K3, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import city_places, merge
from ..schemas import RAW_SCHEMA, conform
from . import catalog, months, sinks
from .months import MONTH, Layout

LAYOUT = Layout(catalog.STORE_DATABASE)


def _table(version: str) -> str:
    return f"{version}.{catalog.RAW_TABLE}"


def manifest(spark: SparkSession, version: str) -> DataFrame:
    """ym, folder, row_count and the version that wrote it, one row a month."""
    return spark.table(months.manifest_of(_table(version)))


def store_load(incoming: DataFrame, version: str | None = None, base: str | None = None) -> str:
    """Merge a load into the months it holds and register the result as a new version.

    ``incoming`` is read several times: pass a stored table.  ``base`` is the version to go on from; of it
    only the months of the load are read.  A version without its table is an unfinished load.
    """
    spark = incoming.sparkSession
    version = version or sinks.new_raw_version()
    if catalog.RAW_TABLE in catalog.tables(spark, version):
        raise ValueError(f"load version {version} exists already")
    incoming = conform(incoming, RAW_SCHEMA)
    touched = months.months_in(incoming)
    existing = incoming.limit(0)
    if base:
        # the months are literals, so only their folders are listed and read
        existing = conform(spark.table(_table(base)).filter(F.col(MONTH).isin(touched)), RAW_SCHEMA)
    merged = conform(merge(existing, incoming), RAW_SCHEMA).withColumn(MONTH, months.month_of("date"))
    months.add_version(merged, LAYOUT, _table(version), version, manifest(spark, base) if base else None, touched)
    return version


def publish(spark: SparkSession, version: str, cities: DataFrame) -> int:
    """Show a version as the raw table, with the cities' coordinates joined as it is read (K3); its rows.

    Only the small table of places is written; the view is exchanged in one step.
    """
    sinks.write_table(city_places(cities), f"{version}.{catalog.PLACES_TABLE}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{catalog.RAW_DATABASE}`")
    kept = ", ".join(f"r.`{f.name}`" for f in RAW_SCHEMA if f.name not in ("lat", "lon"))
    sinks.show_as(
        spark, f"{catalog.RAW_DATABASE}.{catalog.RAW_TABLE}",
        f"SELECT {kept}, p.lat, p.lon, r.`{MONTH}` FROM `{version}`.`{catalog.RAW_TABLE}` r "
        f"LEFT JOIN `{version}`.`{catalog.PLACES_TABLE}` p ON r.city = p.city",
    )
    return months.row_count(spark, _table(version))


def shown_months(spark: SparkSession) -> DataFrame | None:
    """(ym, made_from) of what the raw table shows: its folders and the places joined to them.

    None if the raw table is anything but the view of one load version.
    """
    names = [t for t in catalog.tables(spark, catalog.RAW_DATABASE) if catalog.RAW_TABLE in t.lower()]
    version = catalog.newest_raw_version(spark)
    if names != [catalog.RAW_TABLE] or not version or catalog.PLACES_TABLE not in catalog.tables(spark, version):
        return None
    if f"`{version}`" not in catalog.definition(spark, f"{catalog.RAW_DATABASE}.{catalog.RAW_TABLE}"):
        return None
    places = spark.table(f"{version}.{catalog.PLACES_TABLE}").agg(F.bit_xor(F.xxhash64("city", "lat", "lon"))).first()[0]
    return manifest(spark, version).select(MONTH, F.concat("folder", F.lit(f" with places {places}")).alias("made_from"))


def unused_folders(spark: SparkSession) -> DataFrame:
    """Month folders that no version lists any more: what may be deleted once their versions are dropped."""
    return months.unused_folders(spark, LAYOUT, [_table(v) for v in catalog.raw_versions(spark)])
