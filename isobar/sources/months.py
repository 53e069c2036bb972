"""Tables kept in month folders, of which a refresh writes only the months that changed.

A version of such a table has partitions that point at month folders: its own for the months it
wrote, and those of earlier versions for all others.  Its manifest lists month, folder, rows, the
version that wrote them and what they were made from.  Folders are never changed once listed, so a
version stays readable whatever is built later, and a build that fails leaves no version.

Folders lie under a database of their own, as several versions share them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog, sinks

MONTH, NO_MONTH = "ym", "none"
#: Partitions named in one statement.
NAMED_AT_ONCE = 500


class Layout(NamedTuple):
    """``store``: the database that holds the folders.  ``parts``: partition columns in front of the
    month, each with one value a month, and their types.  ``order``: how rows lie in a file."""

    store: str
    parts: dict[str, str] = {}
    order: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        return [*self.parts, MONTH]


def month_of(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def months_in(rows: DataFrame, date: str = "date") -> list[str]:
    """The months that occur in ``rows``: calendar months, a short list for any history."""
    return sorted(r[0] for r in rows.select(month_of(date).alias(MONTH)).distinct().collect())


def manifest_of(name: str) -> str:
    return f"{name}{catalog.MONTHS_SUFFIX}"


def folder_of(spark: SparkSession, layout: Layout, version: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layout.store}`")
    return f"{spark.catalog.getDatabase(layout.store).locationUri}/{version}"


def add_version(rows: DataFrame, layout: Layout, table: str, version: str, base: DataFrame | None,
                replaced: list[str], made_from: DataFrame | None = None) -> None:
    """Write ``rows``, which have the layout's columns, and register them with the other months of ``base`` as ``table``.

    ``replaced``: the months that ``rows`` stands for, also those it has no rows of.  ``made_from``:
    (month, made_from) to be noted.  The table is made under another name until it is whole.
    """
    spark = rows.sparkSession
    folder = folder_of(spark, layout, version)
    even = sinks.rebalanced(rows, MONTH)
    if layout.order:
        even = even.sortWithinPartitions(*layout.columns(), *layout.order)
    even.write.partitionBy(*layout.columns()).parquet(folder)
    columns = [f for f in rows.schema if f.name not in layout.columns()]
    path = F.concat(F.lit(folder), *[F.concat(F.lit(f"/{c}="), F.col(c).cast("string")) for c in layout.columns()])
    stored = spark.read.schema(rows.schema).parquet(folder)
    listed = stored.groupBy(*layout.columns()).agg(F.count("*").alias("row_count")).select(
        *layout.columns(), path.alias("folder"), "row_count", F.lit(version).alias("written_by")
    )
    notes = made_from if made_from is not None else spark.createDataFrame([], f"{MONTH} string, made_from string")
    listed = listed.join(F.broadcast(notes), MONTH, "left")  # calendar months
    if base is not None:
        listed = listed.unionByName(base.filter(~F.col(MONTH).isin(replaced)))
    sinks.write_table(listed.coalesce(1), manifest_of(table))
    database, name = table.split(".")
    unfinished = f"`{database}`.`{name}{catalog.UNFINISHED_SUFFIX}`"
    spec = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns]
    spec += [f"`{c}` {kind}" for c, kind in layout.parts.items()] + [f"`{MONTH}` string"]
    by = ", ".join(f"`{c}`" for c in layout.columns())
    spark.sql(f"CREATE TABLE {unfinished} ({', '.join(spec)}) USING parquet PARTITIONED BY ({by}) LOCATION '{folder}'")
    rows_ = spark.table(manifest_of(table)).orderBy(MONTH).collect()  # calendar months
    for at in range(0, len(rows_), NAMED_AT_ONCE):
        parts = " ".join(
            f"PARTITION ({', '.join(f'`{c}` = {r[c]!r}' for c in layout.columns())}) LOCATION '{r.folder}'"
            for r in rows_[at : at + NAMED_AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {unfinished} ADD IF NOT EXISTS {parts}")
    spark.sql(f"ALTER TABLE {unfinished} RENAME TO `{database}`.`{name}`")


def manifest(spark: SparkSession, table: str) -> DataFrame | None:
    """The manifest of a version or of the version that a refreshed table shows; None if it has none."""
    database, name = table.split(".")
    shown = catalog.shown_version(spark, table)
    name = manifest_of(shown or name)
    return spark.table(f"{database}.{name}") if spark.catalog.tableExists(f"{database}.{name}") else None


def refresh(spark: SparkSession, name: str, layout: Layout, upstream: DataFrame,
            rows_of: Callable[[list[str]], DataFrame], shown: list[str] | None = None) -> int:
    """Bring ``database.table`` up to date with ``upstream`` (month, made_from); its rows.

    Months whose ``made_from`` differs from what is noted are made anew by ``rows_of``, which gets
    their names; the others are taken over, and those upstream lacks are left out.  ``shown``: the
    columns that readers see.  The version before stays, older ones and their folders go.
    """
    database, table = name.split(".")
    older, before, own = catalog.stored_versions(spark, database, table), catalog.shown_version(spark, name), manifest(spark, name)
    if own is None:
        pairs = upstream.withColumn("noted", F.lit(None).cast("string"))
    else:
        pairs = upstream.join(own.select(MONTH, F.col("made_from").alias("noted")), MONTH, "full")
    stale = pairs.filter(~F.col("made_from").eqNullSafe(F.col("noted"))).collect()  # calendar months
    made = sorted(r[MONTH] for r in stale if r.made_from is not None)
    if stale or own is None:
        version = sinks.stored_name(table)
        rows = rows_of(made).withColumns({c: F.col(c).cast(kind) for c, kind in layout.parts.items()})
        add_version(rows, layout, f"{database}.{version}", version, own, [r[MONTH] for r in stale], upstream)
        columns = ", ".join(f"`{c}`" for c in shown) if shown else "*"
        sinks.show_as(spark, name, f"SELECT {columns} FROM `{database}`.`{version}`")
        _drop(spark, layout, database, [v for v in older if v != before], [version, *([before] if before else [])])
    return row_count(spark, name)


def _drop(spark: SparkSession, layout: Layout, database: str, versions: list[str], kept: list[str]) -> None:
    """Drop versions with the folders that no kept one lists."""
    listed = lambda vs: {r.folder for v in vs for r in spark.table(f"{database}.{manifest_of(v)}").select("folder").collect()}
    manifests = [v for v in versions if spark.catalog.tableExists(f"{database}.{manifest_of(v)}")]
    unused = listed(manifests) - listed([v for v in kept if spark.catalog.tableExists(f"{database}.{manifest_of(v)}")])
    for version in versions:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{version}`")
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{manifest_of(version)}`")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in unused:
        path = hadoop(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def row_count(spark: SparkSession, table: str) -> int:
    """Rows by the manifest: no data is read."""
    return int(manifest(spark, table).agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0])


def unused_folders(spark: SparkSession, layout: Layout, tables: list[str]) -> DataFrame:
    """Month folders (``<version>/..``) that none of ``tables`` lists: what may be deleted."""
    inner = rf"/([^/]+/(?:[^/=]+=[^/]+/)*{MONTH}=[^/]+)"
    root = folder_of(spark, layout, "")
    files = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(root)
    held = files.select(F.regexp_extract("path", inner + r"/[^/]+$", 1).alias("folder")).filter("folder <> ''").distinct()
    for table in tables:
        listed = manifest(spark, table)
        held = held.join(listed.select(F.regexp_extract("folder", inner + "$", 1).alias("folder")), "folder", "left_anti")
    return held
