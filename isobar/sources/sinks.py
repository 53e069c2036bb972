"""Table and file sinks K1-K8."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import city_slug
from . import catalog


def write_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    """A new table ``database.table``, creating the database when absent (K2)."""
    database = name.split(".")[0]
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    writer = rebalanced(df, partition_by).write.format("parquet")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)


def replace_table(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Full refresh of ``database.table`` (K1, K2); the name of the version that now stands for it.

    The rows are written as a table of their own, and only when all are there the name, a view, is
    exchanged in one step.  A build that fails leaves the old rows readable.  The version before
    stays for readers that have begun; older ones, and unfinished ones, are dropped.
    """
    spark = df.sparkSession
    database, table = name.split(".")
    older = catalog.stored_versions(spark, database, table)
    version = stored_name(table)
    write_table(df, f"{database}.{version}", partition_by)
    before = catalog.shown_version(spark, name)
    show_as(spark, name, f"SELECT * FROM `{database}`.`{version}`")
    for old in older:
        if old != before:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{old}`")
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{old}{catalog.MONTHS_SUFFIX}`")
    return version


def show_as(spark: SparkSession, name: str, query: str) -> None:
    """Let the view ``database.table`` show ``query`` from now on; a plain table of that name goes."""
    database, table = name.split(".")
    quoted = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {quoted}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS {query}")


def rebalanced(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Even out files per partition value before the write; big values are split, small joined."""
    return df.hint("rebalance", partition_by) if partition_by else df


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")


def stored_name(table: str) -> str:
    """Name of a new stored version of a refreshed table; later ones get higher names."""
    return f"{table}{catalog.STORED_MARK}{_stamp()}"


def new_raw_version() -> str:
    """Name of a load version; later loads get higher names."""
    return catalog.VERSION_PREFIX + _stamp()


def write_by_city(df: DataFrame, path: str) -> None:
    """One Parquet folder per city slug."""
    slugged = df.withColumn("city_slug", city_slug(F.col("city")))
    rebalanced(slugged, "city_slug").write.mode("overwrite").partitionBy("city_slug").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header of a table view (K6)."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def drop_layers(spark: SparkSession, layers: list[str]) -> list[str]:
    """Drop the named databases with their tables; nothing else is touched (K8)."""
    protected = {"default", "information_schema", "sys", "global_temp"} & set(layers)
    if protected:
        raise ValueError(f"refusing to drop system databases: {sorted(protected)}")
    present = [name for name in layers if name in catalog.databases(spark)]
    for name in present:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    return present
