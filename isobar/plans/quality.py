"""Data-quality queries over raw, silver and gold tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import percent
from ..workspace import materialise

EXTREME_MEASURES = ("max_temp_month", "min_temp_month", "total_precip_month")
CALENDAR_KEY = ("city", "year", "month")
SAMPLE_ROWS = 3


def _located() -> Column:
    return F.col("lat").isNotNull() & F.col("lon").isNotNull()


def coordinate_coverage(df: DataFrame, *by: str) -> DataFrame:
    """Rows, rows with a position and their share, overall or per key."""
    counted = df.groupBy(*by).agg(F.count("*").alias("total_rows"), F.count_if(_located()).alias("with_coordinates"))
    return counted.withColumn("coverage_pct", percent(F.col("with_coordinates"), F.col("total_rows"), 1))


def coordinate_extent(df: DataFrame) -> DataFrame:
    """Box of the positions per city and source."""
    return df.filter(_located()).groupBy("city", "source").agg(
        F.count("*").alias("located_rows"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
    )


def station_counts(df: DataFrame) -> DataFrame:
    """Rows per city, station, position and source (D3)."""
    located = df.filter(_located())
    return located.groupBy("city", "station", "lat", "lon", "source").agg(F.count("*").alias("station_rows"))


def source_counts(df: DataFrame) -> DataFrame:
    """Rows and distinct cities per source."""
    return df.groupBy("source").agg(F.count("*").alias("source_rows"), F.count_distinct("city").alias("cities"))


def null_counts(df: DataFrame, columns: tuple[str, ...] = EXTREME_MEASURES) -> DataFrame:
    """Missing values per column, as rows."""
    present = [c for c in columns if c in df.columns]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    return counted.unpivot([], present, "column_name", "null_rows")


def _seen(df: DataFrame) -> DataFrame:
    return df.select(*CALENDAR_KEY).distinct()


def calendar_grid(seen: DataFrame) -> DataFrame:
    """Every city with every year and month that occurs anywhere.

    Years and months are short lists (calendar values), unrolled on the distinct cities.
    """
    years = seen.agg(F.collect_set("year")).scalar()
    months = seen.agg(F.collect_set("month")).scalar()
    cities = seen.select("city").na.drop().distinct()
    return cities.withColumn("year", F.explode(years)).withColumn("month", F.explode(months))


def missing_months(df: DataFrame) -> DataFrame:
    """Grid entries without any row.

    The distinct keys are stored first: lists, grid and comparison all read them.
    """
    return _unseen(materialise(_seen(df)))


def _unseen(seen: DataFrame) -> DataFrame:
    return calendar_grid(seen).join(seen, list(CALENDAR_KEY), "left_anti")


def missing_detail(df: DataFrame, columns: tuple[str, ...] = EXTREME_MEASURES) -> DataFrame:
    """Grid entries with their measures, of which at least one is NULL.

    The entries are those whose city, whose year and whose month all lack something somewhere:
    months without a row, and months with rows that miss a measure.
    """
    key = list(CALENDAR_KEY)
    seen = materialise(_seen(df))
    missing = materialise(_unseen(seen))
    lacking = calendar_grid(seen)
    for name in key:
        lacking = lacking.join(missing.select(name).distinct(), name, "left_semi")
    detail = lacking.select(*key).join(df.select(*key, *columns), key, "left")
    return detail.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def first_rows(df: DataFrame, source: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """First rows of a source by city and time."""
    tie_break = [c for c in ("date", "year", "month", "station") if c in df.columns]
    return df.filter(F.col("source") == source).orderBy("city", *tie_break).limit(rows)


def point_lookup(df: DataFrame, city: str, year: int, month: int) -> DataFrame:
    """Rows of one city in one month, city compared without case.

    Both reach the files: the month as a range of dates, and the city where the table has the
    folded ``city_key`` that stored silver is sorted by.
    """
    named = F.col("city_key") == city.lower() if "city_key" in df.columns else F.lower("city") == city.lower()
    if "date" not in df.columns:
        return df.filter(named & (F.col("year").cast("int") == year) & (F.col("month").cast("int") == month))
    first, after = date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)
    within = (F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(after))
    if "year" in df.columns:
        within &= F.col("year").cast("int") == year  # prunes partitions
    return df.filter(named & within)
