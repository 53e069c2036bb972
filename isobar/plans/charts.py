"""Chart and indicator tables over the gold tables.

These follow the conventions of a data-frame tool, not of SQL: a sum over nothing is 0
and groups without a key are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.filters import Filters, apply_filters

HISTOGRAM_BINS = 20
TOP_CITIES = 10
CITY_LINES = 5


def _sum0(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def _by(df: DataFrame, *keys: str):
    return df.na.drop(subset=list(keys)).groupBy(*keys)


def kpis(df: DataFrame) -> DataFrame:
    """One row of indicators and their change from the year before the latest (A10).

    Works on any table; an indicator whose column is absent is 0.  Rows fold to one row
    per year first, so only the years (not the rows) meet in one place.
    """
    has = set(df.columns)

    def total(name: str) -> Column:
        return (F.sum(name) if name in has else F.lit(None)).cast("double")

    def present(name: str) -> Column:
        return F.count(name) if name in has else F.lit(0).cast("long")

    alerts = F.count_if(F.col("overall_alert") != V.NORMAL) if "overall_alert" in has else F.lit(0).cast("long")
    year = F.col("year").cast("int") if "year" in has else F.lit(0)
    years = df.groupBy(year.alias("year")).agg(
        F.count("*").alias("rows"),
        total("avg_temp").alias("temp"),
        present("avg_temp").alias("temp_n"),
        total("total_precip").alias("precip"),
        total("avg_humidity").alias("humidity"),
        present("avg_humidity").alias("humidity_n"),
        alerts.alias("alerts"),
    )
    means = {m: F.try_divide(m, f"{m}_n") for m in ("temp", "humidity")}
    latest = F.struct(
        "year", means["temp"].alias("temp"), F.coalesce("precip", F.lit(0.0)).alias("precip"),
        means["humidity"].alias("humidity"),
    )
    # at most one entry per calendar year
    known = F.when(F.col("year").isNotNull(), latest)
    folded = years.agg(
        F.try_divide(F.sum("temp"), F.sum("temp_n")).alias("avg_temp"),
        _sum0("precip").alias("total_precip"),
        F.try_divide(F.sum("humidity"), F.sum("humidity_n")).alias("avg_humidity"),
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("active_alerts"),
        F.sort_array(F.collect_list(known), asc=False).alias("y"),
    )

    def change(metric: str) -> Column:
        now, before = F.get("y", F.lit(0))[metric], F.get("y", F.lit(1))[metric]
        return F.when(F.size("y") >= 2, now - before).otherwise(0.0)

    def shown(name: str) -> Column:
        return F.col(name) if name in has else F.lit(0.0).alias(name)

    return folded.select(
        shown("avg_temp"),
        (change("temp") if "avg_temp" in has else F.lit(0.0)).alias("temp_change"),
        "total_precip",
        change("precip").alias("precip_change"),
        shown("avg_humidity"),
        (change("humidity") if "avg_humidity" in has else F.lit(0.0)).alias("humidity_change"),
        "active_alerts",
        F.lit(0).cast("long").alias("alert_change"),
    )


def city_overview(summary: DataFrame) -> DataFrame:
    """Mean, total and row count per city, rounded to 2."""
    return _by(summary, "city").agg(
        F.round(F.avg("avg_temp"), 2).alias("avg_temp"),
        F.round(_sum0("total_precip"), 2).alias("total_precip"),
        F.round(F.avg("avg_humidity"), 2).alias("avg_humidity"),
        F.count("year").alias("records"),
    )


def mean_temperature_by(df: DataFrame, key: str) -> DataFrame:
    """Mean temperature per year or month."""
    return _by(df, key).agg(F.avg("avg_temp").alias("avg_temp"))


def temperature_lines(df: DataFrame, cities: int = CITY_LINES) -> DataFrame:
    """Mean temperature per city and year for the alphabetically first cities."""
    shown = df.select("city").na.drop().distinct().orderBy("city").limit(cities)
    return _by(df.join(shown, "city", "left_semi"), "city", "year").agg(F.avg("avg_temp").alias("avg_temp"))


def precipitation_by_year(df: DataFrame) -> DataFrame:
    return _by(df, "year").agg(_sum0("total_precip").alias("total_precip"))


def precipitation_by_month(df: DataFrame) -> DataFrame:
    return _by(df, "month").agg(F.avg("total_precip").alias("total_precip"))


def rainy_periods(df: DataFrame) -> DataFrame:
    """Rows with precipitation per city, fewest first."""
    wet = _by(df.filter(F.col("total_precip") > 0), "city").agg(F.count("*").alias("rainy_periods"))
    return wet.orderBy("rainy_periods", "city")


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between the smallest and largest value.

    The largest value belongs to the last bin; if all values are equal there is one bin.
    """
    values = df.select(F.col(column).alias("v")).na.drop()
    edges = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    low, width = edges["lo"], edges["hi"] - edges["lo"]
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - low, width) * bins), F.lit(0))
    # the bin number travels with constant edges, so they can be grouping columns
    binned = values.select(
        F.least(place, F.lit(bins - 1)).cast("int").alias("bin"), low.alias("lo"), (width / bins).alias("step")
    )
    return (
        binned.groupBy("bin", "lo", "step")
        .agg(F.count("*").alias("rows"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("step")).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("bin_end"),
            "rows",
        )
    )


SEASON_MEASURES = ("avg_temp_season", "total_precip_season", "avg_humidity_season")


def season_profile(seasonal: DataFrame) -> DataFrame:
    """Mean temperature, precipitation and humidity per season."""
    return _by(seasonal, "season").agg(*[F.avg(m).alias(m) for m in SEASON_MEASURES])


def season_radar(seasonal: DataFrame) -> DataFrame:
    """The profile with each measure scaled to 0-100 across the seasons."""
    # at most four rows meet in the one list
    whole = season_profile(seasonal).agg(
        F.collect_list(F.struct("season", *SEASON_MEASURES)).alias("p"),
        *[F.min(m).alias(f"{m}_lo") for m in SEASON_MEASURES],
        *[F.max(m).alias(f"{m}_hi") for m in SEASON_MEASURES],
    )
    edges = [f"{m}_{end}" for m in SEASON_MEASURES for end in ("lo", "hi")]
    rows = whole.select(F.inline("p"), *edges)
    scaled = {
        m: F.try_divide(F.col(m) - F.col(f"{m}_lo"), F.col(f"{m}_hi") - F.col(f"{m}_lo")) * 100
        for m in SEASON_MEASURES
    }
    return rows.select("season", *[c.alias(m) for m, c in scaled.items()])


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first, or by value."""
    counted = _by(df, column).agg(F.count("*").alias("rows"))
    return counted.orderBy(column) if by_value else counted.orderBy(F.desc("rows"), column)


def top_alert_cities(alerts: DataFrame, cities: int = TOP_CITIES) -> DataFrame:
    """The cities with most alert days (L3)."""
    return value_counts(alerts, "city").limit(cities)


def alerts_by_month(alerts: DataFrame) -> DataFrame:
    """Alert days per calendar month."""
    return (
        alerts.na.drop(subset=["date"])
        .groupBy(F.date_format("date", "yyyy-MM").alias("month_year"))
        .agg(F.count("*").alias("alerts"))
        .orderBy("month_year")
    )


def comparison_sorted(comparison: DataFrame, metric: str) -> DataFrame:
    """Stations from the lowest to the highest value of a metric (L4)."""
    return comparison.select("city", "station", metric).orderBy(F.asc_nulls_last(metric), "city", "station")


def comparison_scatter(comparison: DataFrame) -> DataFrame:
    """Temperature against precipitation, one row per station (V7)."""
    return comparison.select("city", "avg_temp_city", "total_precip_city")


def filter_options(summary: DataFrame, region: str | None = None) -> DataFrame:
    """Choices per filter as (option, value) rows.

    With ``region`` the cities are those of the region.  Seasons and alert levels are
    the fixed lists.
    """
    in_region = F.lit(True) if region is None else F.col("region") == region
    one = [
        ("years", F.col("year")),
        ("months", F.lpad(F.col("month").cast("string"), 2, "0")),
        ("regions", F.col("region")),
        ("cities", F.when(in_region, F.col("city"))),
    ]
    found = (
        summary.select(
            F.inline(F.array(*[F.struct(F.lit(o).alias("option"), c.cast("string").alias("value")) for o, c in one]))
        )
        .na.drop()
        .distinct()
    )
    fixed = [("seasons", s) for s in V.SEASON_MONTHS] + [
        ("alert_levels", a) for a in (V.NORMAL, V.YELLOW, V.ORANGE, V.RED)
    ]
    lists = summary.sparkSession.createDataFrame(fixed, "option string, value string")
    return found.unionByName(lists).orderBy("option", "value")


def _temperature_charts(df: DataFrame) -> dict[str, DataFrame]:
    charts: dict[str, DataFrame] = {}
    if {"year", "avg_temp"} <= set(df.columns):
        charts["temp_by_year"] = mean_temperature_by(df, "year")
    if "avg_temp" in df.columns:
        charts["temp_histogram"] = histogram(df, "avg_temp")
    if {"month", "avg_temp"} <= set(df.columns):
        charts["temp_by_month"] = mean_temperature_by(df, "month")
    if {"year", "avg_temp", "city"} <= set(df.columns):
        charts["temp_by_city_year"] = temperature_lines(df)
    return charts


def _precipitation_charts(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "precip_by_year": precipitation_by_year(df),
        "precip_by_month": precipitation_by_month(df),
        "rainy_periods_by_city": rainy_periods(df),
        "precip_histogram": histogram(df, "total_precip"),
    }


def _seasonal_charts(df: DataFrame) -> dict[str, DataFrame]:
    return {"season_profile": season_profile(df), "season_radar": season_radar(df)}


def _alert_charts(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "alerts_by_level": value_counts(df, "overall_alert"),
        "alerts_by_severity": value_counts(df, "alert_severity", by_value=True),
        "alerts_top_cities": top_alert_cities(df),
        "alerts_by_month": alerts_by_month(df),
    }


def _comparison_charts(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "comparison_by_temp": comparison_sorted(df, "avg_temp_city"),
        "comparison_by_precip": comparison_sorted(df, "total_precip_city"),
        "climate_class_counts": value_counts(df, "climate_classification"),
        "comparison_scatter": comparison_scatter(df),
    }


# Topic -> (serving table key, charts of the filtered table).
TOPICS: dict[str, tuple[str, Callable[[DataFrame], dict[str, DataFrame]]]] = {
    "trends": ("trends", _temperature_charts),
    "temperature": ("summary", _temperature_charts),
    "precipitation": ("summary", _precipitation_charts),
    "seasonal": ("seasonal", _seasonal_charts),
    "alerts": ("alerts", _alert_charts),
    "comparison": ("comparison", _comparison_charts),
}


def analyse(topic: str, load: Callable[[str], DataFrame], filters: Filters | None = None) -> dict[str, DataFrame]:
    """The charts of a topic over its filtered table (V5); ``load`` maps a table key to a table."""
    key, charts = TOPICS[topic]
    return charts(apply_filters(load(key), filters))
