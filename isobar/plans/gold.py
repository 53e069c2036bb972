"""Gold tables, each a function from silver to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import values as V
from ..operators.quantiles import quantiles, value_counts
from ..operators.ranking import add_ranks
from ..schemas import GOLD_SCHEMAS, conform

STATION_MONTH = ["city", "region", "station", "year", "month"]
STATION = ["city", "region", "station", "lat", "lon"]

# Rank name -> metric of the comparison table.
COMPARED_METRICS = {
    "heat": "avg_temp_city",
    "precip": "total_precip_city",
    "humidity": "avg_humidity_city",
    "wind": "avg_wind_city",
    "sunshine": "total_sunshine_city",
}

INSIGHT_ROWS = 5


def _rounded(aggregate: Column, digits: int, name: str) -> Column:
    return F.round(aggregate, digits).alias(name)


def _day_tests() -> dict[str, Column]:
    """The day classes (A9); a day without the measure is in no class."""
    return {
        "hot_days": F.col("temp_max_c") > V.HOT_DAY_ABOVE,
        "cold_days": F.col("temp_min_c") < V.COLD_DAY_BELOW,
        "rainy_days": F.col("precip_mm") > V.RAINY_DAY_ABOVE,
        "windy_days": F.col("wind_avg_kmh") > V.WINDY_DAY_ABOVE,
        "humid_days": F.col("humidity_percent") > V.HUMID_DAY_ABOVE,
    }


class Daily:
    """Aggregates over silver rows."""

    def with_month(self, df: DataFrame) -> DataFrame:
        return df.withColumn("month", F.month("date"))

    def rows(self) -> Column:
        return F.count("*")

    def mean(self, measure: str) -> Column:
        return F.avg(measure)

    def total(self, measure: str) -> Column:
        return F.sum(measure)

    def highest(self, measure: str) -> Column:
        return F.max(measure)

    def lowest(self, measure: str) -> Column:
        return F.min(measure)

    def days(self, name: str) -> Column:
        return F.count_if(_day_tests()[name])

    def deviation(self) -> Column:
        return F.stddev_samp("temp_avg_c")

    def quartiles(self) -> Column:
        return F.percentile("temp_avg_c", [0.75, 0.25])


class Monthly:
    """The same aggregates over ``station_months`` rows, re-summed by any coarser key.

    Deviation and quartiles hold for the station month itself only.
    """

    def with_month(self, df: DataFrame) -> DataFrame:
        return df

    def rows(self) -> Column:
        return F.sum("rows")

    def mean(self, measure: str) -> Column:
        return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))

    def total(self, measure: str) -> Column:
        return F.sum(f"{measure}_sum")

    def highest(self, measure: str) -> Column:
        return F.max(f"{measure}_max")

    def lowest(self, measure: str) -> Column:
        return F.min(f"{measure}_min")

    def days(self, name: str) -> Column:
        return F.sum(name)

    def deviation(self) -> Column:
        return F.any_value("deviation")

    def quartiles(self) -> Column:
        return F.any_value("quartiles")


DAILY, MONTHLY = Daily(), Monthly()
AVERAGED = (
    "temp_avg_c", "precip_mm", "humidity_percent", "wind_avg_kmh", "pressure_hpa", "sunshine_min", "snow_depth_cm",
    "lat", "lon",
)


def station_months(silver: DataFrame) -> DataFrame:
    """Everything the tables by month, year or city need, per station and month.

    Built once, it replaces one pass over silver for each table of ``FROM_MONTHS``.
    """
    return DAILY.with_month(silver).groupBy(*STATION_MONTH).agg(
        DAILY.rows().alias("rows"),
        *[F.sum(m).alias(f"{m}_sum") for m in AVERAGED],
        *[F.count(m).alias(f"{m}_n") for m in AVERAGED],
        F.max("temp_max_c").alias("temp_max_c_max"),
        F.min("temp_min_c").alias("temp_min_c_min"),
        *[DAILY.days(name).alias(name) for name in _day_tests()],
        DAILY.deviation().alias("deviation"),
        DAILY.quartiles().alias("quartiles"),
    )


def city_yearly_summary(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """Monthly means, extremes and totals per station (A1); the grain is the month."""
    return use.with_month(silver).groupBy(*STATION_MONTH).agg(
        use.rows().alias("days"),
        _rounded(use.mean("temp_avg_c"), 2, "avg_temp"),
        _rounded(use.highest("temp_max_c"), 2, "max_temp"),
        _rounded(use.lowest("temp_min_c"), 2, "min_temp"),
        _rounded(use.total("precip_mm"), 2, "total_precip"),
        _rounded(use.total("sunshine_min"), 2, "total_sunshine"),
        _rounded(use.mean("humidity_percent"), 2, "avg_humidity"),
        _rounded(use.mean("lat"), 6, "lat"),
        _rounded(use.mean("lon"), 6, "lon"),
    )


def climate_profiles(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """One profile per city (A2); ``yearly_precip`` is the total over all years."""
    return silver.groupBy("city").agg(
        _rounded(use.mean("temp_avg_c"), 1, "avg_temp"),
        use.highest("temp_max_c").alias("record_high"),
        use.lowest("temp_min_c").alias("record_low"),
        use.total("precip_mm").alias("yearly_precip"),
        use.mean("sunshine_min").alias("avg_sunshine"),
        _rounded(use.mean("humidity_percent"), 1, "avg_humidity"),
    )


def city_extreme_days(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """Monthly extremes per station (A3)."""
    return use.with_month(silver).groupBy(*STATION_MONTH).agg(
        _rounded(use.highest("temp_max_c"), 2, "max_temp_month"),
        _rounded(use.lowest("temp_min_c"), 2, "min_temp_month"),
        _rounded(use.total("precip_mm"), 2, "total_precip_month"),
    )


def _month_as_text() -> Column:
    return F.lpad(F.col("month").cast("string"), 2, "0")


def monthly_stats(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """Monthly figures per city; year and month are text (A4)."""
    by_month = use.with_month(silver).groupBy("city", "year", _month_as_text().alias("month"))
    return by_month.agg(
        _rounded(use.mean("temp_avg_c"), 2, "avg_temp"),
        use.total("precip_mm").alias("total_precip"),
        use.mean("sunshine_min").alias("avg_sunshine"),
        use.mean("snow_depth_cm").alias("avg_snow_depth"),
    )


def weather_trends(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """Yearly figures per city (A5)."""
    return silver.groupBy("city", "year").agg(
        _rounded(use.mean("temp_avg_c"), 2, "avg_temp"), use.total("precip_mm").alias("total_precip")
    )


def seasonal_analysis(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """Monthly distribution figures per station, with the season.

    The exact percentiles hold one group's distinct temperatures in memory: a city, year
    and month has at most 31 days per source, by the key of the raw table.
    """
    if use is DAILY:
        # the year stays that of the partition column, so that a filter on it prunes
        silver = silver.filter(X.present("temp_avg_c", "date")).withColumn("year", F.col("year").cast("int"))
    grouped = use.with_month(silver).groupBy(*STATION_MONTH).agg(
        use.mean("temp_avg_c").alias("avg_temp_season"),
        use.highest("temp_max_c").alias("max_temp_season"),
        use.lowest("temp_min_c").alias("min_temp_season"),
        use.total("precip_mm").alias("total_precip_season"),
        use.mean("humidity_percent").alias("avg_humidity_season"),
        use.mean("wind_avg_kmh").alias("avg_wind_season"),
        use.mean("pressure_hpa").alias("avg_pressure_season"),
        use.total("sunshine_min").alias("total_sunshine_season"),
        use.mean("snow_depth_cm").alias("avg_snow_season"),
        use.rows().alias("total_days"),
        *[use.days(name).alias(name) for name in _day_tests()],
        use.deviation().alias("temp_variability"),
        use.quartiles().alias("_quartiles"),
    )
    finished = grouped.withColumns(
        {
            "season": X.season(F.col("month")),
            "temp_75th_percentile": F.col("_quartiles")[0],
            "temp_25th_percentile": F.col("_quartiles")[1],
        }
    )
    return conform(finished, GOLD_SCHEMAS["seasonal_analysis"])


def temperature_counts(silver: DataFrame) -> DataFrame:
    """How often each mean temperature occurs in a station's month: quartiles of any coarser key add up from it."""
    rows = DAILY.with_month(silver).withColumn("season", X.season(F.month("date")))
    return value_counts(rows, [*STATION_MONTH, "season"], "temp_avg_c")


def season_quartiles(counts: DataFrame, keys: tuple[str, ...] = ("city", "season")) -> DataFrame:
    """Quartiles of the mean temperature for a coarser key than the month (A6), from ``temperature_counts``."""
    return quantiles(counts, list(keys), "temp_avg_c", {"temp_75th_percentile": 0.75, "temp_25th_percentile": 0.25})


def weather_alerts(silver: DataFrame) -> DataFrame:
    """The graded days: every day outside the unremarkable range."""
    tmax, tmin = F.col("temp_max_c"), F.col("temp_min_c")
    precip, humidity = F.col("precip_mm"), F.col("humidity_percent")
    remarkable = (
        (tmax > V.WARM_ABOVE)
        | (tmin < V.COLD_ALERTS[-1][0])
        | (precip > V.PRECIPITATION_ALERTS[-1][0])
        | X.odd_humidity(humidity)
    )
    graded = silver.filter(remarkable).withColumns(
        {
            "year": F.col("year").cast("long"),
            "month": F.month("date").cast("long"),
            "temp_max": tmax,
            "temp_min": tmin,
            "temperature_alert": X.temperature_alert(tmax, tmin),
            "precipitation_alert": X.precipitation_alert(precip),
            "humidity_alert": X.humidity_alert(humidity),
            "overall_alert": X.overall_alert(tmax, tmin, precip, humidity),
            "alert_severity": X.alert_severity(tmax, tmin, precip, humidity),
        }
    )
    return conform(graded, GOLD_SCHEMAS["weather_alerts"])


def station_profile(silver: DataFrame) -> DataFrame:
    """Overall figures per located station."""
    located = silver.filter(X.present("temp_avg_c", "lat", "lon"))
    return located.groupBy(*STATION).agg(
        F.avg("temp_avg_c").alias("avg_temp_city"),
        F.max("temp_max_c").alias("max_temp_city"),
        F.min("temp_min_c").alias("min_temp_city"),
        F.sum("precip_mm").alias("total_precip_city"),
        F.avg("humidity_percent").alias("avg_humidity_city"),
        F.avg("wind_avg_kmh").alias("avg_wind_city"),
        F.avg("pressure_hpa").alias("avg_pressure_city"),
        F.sum("sunshine_min").alias("total_sunshine_city"),
        F.count("*").alias("total_days"),
        *[DAILY.days(name).alias(name) for name in ("hot_days", "cold_days", "rainy_days", "windy_days")],
    )


def climate_comparison(silver: DataFrame) -> DataFrame:
    """Stations compared: classes, ranks overall and in region, day shares, comfort."""
    ranked = add_ranks(station_profile(silver), COMPARED_METRICS, STATION, "region")
    temp, precip, humidity = F.col("avg_temp_city"), F.col("total_precip_city"), F.col("avg_humidity_city")
    shares = {
        f"pct_{name}": X.percent(F.col(name), F.col("total_days"))
        for name in ("hot_days", "cold_days", "rainy_days", "windy_days")
    }
    finished = ranked.withColumns(
        {
            "climate_classification": X.climate_class(temp, precip),
            "climate_comfort_score": X.comfort_score(temp, precip, humidity),
            **shares,
        }
    )
    return conform(finished, GOLD_SCHEMAS["climate_comparison"])


def _season_precipitation(silver: DataFrame, season: str, use: Daily | Monthly) -> DataFrame:
    in_season = use.with_month(silver).filter(F.col("month").isin(*V.SEASON_MONTHS[season]))
    return (
        in_season.groupBy("city", _month_as_text().alias("month"))
        .agg(_rounded(use.total("precip_mm"), 2, "insight_precip"))
        .select("city", "insight_precip", "month")
    )


def min_precipitation(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """The five largest summer totals (A8, L2); the table is named for the season's dryness."""
    return (
        _season_precipitation(silver, "Verano", use)
        .orderBy(F.desc_nulls_last("insight_precip"), "city", "month")
        .limit(INSIGHT_ROWS)
    )


def max_precipitation(silver: DataFrame, use: Daily | Monthly = DAILY) -> DataFrame:
    """The five smallest winter totals (A8, L2); the table is named for the season's wetness."""
    return (
        _season_precipitation(silver, "Invierno", use)
        .orderBy(F.asc_nulls_last("insight_precip"), "city", "month")
        .limit(INSIGHT_ROWS)
    )


GOLD_TABLES: dict[str, Callable[..., DataFrame]] = {
    "city_yearly_summary": city_yearly_summary,
    "climate_profiles": climate_profiles,
    "city_extreme_days": city_extreme_days,
    "monthly_stats": monthly_stats,
    "weather_trends": weather_trends,
    "seasonal_analysis": seasonal_analysis,
    "weather_alerts": weather_alerts,
    "climate_comparison": climate_comparison,
    "min_precipitation": min_precipitation,
    "max_precipitation": max_precipitation,
}

# Tables that can be built from station_months with MONTHLY instead of from silver.
FROM_MONTHS = (
    "city_yearly_summary", "climate_profiles", "city_extreme_days", "monthly_stats", "weather_trends",
    "seasonal_analysis", "min_precipitation", "max_precipitation",
)

# Reading order of the tables that have one (L1); NULL metrics last.
DEFAULT_ORDER = {
    "climate_comparison": [("region", True), ("avg_temp_city", False)],
    "seasonal_analysis": [("city", True), ("year", True), ("month", True)],
    "weather_alerts": [("date", False), ("alert_severity", False)],
}


def in_default_order(df: DataFrame, table: str) -> DataFrame:
    """A gold table sorted for reading (L1); equal rows follow by place and source."""
    order = [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in DEFAULT_ORDER.get(table, [])]
    ties = [F.asc_nulls_last(c) for c in ("city", "station", "source") if c in df.columns]
    return df.orderBy(*order, *ties) if order else df
