"""Map feature tables: one styled point per row of a serving table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import values as V

# --- Fixed values: name parts that select a map's columns -------------------------------
MAP_NAME_PARTS = {
    "temperature": ("temp", "city", "year", "month", "lat", "lon"),
    "precipitation": ("precip", "rain", "city", "year", "month", "lat", "lon"),
    "alerts": ("alert", "severity", "city", "date", "lat", "lon"),
    "comparison": ("climate", "classification", "city", "temp", "precip", "lat", "lon"),
}


def map_columns(df: DataFrame, map_type: str) -> DataFrame:
    """The columns whose names concern a map type; all columns for an unknown type."""
    parts = MAP_NAME_PARTS.get(map_type)
    kept = [c for c in df.columns if parts is None or any(p in c.lower() for p in parts)]
    return df.select(*kept)


def city_coordinates(silver: DataFrame) -> DataFrame:
    """Distinct known positions per city."""
    return silver.select("city", "lat", "lon").filter(X.present("lat", "lon")).distinct()


def _placed(df: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Rows with their city's first position; rows of unplaced cities are left out."""
    one = coordinates.groupBy("city").agg(F.min(F.struct("lat", "lon")).alias("place"))
    positions = one.select("city", F.col("place.lat").alias("lat"), F.col("place.lon").alias("lon"))
    return df.drop("lat", "lon").join(positions, "city")


def _label(value: Column, unit: str) -> Column:
    # "city: value unit"; a missing value is written N/A
    text = F.coalesce(value.cast("string"), F.lit("N/A"))
    return F.concat(X.capitalized(F.col("city")), F.lit(": "), text, F.lit(unit))


def temperature_map(summary: DataFrame, coordinates: DataFrame, metric: str = "avg_temp") -> DataFrame:
    value = F.col(metric)
    return _placed(summary, coordinates).select(
        "city", "lat", "lon",
        value.alias("value"),
        X.temperature_color(value).alias("color"),
        X.marker_radius(value, metric).alias("radius"),
        _label(value, "°C").alias("label"),
        "avg_temp", "max_temp", "min_temp", "total_precip", "avg_humidity", "year", "month",
    )


def precipitation_map(summary: DataFrame, coordinates: DataFrame, metric: str = "total_precip") -> DataFrame:
    value = F.col(metric)
    return _placed(summary, coordinates).select(
        "city", "lat", "lon",
        value.alias("value"),
        X.precipitation_color(value).alias("color"),
        X.marker_radius(value, metric).alias("radius"),
        _label(value, " mm").alias("label"),
        "total_precip", "avg_temp", "avg_humidity", "total_sunshine", "year", "month",
    )


def alert_map(alerts: DataFrame, coordinates: DataFrame) -> DataFrame:
    level = F.col("overall_alert")
    return _placed(alerts, coordinates).select(
        "city", "lat", "lon",
        X.lookup_color(level, V.ALERT_COLORS).alias("color"),
        X.alert_radius(F.col("alert_severity")).alias("radius"),
        _label(level, "").alias("label"),
        "overall_alert", "temperature_alert", "precipitation_alert", "humidity_alert",
        "alert_severity", "date", "temp_max", "precip_mm",
    )


def comparison_map(comparison: DataFrame, coordinates: DataFrame) -> DataFrame:
    climate = F.col("climate_classification")
    return _placed(comparison, coordinates).select(
        "city", "lat", "lon",
        X.lookup_color(climate, V.CLIMATE_COLORS).alias("color"),
        X.climate_radius(F.col("avg_temp_city")).alias("radius"),
        _label(climate, "").alias("label"),
        "station", "avg_temp_city", "total_precip_city", "avg_humidity_city", "climate_classification",
        "heat_rank_in_region", "precip_rank_in_region", "hot_days", "rainy_days",
    )
