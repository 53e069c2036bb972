"""Silver: the cleaned observation table (P5, P6) and its snapshot (K7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import present, year_text
from ..schemas import SILVER_SCHEMA, conform

# --- Fixed values: silver name of each raw measure ------------------------------------
MEASURE_NAMES = {
    "tavg": "temp_avg_c",
    "tmin": "temp_min_c",
    "tmax": "temp_max_c",
    "prcp": "precip_mm",
    "wdir": "wind_dir_deg",
    "wspd": "wind_avg_kmh",
    "wpgt": "wind_gust_kmh",
    "pres": "pressure_hpa",
    "snow": "snow_depth_cm",
    "tsun": "sunshine_min",
    "rhum": "humidity_percent",
}
# Plausible temperatures (°C); the check is off unless asked for.
TEMPERATURE_RANGES = {"tavg": (-50, 60), "tmin": (-60, 60), "tmax": (-60, 70)}


def clean(raw: DataFrame, as_of: Column | None = None, check_ranges: bool = False) -> DataFrame:
    """Rename and type the raw rows that have a date and all three temperatures."""
    kept = raw.filter(present("date", "tavg", "tmin", "tmax"))
    if check_ranges:
        for name, (low, high) in TEMPERATURE_RANGES.items():
            kept = kept.filter(F.col(name).between(low, high))
    day = F.col("date").cast("date")
    named = kept.withColumnsRenamed(MEASURE_NAMES).withColumns(
        {"date": day, "year": year_text(day), "ingestion_date": as_of if as_of is not None else F.current_timestamp()}
    )
    return conform(named, SILVER_SCHEMA)


def laid_out(silver: DataFrame) -> DataFrame:
    """Silver with the columns that its files are cut and sorted by: ``city_key`` folds the city's case."""
    return silver.withColumns({"city_key": F.lower("city"), "ym": F.date_format("date", "yyyy-MM")})


#: How silver rows lie in a file.
FILE_ORDER = ("city_key", "date")


def snapshot(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Silver with the moment it was copied (K7)."""
    return silver.withColumn("snapshot_timestamp", as_of if as_of is not None else F.current_timestamp())
