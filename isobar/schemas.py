"""Column names and types of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURES = ["tavg", "tmin", "tmax", "prcp", "wdir", "wspd", "wpgt", "pres", "snow", "tsun", "rhum"]
RAW_KEY = ["date", "city", "source"]


_TYPES = {
    "date": T.DateType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    # "name type, ..." without needing a running session, unlike StructType.fromDDL
    pairs = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_SCHEMA = _struct(
    "date date, " + ", ".join(f"{m} double" for m in MEASURES)
    + ", station string, source string, city string, region string, lat double, lon double"
)

SILVER_SCHEMA = _struct(
    "date date, city string, region string, station string, lat double, lon double, year string, "
    "temp_avg_c double, temp_min_c double, temp_max_c double, precip_mm double, wind_dir_deg double, "
    "wind_avg_kmh double, wind_gust_kmh double, pressure_hpa double, snow_depth_cm double, "
    "sunshine_min double, humidity_percent double, source string, ingestion_date timestamp"
)

CITY_SCHEMA = _struct("name string, latitude double, longitude double, elevation double, region string")

# Provider A lands every value as text; provider B lands typed numbers inside {"data": [...]}.
PROVIDER_A_SCHEMA = _struct(
    "fecha string, tmed string, tmin string, tmax string, prec string, dir string, "
    "velmedia string, racha string, hrMedia string"
)
# Numbers are read as text too, so that one malformed value rejects one row and not its file.
PROVIDER_B_FIELDS = ["date", *MEASURES]
PROVIDER_B_SCHEMA = T.StructType(
    [T.StructField("data", T.ArrayType(_struct(", ".join(f"{c} string" for c in PROVIDER_B_FIELDS))))]
)

STATION_SCHEMA = _struct("indicativo string, latitud string, longitud string")

GOLD_SCHEMAS: dict[str, T.StructType] = {
    "city_yearly_summary": _struct(
        "city string, region string, station string, year string, month int, days bigint, avg_temp double, "
        "max_temp double, min_temp double, total_precip double, total_sunshine double, avg_humidity double, "
        "lat double, lon double"
    ),
    "climate_profiles": _struct(
        "city string, avg_temp double, record_high double, record_low double, yearly_precip double, "
        "avg_sunshine double, avg_humidity double"
    ),
    "city_extreme_days": _struct(
        "city string, region string, station string, year string, month int, max_temp_month double, "
        "min_temp_month double, total_precip_month double"
    ),
    "monthly_stats": _struct(
        "city string, year string, month string, avg_temp double, total_precip double, avg_sunshine double, "
        "avg_snow_depth double"
    ),
    "weather_trends": _struct("city string, year string, avg_temp double, total_precip double"),
    "seasonal_analysis": _struct(
        "city string, region string, station string, year bigint, month bigint, season string, "
        "avg_temp_season double, max_temp_season double, min_temp_season double, total_precip_season double, "
        "avg_humidity_season double, avg_wind_season double, avg_pressure_season double, "
        "total_sunshine_season double, avg_snow_season double, total_days bigint, hot_days bigint, "
        "cold_days bigint, rainy_days bigint, windy_days bigint, humid_days bigint, temp_variability double, "
        "temp_75th_percentile double, temp_25th_percentile double"
    ),
    "weather_alerts": _struct(
        "city string, region string, station string, date date, year bigint, month bigint, temp_max double, "
        "temp_min double, precip_mm double, humidity_percent double, wind_avg_kmh double, pressure_hpa double, "
        "sunshine_min double, temperature_alert string, precipitation_alert string, humidity_alert string, "
        "overall_alert string, alert_severity int, source string, ingestion_date timestamp"
    ),
    "climate_comparison": _struct(
        "city string, region string, station string, lat double, lon double, avg_temp_city double, "
        "max_temp_city double, min_temp_city double, total_precip_city double, avg_humidity_city double, "
        "avg_wind_city double, avg_pressure_city double, total_sunshine_city double, total_days bigint, "
        "hot_days bigint, cold_days bigint, rainy_days bigint, windy_days bigint, climate_classification string, "
        "heat_rank_overall bigint, heat_rank_in_region bigint, precip_rank_overall bigint, "
        "precip_rank_in_region bigint, humidity_rank_overall bigint, humidity_rank_in_region bigint, "
        "wind_rank_overall bigint, wind_rank_in_region bigint, sunshine_rank_overall bigint, "
        "sunshine_rank_in_region bigint, pct_hot_days double, pct_cold_days double, pct_rainy_days double, "
        "pct_windy_days double, climate_comfort_score int"
    ),
    "min_precipitation": _struct("city string, insight_precip double, month string"),
    "max_precipitation": _struct("city string, insight_precip double, month string"),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast, filling absent ones with typed NULLs."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
