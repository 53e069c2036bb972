"""Small hand-made inputs."""

import contextlib
import io
from datetime import date, datetime

from isobar.schemas import SILVER_SCHEMA

_DEFAULTS = {
    "date": date(2021, 1, 15), "city": "Sevilla", "region": "Andalucia", "station": "S1", "lat": 37.0, "lon": -6.0,
    "year": None, "temp_avg_c": 15.0, "temp_min_c": 10.0, "temp_max_c": 20.0, "precip_mm": 0.0, "wind_dir_deg": 10.0,
    "wind_avg_kmh": 5.0, "wind_gust_kmh": 9.0, "pressure_hpa": 1000.0, "snow_depth_cm": None, "sunshine_min": 60.0,
    "humidity_percent": 50.0, "source": "aemet", "ingestion_date": datetime(2025, 1, 1),
}


def silver(spark, *overrides):
    rows = []
    for given in overrides:
        row = {**_DEFAULTS, **given}
        row["year"] = row["year"] or f"{row['date'].year:04d}"
        rows.append(tuple(row[f.name] for f in SILVER_SCHEMA))
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def one(df):
    found = df.collect()
    assert len(found) == 1, found
    return found[0].asDict()


def types(df_or_schema):
    """Names and types without nullability."""
    schema = getattr(df_or_schema, "schema", df_or_schema)
    return [(f.name, f.dataType) for f in schema]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
