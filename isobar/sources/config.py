"""The city dimension and date range."""

from __future__ import annotations

import json
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..functions import values as V
from ..schemas import CITY_SCHEMA


class Settings(NamedTuple):
    cities: DataFrame
    start_date: str
    end_date: str


def load_settings(spark: SparkSession, path: str | None = None) -> Settings:
    """Cities and dates from a YAML or JSON file, or the default 16 cities."""
    if path is None:
        return Settings(spark.createDataFrame(list(V.DEFAULT_CITIES), CITY_SCHEMA), V.DEFAULT_START, V.DEFAULT_END)
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        parsed = json.loads(text)
    else:
        import yaml  # optional: only needed for YAML files

        parsed = yaml.safe_load(text)
    rows = [
        (c["name"], float(c["latitude"]), float(c["longitude"]), float(c["elevation"]), c["region"])
        for c in parsed["cities"]
    ]
    rows = list({row[0]: row for row in reversed(rows)}.values())[::-1]  # the first entry of a name counts
    return Settings(
        spark.createDataFrame(rows, CITY_SCHEMA), str(parsed["start_date"]), str(parsed["end_date"])
    )
