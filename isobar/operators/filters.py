"""Serving filters as one conjunction of column predicates."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which columns express a temperature or precipitation bound; the first present one counts.
TEMPERATURE_COLUMNS = ("avg_temp", "avg_temp_season", "avg_temp_city", "temp_max", "temp_max_c")
PRECIPITATION_COLUMNS = (
    "total_precip", "total_precip_season", "total_precip_city", "total_precip_month", "yearly_precip", "precip_mm",
)


@dataclass(frozen=True)
class Filters:
    """Criteria of a serving read; None and empty lists do not filter, 0 does.

    ``year``, ``month``, ``region`` and ``cities`` take one value or a list.
    """

    year: int | str | list | None = None
    month: int | str | list | None = None
    region: str | list | None = None
    cities: str | list | None = None
    season: str | None = None
    alert_level: str | None = None
    min_temp: float | None = None
    max_temp: float | None = None
    max_precip: float | None = None
    source: str | None = None
    date_range: tuple[date, date] | None = None

    def active(self) -> dict:
        given = {f.name: getattr(self, f.name) for f in fields(self)}
        return {k: v for k, v in given.items() if v is not None and v != []}


def _one_of(column: Column, wanted) -> Column:
    return column.isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else column == wanted


def _as_ints(wanted):
    return [int(v) for v in wanted] if isinstance(wanted, (list, tuple, set)) else int(wanted)


def _first_present(df: DataFrame, names: tuple[str, ...]) -> str | None:
    return next((name for name in names if name in df.columns), None)


def _month_column(df: DataFrame) -> Column | None:
    if "month" in df.columns:
        return F.col("month").cast("int")
    return F.month("date") if "date" in df.columns else None


def predicates(df: DataFrame, filters: Filters) -> list[Column]:
    """Predicates for the criteria this table can express; others are skipped."""
    temperature = _first_present(df, TEMPERATURE_COLUMNS)
    precipitation = _first_present(df, PRECIPITATION_COLUMNS)
    month = _month_column(df)
    has = set(df.columns)
    found: list[Column] = []
    for name, wanted in filters.active().items():
        if name == "year" and "year" in has:
            found.append(_one_of(F.col("year").cast("int"), _as_ints(wanted)))
        elif name == "month" and month is not None:
            found.append(_one_of(month, _as_ints(wanted)))
        elif name == "region" and "region" in has:
            found.append(_one_of(F.col("region"), wanted))
        elif name == "cities" and "city" in has:
            found.append(_one_of(F.col("city"), wanted))
        elif name == "season" and "season" in has:
            found.append(F.col("season") == wanted)
        elif name == "alert_level" and "overall_alert" in has:
            found.append(F.col("overall_alert") == wanted)
        elif name == "min_temp" and temperature:
            found.append(F.col(temperature) >= wanted)
        elif name == "max_temp" and temperature:
            found.append(F.col(temperature) <= wanted)
        elif name == "max_precip" and precipitation:
            found.append(F.col(precipitation) <= wanted)
        elif name == "source" and "source" in has:
            found.append(F.lower("source") == wanted.lower())
        elif name == "date_range" and "date" in has:
            found.append(F.col("date").between(*[F.lit(d).cast("date") for d in wanted]))
    return found


def apply_filters(df: DataFrame, filters: Filters | None) -> DataFrame:
    found = predicates(df, filters) if filters else []
    return df.filter(reduce(lambda a, b: a & b, found)) if found else df
