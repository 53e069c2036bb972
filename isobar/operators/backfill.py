"""Backfill plan: the date windows to fetch for each station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed value: months per request -------------------------------------------------
WINDOW_MONTHS = 6


def backfill_windows(ranges: DataFrame) -> DataFrame:
    """One row per station and window; ``ranges`` has station, start_date, end_date.

    Up to six calendar months apart, start and end stay one window.  Longer ranges are
    cut at the last day of every sixth month, counting the month of the start.
    """
    months_apart = (F.year("end_date") - F.year("start_date")) * 12 + F.month("end_date") - F.month("start_date")
    first = F.trunc("start_date", "month")
    starts = F.when(
        months_apart > WINDOW_MONTHS,
        F.sequence(first, F.col("end_date"), F.expr(f"interval {WINDOW_MONTHS} months")),
    ).otherwise(F.array(first))
    to_last_month = F.last_day(F.add_months("window_month", WINDOW_MONTHS - 1))
    return (
        ranges.filter(F.col("start_date") <= F.col("end_date"))
        .withColumn("_single", months_apart <= WINDOW_MONTHS)
        .select("station", "start_date", "end_date", "_single", F.posexplode(starts).alias("window_no", "window_month"))
        .select(
            "station",
            (F.col("window_no") + 1).alias("window_no"),
            F.greatest("start_date", "window_month").alias("window_start"),
            F.when(F.col("_single"), F.col("end_date"))
            .otherwise(F.least("end_date", to_last_month))
            .alias("window_end"),
        )
    )
