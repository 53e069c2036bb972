"""Requests in the trailing minute, per source.

Time is cut into slices that overlap by the trailing span, so that one busy source is
spread over as many tasks as it has slices.  A row counts as output in exactly one
slice, where all its predecessors within the span are present too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.expressions import first_match

SLICE_SECONDS = 600


def trailing_requests(log: DataFrame, source: str = "source", ts: str = "ts",
                      seconds: int = V.REQUEST_WINDOW_SECONDS) -> DataFrame:
    """Per source and instant: requests at it, and in the ``seconds`` up to it inclusive.

    Requests of one instant are counted before the shuffle.
    """
    instants = log.groupBy(F.col(source).alias("source"), F.col(ts).alias("ts")).agg(F.count("*").alias("requests"))
    sliced = instants.withColumn(
        "slice", F.window("ts", f"{SLICE_SECONDS + seconds} seconds", f"{SLICE_SECONDS} seconds")["start"]
    )
    trailing = F.expr(
        "sum(requests) over (partition by source, slice order by ts "
        f"range between interval {int(seconds)} seconds preceding and current row)"
    )
    return (
        sliced.withColumn("trailing_requests", trailing)
        .filter(F.col("ts") >= F.col("slice") + F.expr(f"interval {int(seconds)} seconds"))
        .drop("slice")
    )


def usage_level(trailing: Column, cap: Column) -> Column:
    """``high``, ``moderate`` or ``normal`` share of the cap in use."""
    used = F.try_divide(trailing * F.lit(100.0), cap)
    return first_match(
        [(used > V.HIGH_USAGE_ABOVE, F.lit("high")), (used > V.MODERATE_USAGE_ABOVE, F.lit("moderate"))], "normal"
    )


def usage(log: DataFrame, cap: Column | int, source: str = "source", ts: str = "ts") -> DataFrame:
    """Trailing requests against ``cap``, with level and excess flag."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    counted = trailing_requests(log, source, ts)
    return counted.withColumns(
        {
            "usage_pct": F.round(F.try_divide(F.col("trailing_requests") * F.lit(100.0), cap), 2),
            "usage_level": usage_level(F.col("trailing_requests"), cap),
            "over_cap": F.col("trailing_requests") > cap,
        }
    )


def source_cap(source: Column) -> Column:
    """Cap of each known source, NULL for others."""
    return first_match([(source == name, F.lit(cap)) for name, cap in V.REQUEST_CAPS.items()], None)
