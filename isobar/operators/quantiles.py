"""Exact quantiles from counts of values, which add up over any coarser key.

Values are counted by hash aggregation and read off a running sum, so no group's values are ever
held in one object: a group costs a row for each different value, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The keys, the value and ``n``: how many rows have it; missing values are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def quantiles(counts: DataFrame, keys: list[str], value: str, named: dict[str, float]) -> DataFrame:
    """Quantiles (name -> share) of each key, interpolated between neighbours; ``counts`` may be of finer keys."""
    summed = counts.groupBy(*keys, value).agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    placed = summed.select(
        *keys, value, F.sum("n").over(group.orderBy(value)).alias("upto"), F.sum("n").over(group).alias("all")
    )

    def at(place):
        # the value at a place counted from 0
        return F.min(F.when(F.col("upto") > place, F.col(value)))

    aggregates = [F.max("all").alias("_all")]
    for name, share in named.items():
        place = F.lit(share) * (F.col("all") - 1)
        aggregates += [at(F.floor(place)).alias(f"_low_{name}"), at(F.ceil(place)).alias(f"_high_{name}")]
    found = placed.groupBy(*keys).agg(*aggregates)

    def between(name, share):
        place = F.lit(share) * (F.col("_all") - 1)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return found.select(*keys, *[between(name, share) for name, share in named.items()])
