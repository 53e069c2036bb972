"""Row positions over a whole table (W1, W2, deep pages).

A window without partitions would put the whole table into one task.  Rows are instead dealt to
ranges of the full order, numbered inside each range, and shifted by the sizes of the ranges before
it.  The bounds of the ranges are quantiles of a bounded sample, the rows with the least hashes, so
the same rows give the same bounds; they are a scalar of the plan, and a row's range an expression.
Building the plan runs and writes nothing.  Orders end with the table's key, so equal or missing
values - even a third of all rows - are still spread over the ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of a table, and rows sampled for their bounds.
RANGES, SAMPLED = 32, 2048

Order = list[tuple[str, bool]]  # (column, ascending); missing values last


def sorted_by(order: Order) -> list[Column]:
    return [F.asc_nulls_last(name) if up else F.desc_nulls_last(name) for name, up in order]


def _place(df: DataFrame, order: Order) -> Column:
    """One value that compares as rows do in ``order``: rising for every column, missing values last."""

    def rising(name: str, up: bool) -> Column:
        column, kind = F.col(name), df.schema[name].dataType
        if up:
            return column
        if isinstance(kind, T.StringType):
            # the hexadecimal digits turned round, and an end that comes behind them all
            return F.concat(F.translate(F.hex(column), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
        if isinstance(kind, T.DateType):
            return -F.unix_date(column)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.bitwise_not(F.unix_micros(column.cast("timestamp")))
        return F.bitwise_not(column.cast("long")) if isinstance(kind, (T.IntegralType, T.BooleanType)) else -column

    parts = [(F.col(n).isNull().alias(f"no{i}"), rising(n, up).alias(f"v{i}")) for i, (n, up) in enumerate(order)]
    return F.struct(*[x for pair in parts for x in pair])


def with_range(df: DataFrame, order: Order, within: str | None = None) -> DataFrame:
    """``_range``, the number of a row's range from 0: how many bounds come before it.

    The bounds are a scalar of the plan, evenly spaced among the sampled rows; with ``within`` (a
    column of few values) they are apart for each of its values.
    """
    placed = df.withColumn("_place", _place(df, order))
    apart = F.col(within) if within else F.lit("")
    few = placed.select(apart.alias("kind"), F.col("_place").alias("place")).withColumn("hash", F.xxhash64("kind", "place")).orderBy("hash", "kind", "place").limit(SAMPLED)

    def spaced(rows: Column) -> Column:
        step = F.greatest(F.lit(1), F.floor(F.size(rows) / RANGES))
        return F.filter(rows, lambda _, i: (i + 1) % step == 0)

    sorted_ = few.agg(F.sort_array(F.collect_list(F.struct("kind", "place"))).alias("rows"))
    of_kind = lambda k: F.transform(F.filter("rows", lambda r: r["kind"] == k), lambda r: r["place"])
    listed = F.transform(
        F.array_distinct(F.transform("rows", lambda r: r["kind"])), lambda k: F.struct(k.alias("key"), of_kind(k).alias("places"))
    )
    # a step of its own, so that a kind's list is made once and not for each of its rows
    by_kind = F.transform(listed, lambda x: F.struct(x["key"].alias("key"), spaced(x["places"]).alias("value")))
    limits = sorted_.select(F.map_from_entries(by_kind).alias("limits")).scalar()
    # a scalar of the plan has to be a column before a function of higher order may use it
    held = placed.withColumn("_limits", F.try_element_at(limits, apart))
    # the place as a variable: made once for a row and not for each bound
    before = F.transform(F.array("_place"), lambda p: F.size(F.filter("_limits", lambda b: b < p)))
    number = F.coalesce(F.get(before, F.lit(0)), F.lit(0))
    return held.withColumn("_range", F.greatest(number, F.lit(0))).drop("_limits", "_place")


def number_rows(df: DataFrame, order: Order, position: str, group: str | None = None,
                group_position: str | None = None, within: str | None = None) -> DataFrame:
    """Add the 1-based position in ``order`` over all rows and, if asked, within ``group``.

    With ``within``, a column of few values, rows are numbered apart for each of them.
    """
    apart = [within] if within else []
    tagged = with_range(df, order, within)
    keys = [*apart, "_range", *([group] if group else [])]
    sizes = tagged.groupBy(*keys).agg(F.count("*").alias("_size"))
    before = lambda *by: F.coalesce(F.sum("_size").over(Window.partitionBy(*by).orderBy("_range").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a few rows for each value of the group
    shifts = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], before(*apart).alias("_shift"),
        *([before(*apart, group).alias("_group_shift")] if group else []),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*sorted_by(order)))
    placed = tagged.withColumn("_n", place(*apart, "_range"))
    if group:
        placed = placed.withColumn("_group_n", place(*apart, "_range", group))
    found = placed.join(shifts, same).withColumn(position, (F.col("_n") + F.col("_shift")).cast("long"))
    if group:
        found = found.withColumn(group_position, (F.col("_group_n") + F.col("_group_shift")).cast("long"))
    return found.drop("_n", "_group_n", "_range", *shifts.columns)


def rows_between(df: DataFrame, order: Order, first: int, last: int) -> DataFrame:
    """Rows at the positions ``first`` to ``last``: only ranges that hold some of them are moved and sorted."""
    tagged = with_range(df, order)
    sizes = tagged.groupBy("_range").agg(F.count("*").alias("n"))
    held = sizes.agg(F.collect_list(F.struct("_range", "n")).alias("held"))  # one entry for each range
    # starts[r]: rows in the ranges before r; sampling may give twice the ranges
    starts = held.select(
        F.transform(
            F.sequence(F.lit(0), F.lit(2 * RANGES + 1)),
            lambda r: F.aggregate(F.filter("held", lambda h: h["_range"] < r), F.lit(0).cast("long"), lambda a, h: a + h["n"]),
        ).alias("starts")
    ).scalar()
    start, end = F.get(starts, F.col("_range")), F.get(starts, F.col("_range") + 1)
    holding = tagged.withColumn("_start", start).filter((F.col("_start") < last) & (end >= first))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*sorted_by(order))) + F.col("_start")
    numbered = holding.withColumn("_position", number).filter(F.col("_position").between(first, last))
    return numbered.drop("_position", "_range", "_start").orderBy(*sorted_by(order))


def add_ranks(df: DataFrame, metrics: dict[str, str], keys: list[str], group: str) -> DataFrame:
    """``<name>_rank_overall`` and ``<name>_rank_in_<group>`` for each name -> metric, best first.

    ``keys`` name a row.  All metrics are ranked together as rows of key and value, the first of
    which bears the whole row, so that ``df`` is worked out once and not joined to its ranks.
    """
    named = dict.fromkeys([*keys, group])
    whole = F.struct(*df.columns)
    absent = F.lit(None).cast(df.select(whole.alias("_row")).schema["_row"].dataType)
    values = F.array(
        *[
            F.struct(F.lit(n).alias("_metric"), F.col(m).cast("double").alias("_value"), (absent if i else whole).alias("_row"))
            for i, (n, m) in enumerate(metrics.items())
        ]
    )
    order = [("_value", False), *[(k, True) for k in keys]]
    ranked = number_rows(df.select(*named, F.inline(values)), order, "_overall", group, "_inside", within="_metric")
    place = lambda name, column: F.max(F.when(F.col("_metric") == name, F.col(column)))
    rows = ranked.groupBy(*keys).agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        *[place(n, "_overall").alias(f"{n}_rank_overall") for n in metrics],
        *[place(n, "_inside").alias(f"{n}_rank_in_{group}") for n in metrics],
    )
    ranks = [f"{n}_rank_{kind}" for kind in ("overall", f"in_{group}") for n in metrics]
    return rows.select("_row.*", *ranks)
