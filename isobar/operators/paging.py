"""Sorted pages of a table, their metadata, and the display projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as V
from .filters import Filters, apply_filters
from .ranking import Order, rows_between, sorted_by

#: The deepest row of a page that is read as a top-k.
SHALLOW = 5000

# --- Fixed values: sortable columns -----------------------------------------------------
SORTABLE = ("city", "year", "month")
SORTABLE_EXTRA = {
    "summary": ("avg_temp", "total_precip", "avg_humidity"),
    "alerts": ("overall_alert", "alert_severity", "date"),
}

# Unique key of each table, the tie-break of every page order.
TABLE_KEYS = {
    "summary": ("city", "region", "station", "year", "month"),
    "extreme": ("city", "region", "station", "year", "month"),
    "trends": ("city", "year"),
    "climate": ("city",),
    "alerts": ("city", "date", "source"),
    "seasonal": ("city", "region", "station", "year", "month"),
    "comparison": ("city", "region", "station", "lat", "lon"),
}


def sort_columns(table_key: str, df: DataFrame) -> list[str]:
    """Columns a table may be sorted by."""
    return [c for c in (*SORTABLE, *SORTABLE_EXTRA.get(table_key, ())) if c in df.columns]


def page_order(table_key: str, df: DataFrame, sort_by: str | None, ascending: bool = True) -> Order:
    if sort_by is not None and sort_by not in sort_columns(table_key, df):
        raise ValueError(f"{table_key} cannot be sorted by {sort_by!r}; use one of {sort_columns(table_key, df)}")
    head = [] if sort_by is None else [(sort_by, ascending)]
    return head + [(k, True) for k in TABLE_KEYS[table_key] if k != sort_by]


def page(df: DataFrame, table_key: str, number: int = 1, size: int = 50, filters: Filters | None = None,
         sort_by: str | None = None, ascending: bool = True) -> DataFrame:
    """Rows ``(number-1)*size .. number*size`` of the filtered, sorted table.

    Pages down to ``SHALLOW`` rows are a top-k, which no task pays more for than that many rows.
    Deeper ones read the sizes of ranges first and sort only the ranges that hold the page;
    ``page_after`` goes on from a known row without either.
    """
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    kept = apply_filters(df, filters)
    order = page_order(table_key, df, sort_by, ascending)
    skip = (number - 1) * size
    if skip + size <= SHALLOW:
        return kept.orderBy(*sorted_by(order)).offset(skip).limit(size)
    return rows_between(kept, order, skip + 1, skip + size)


def page_after(df: DataFrame, table_key: str, last_key: dict, size: int = 50,
               filters: Filters | None = None) -> DataFrame:
    """The page after the row with key ``last_key``, in key order; any depth costs the same.

    Key columns must not be NULL.
    """
    keys = TABLE_KEYS[table_key]
    here = F.struct(*[F.col(k) for k in keys])
    last = F.struct(*[F.lit(last_key[k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    kept = apply_filters(df, filters).filter(F.col(keys[0]) >= last_key[keys[0]]).filter(here > last)
    return kept.orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(size)


def page_metadata(df: DataFrame, number: int = 1, size: int = 50, filters: Filters | None = None) -> DataFrame:
    """One row: page, pages, items, neighbours, first and last item number.

    An empty result and a page past the end have first and last item 0.
    """
    total = apply_filters(df, filters).agg(F.count("*").alias("total_items"))
    pages = F.ceil(F.col("total_items") / size).cast("long")
    skip = (number - 1) * size
    inside = F.col("total_items") > skip
    return total.select(
        F.lit(number).cast("long").alias("current_page"),
        pages.alias("total_pages"),
        "total_items",
        F.lit(size).cast("long").alias("items_per_page"),
        (F.lit(number) < pages).alias("has_next"),
        F.lit(number > 1).alias("has_prev"),
        F.when(inside, F.lit(skip + 1)).otherwise(0).cast("long").alias("start_item"),
        F.when(inside, F.least(F.lit(skip + size), F.col("total_items"))).otherwise(0).cast("long").alias("end_item"),
    )


def display(df: DataFrame) -> DataFrame:
    """Labelled columns, measures rounded to 2, ordered by year, month and city."""
    shown = {name: label for name, label in V.DISPLAY_LABELS.items() if name in df.columns}

    def cell(name: str, label: str) -> Column:
        rounded = isinstance(df.schema[name].dataType, T.DoubleType) and any(
            word in label for word in V.ROUNDED_LABEL_WORDS
        )
        return (F.round(name, 2) if rounded else F.col(name)).alias(label)

    table = df.select(*[cell(name, label) for name, label in shown.items()])
    dated = {"year", "month"} <= shown.keys()
    # the columns after the city only split long runs of one city among the sort's tasks
    order = [*(["year", "month"] if dated else []), "city", "station", "date", "source"]
    return table.orderBy(*[F.asc_nulls_last(f"`{shown[c]}`") for c in order if c in shown])


def table_view(df: DataFrame, table_key: str, number: int = 1, size: int = 50, filters: Filters | None = None,
               sort_by: str | None = None, ascending: bool = True) -> tuple[DataFrame, DataFrame]:
    """The labelled page and its metadata (V6)."""
    rows = page(df, table_key, number, size, filters, sort_by, ascending)
    return display(rows), page_metadata(df, number, size, filters)
