"""The registered queries: every operator of the library over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions import expressions as X
from isobar.functions import values as V
from isobar.operators import bronze, paging, silver as silver_ops, trailing
from isobar.operators.backfill import backfill_windows
from isobar.operators.filters import Filters, apply_filters
from isobar.operators.nearest import nearest_station
from isobar.plans import charts, gold, jobs, maps, quality
from isobar.sources import catalog, rawstore
from isobar.sources.landing import read_station_inventory
from isobar.sources.months import refresh
from isobar.workspace import materialise

from . import adapter as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def to6(df: DataFrame, *columns: str) -> DataFrame:
    """Round doubles that come from inexact sums, for comparison across engines."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, 6) for c in names})


def summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.city_yearly_summary(A.silver(spark, d))


def alerts(spark: SparkSession, d: str) -> DataFrame:
    # the load time is not comparable between runs
    return gold.weather_alerts(A.silver(spark, d)).drop("ingestion_date")


def seasonal(spark: SparkSession, d: str) -> DataFrame:
    return gold.seasonal_analysis(A.silver(spark, d))


def comparison(spark: SparkSession, d: str) -> DataFrame:
    return gold.climate_comparison(A.silver(spark, d))


def trends(spark: SparkSession, d: str) -> DataFrame:
    return gold.weather_trends(A.silver(spark, d))


def extreme(spark: SparkSession, d: str) -> DataFrame:
    return gold.city_extreme_days(A.silver(spark, d))


def silver(spark: SparkSession, d: str) -> DataFrame:
    return A.silver(spark, d).drop("ingestion_date")


# ---- bronze ----------------------------------------------------------------------------

@query("bronze_union_sources")
def _(spark, d):
    rows = A.raw_rows(spark, d)
    a = rows.filter(F.col("source") == "aemet").drop("pres", "snow", "tsun")
    b = rows.filter(F.col("source") == "meteostat")
    return bronze.typed(bronze.union_all([b, a]))


@query("bronze_dedup_pk")
def _(spark, d):
    return A.deduplicated(spark, d)


@query("bronze_upsert")
def _(spark, d):
    return bronze.upsert(*A.two_loads(spark, d))


@query("bronze_coord_enrich")
def _(spark, d):
    return bronze.attach_city_coordinates(A.raw(spark, d), A.cities(spark, d))


@query("provider_a_normalize")
def _(spark, d):
    good, _rejected = bronze.normalise_provider_a(A.landed_a(spark, d))
    return bronze.with_lineage(good, "aemet", A.station_places(spark, d))


@query("provider_a_rejects")
def _(spark, d):
    _good, rejected = bronze.normalise_provider_a(A.landed_a(spark, d))
    return rejected.drop("file")


@query("provider_b_normalize")
def _(spark, d):
    good, _rejected = bronze.normalise_provider_b(A.landed_b(spark, d))
    return bronze.with_lineage(good, "meteostat", A.station_places(spark, d))


@query("bronze_job_raw")
def _(spark, d):
    # a first load: nothing is stored yet
    incoming = bronze.accepted(A.staged_load(spark, d))
    return bronze.attach_city_coordinates(bronze.upsert(incoming.limit(0), incoming), A.repeated_cities(spark, d))


@query("bronze_job_rejects")
def _(spark, d):
    # file names differ between runs; records are the landed text
    return bronze.rejects(A.staged_load(spark, d)).withColumn("has_record", F.col("record") != "").drop("file", "record")


@query("bronze_second_load")
def _(spark, d):
    # two loads through the month store: the second is merged into the months it holds
    first, second = A.two_loads(spark, d)
    name = f"{catalog.VERSION_PREFIX}{uuid.uuid4().hex}"
    base = rawstore.store_load(first, f"{name}_1")
    return spark.table(f"{rawstore.store_load(second, f'{name}_2', base)}.{catalog.RAW_TABLE}").drop("ym")


@query("raw_rows_by_manifest")
def _(spark, d):
    # rows a month, from the load's statistics instead of its rows
    name = f"{catalog.VERSION_PREFIX}{uuid.uuid4().hex}"
    listed = rawstore.manifest(spark, rawstore.store_load(A.raw(spark, d), name))
    return listed.select("ym", "row_count")


@query("bronze_job_report")
def _(spark, d):
    return bronze.load_report(A.staged_load(spark, d))


@query("bronze_job_cities")
def _(spark, d):
    return bronze.city_report(A.staged_load(spark, d))


@query("bronze_repeated_cities")
def _(spark, d):
    return bronze.attach_city_coordinates(A.raw(spark, d), A.repeated_cities(spark, d))


@query("dms_to_decimal")
def _(spark, d):
    return to6(bronze.station_coordinates(A.station_inventory(spark, d)).drop("pos"))


@query("station_inventory_file")
def _(spark, d):
    # the inventory read from its file, as the job reads it
    return to6(bronze.station_coordinates(read_station_inventory(spark, A.inventory_file(spark, d))).drop("pos"))


@query("station_coord_lookup")
def _(spark, d):
    return to6(bronze.attach_station_coordinates(A.raw(spark, d), A.station_inventory(spark, d)), "lat", "lon")


@query("nearest_station")
def _(spark, d):
    places = A.cities(spark, d).select(
        F.col("name").alias("city"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    )
    return to6(nearest_station(places, bronze.station_coordinates(A.station_inventory(spark, d))))


@query("backfill_windows")
def _(spark, d):
    key = F.col("s_suppkey")
    start = F.date_add(F.lit("1995-01-01").cast("date"), (key % 700).cast("int"))
    ranges = A.read(spark, d, "supplier").select(
        F.col("s_name").alias("station"),
        start.alias("start_date"),
        F.date_add(start, (key * 37 % 1500).cast("int")).alias("end_date"),
    )
    return backfill_windows(ranges)


@query("city_slugs")
def _(spark, d):
    nations = A.read(spark, d, "nation")
    return nations.select(F.col("n_name").alias("city"), X.city_slug(F.col("n_name")).alias("slug"))


# ---- silver and gold -------------------------------------------------------------------

QUERIES["silver_weather_cleaned"] = silver


@query("silver_snapshot")
def _(spark, d):
    return silver_ops.snapshot(silver(spark, d), F.lit("2025-01-02 00:00:00").cast("timestamp_ntz"))


def _gold(name: str) -> Query:
    return lambda spark, d: gold.GOLD_TABLES[name](A.silver(spark, d))


for _name in gold.GOLD_TABLES:
    QUERIES[f"gold_{_name}"] = _gold(_name)

QUERIES["gold_weather_alerts"] = alerts


@query("gold_seasonal_analysis")
def _(spark, d):
    return to6(seasonal(spark, d), "temp_variability")


QUERIES["gold_climate_comparison_by_range"] = comparison


@query("gold_layer_from_months")
def _(spark, d):
    # the tables of the one-pass gold build, counted and summed next to each other
    months = materialise(gold.station_months(A.silver(spark, d)))
    parts = [
        gold.GOLD_TABLES[name](months, gold.MONTHLY).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.sum(measure).alias("total")
        )
        for name, measure in (
            ("city_yearly_summary", "days"), ("climate_profiles", "yearly_precip"),
            ("city_extreme_days", "total_precip_month"), ("monthly_stats", "total_precip"),
            ("weather_trends", "total_precip"), ("seasonal_analysis", "temp_75th_percentile"),
            ("min_precipitation", "insight_precip"), ("max_precipitation", "insight_precip"),
        )
    ]
    return bronze.union_all([p.withColumn("total", F.round(F.col("total").cast("double"), 6)) for p in parts])


def months(spark: SparkSession, d: str) -> DataFrame:
    """Station months, stored once as the gold job stores them."""
    return A.stored_frame(spark, d, "station-months", lambda: gold.station_months(A.silver(spark, d)))


def _from_months(name: str) -> Query:
    return lambda spark, d: gold.GOLD_TABLES[name](months(spark, d), gold.MONTHLY)


for _name in gold.FROM_MONTHS:
    QUERIES[f"months_{_name}"] = _from_months(_name)


@query("months_seasonal_analysis")
def _(spark, d):
    return to6(_from_months("seasonal_analysis")(spark, d), "temp_variability")


@query("gold_season_quartiles")
def _(spark, d):
    # quartiles of a coarser key, from the counts of a station's months
    counts = A.stored_frame(spark, d, "temperature-counts", lambda: gold.temperature_counts(A.silver(spark, d)))
    return gold.season_quartiles(counts)


@query("gold_months_refreshed")
def _(spark, d):
    # station months of all but the newest year, then brought up to date with the rest
    silver_, name = A.silver(spark, d), f"gold_parts.refreshed_{uuid.uuid4().hex}"
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_parts")
    month = F.date_format("date", "yyyy-MM")
    listed = materialise(silver_.groupBy(month.alias("ym")).agg(F.count("*").cast("string").alias("made_from")))

    def rows(made):
        own = F.concat_ws("-", "year", F.lpad(F.col("month").cast("string"), 2, "0"))
        return gold.station_months(silver_.filter(month.isin(made))).withColumn("ym", own)

    newest = listed.agg(F.max("ym")).scalar()
    for upstream in (listed.filter(F.col("ym") < newest), listed):
        refresh(spark, name, jobs.STATION_MONTHS_LAYOUT, upstream, rows)
    return gold.city_yearly_summary(spark.table(name), gold.MONTHLY)


def _ordered(name: str, build: Query) -> Query:
    return lambda spark, d: gold.in_default_order(build(spark, d), name).limit(40)


for _name, _build in (("weather_alerts", alerts), ("climate_comparison", comparison)):
    QUERIES[f"first_{_name}"] = _ordered(_name, _build)

# ---- serving reads ---------------------------------------------------------------------

QUERIES["filter_options"] = lambda spark, d: charts.filter_options(summary(spark, d))


@query("filter_options_region")
def _(spark, d):
    options = charts.filter_options(summary(spark, d), region="EUROPE")
    return options.filter(F.col("option") == "cities").select(F.col("value").alias("city"))


@query("filter_summary")
def _(spark, d):
    wanted = Filters(
        year=[1996, 1997], month=["1", "2", "7"], region=["EUROPE", "ASIA"], min_temp=5, max_temp=20, max_precip=500
    )
    return apply_filters(summary(spark, d), wanted)


@query("filter_alerts")
def _(spark, d):
    wanted = Filters(
        alert_level=V.RED, source="AEMET", date_range=(date(1997, 1, 1), date(1998, 6, 30)), max_precip=120
    )
    return apply_filters(alerts(spark, d), wanted)


@query("filter_seasonal")
def _(spark, d):
    return to6(apply_filters(seasonal(spark, d), Filters(season="Verano", min_temp=0)), "temp_variability")


@query("filter_silver")
def _(spark, d):
    wanted = Filters(year="1999", cities=["NATION_1", "NATION_3", "NATION_24"], min_temp=30, source="Meteostat")
    return apply_filters(silver(spark, d), wanted)


@query("page_summary")
def _(spark, d):
    return paging.page(
        summary(spark, d), "summary", number=3, filters=Filters(region="AFRICA"), sort_by="total_precip", ascending=False
    )


@query("page_deep")
def _(spark, d):
    return paging.page(
        alerts(spark, d), "alerts", number=20, size=500, sort_by="alert_severity", ascending=False
    )


@query("page_each_order")
def _(spark, d):
    # the first rows in each order that a reader may choose, both ways
    table = summary(spark, d)
    pages = [
        paging.page(table, "summary", size=3, sort_by=c, ascending=up).withColumns({"sorted_by": F.lit(c), "ascending": F.lit(up)})
        for c in paging.sort_columns("summary", table)
        for up in (True, False)
    ]
    return bronze.union_all(pages)


@query("page_after_key")
def _(spark, d):
    return paging.page_after(trends(spark, d), "trends", {"city": "NATION_15", "year": "1998"})


@query("page_metadata")
def _(spark, d):
    return paging.page_metadata(summary(spark, d), number=3, filters=Filters(region="AFRICA"))


QUERIES["table_display"] = lambda spark, d: paging.display(summary(spark, d))

# ---- charts ----------------------------------------------------------------------------

QUERIES["kpis"] = lambda spark, d: to6(charts.kpis(summary(spark, d)))
QUERIES["kpis_alerts"] = lambda spark, d: charts.kpis(alerts(spark, d))
QUERIES["city_overview"] = lambda spark, d: charts.city_overview(summary(spark, d))
QUERIES["temp_by_year"] = lambda spark, d: to6(charts.mean_temperature_by(summary(spark, d), "year"))
QUERIES["temp_by_month"] = lambda spark, d: to6(charts.mean_temperature_by(summary(spark, d), "month"))
QUERIES["temp_by_city_year"] = lambda spark, d: to6(charts.temperature_lines(summary(spark, d)))
QUERIES["temp_histogram"] = lambda spark, d: to6(charts.histogram(summary(spark, d), "avg_temp"))
QUERIES["precip_by_year"] = lambda spark, d: to6(charts.precipitation_by_year(summary(spark, d)))
QUERIES["precip_by_month"] = lambda spark, d: to6(charts.precipitation_by_month(summary(spark, d)))
QUERIES["rainy_periods_by_city"] = lambda spark, d: charts.rainy_periods(summary(spark, d))
QUERIES["precip_histogram"] = lambda spark, d: to6(charts.histogram(summary(spark, d), "total_precip"))


@query("trend_temp_by_year")
def _(spark, d):
    # one chart of the "trends" topic, through the topic driver
    return to6(charts.analyse("trends", lambda key: trends(spark, d))["temp_by_year"])


TOPIC_TABLES: dict[str, Query] = {
    "trends": trends, "summary": summary, "seasonal": seasonal, "alerts": alerts, "comparison": comparison
}


def _topic_chart(topic: str, chart: str) -> Query:
    return lambda spark, d: to6(charts.analyse(topic, lambda key: TOPIC_TABLES[key](spark, d))[chart])


# every chart of every topic, through the topic driver
TOPIC_CHARTS = {
    "trends": ("temp_by_year", "temp_histogram", "temp_by_city_year"),
    "temperature": ("temp_by_year", "temp_histogram", "temp_by_month", "temp_by_city_year"),
    "precipitation": ("precip_by_year", "precip_by_month", "rainy_periods_by_city", "precip_histogram"),
    "seasonal": ("season_profile", "season_radar"),
    "alerts": ("alerts_by_level", "alerts_by_severity", "alerts_top_cities", "alerts_by_month"),
    "comparison": ("comparison_by_temp", "comparison_by_precip", "climate_class_counts", "comparison_scatter"),
}
for _topic, _charts in TOPIC_CHARTS.items():
    for _chart in _charts:
        QUERIES[f"topic_{_topic}_{_chart}"] = _topic_chart(_topic, _chart)

QUERIES["season_profile"] = lambda spark, d: to6(charts.season_profile(seasonal(spark, d)))
QUERIES["season_radar"] = lambda spark, d: to6(charts.season_radar(seasonal(spark, d)))
QUERIES["alerts_by_level"] = lambda spark, d: charts.value_counts(alerts(spark, d), "overall_alert")
QUERIES["alerts_by_severity"] = lambda spark, d: charts.value_counts(alerts(spark, d), "alert_severity", by_value=True)
QUERIES["alerts_top_cities"] = lambda spark, d: charts.top_alert_cities(alerts(spark, d))
QUERIES["alerts_by_month"] = lambda spark, d: charts.alerts_by_month(alerts(spark, d))
QUERIES["climate_class_counts"] = lambda spark, d: charts.value_counts(comparison(spark, d), "climate_classification")
QUERIES["comparison_by_temp"] = lambda spark, d: charts.comparison_sorted(comparison(spark, d), "avg_temp_city")
QUERIES["comparison_by_precip"] = lambda spark, d: charts.comparison_sorted(comparison(spark, d), "total_precip_city")
QUERIES["comparison_scatter"] = lambda spark, d: charts.comparison_scatter(comparison(spark, d))

# ---- maps ------------------------------------------------------------------------------


def places(spark: SparkSession, d: str) -> DataFrame:
    return maps.city_coordinates(A.silver(spark, d))


QUERIES["map_temperature"] = lambda spark, d: maps.temperature_map(summary(spark, d), places(spark, d))
QUERIES["map_precipitation"] = lambda spark, d: maps.precipitation_map(summary(spark, d), places(spark, d))
QUERIES["map_alerts"] = lambda spark, d: maps.alert_map(alerts(spark, d), places(spark, d))
QUERIES["map_comparison"] = lambda spark, d: maps.comparison_map(comparison(spark, d), places(spark, d))
QUERIES["map_columns_precipitation"] = lambda spark, d: maps.map_columns(summary(spark, d), "precipitation")
QUERIES["dim_city_coordinates"] = places

# ---- data quality ----------------------------------------------------------------------

QUERIES["dq_coverage_overall"] = lambda spark, d: quality.coordinate_coverage(A.raw(spark, d))
QUERIES["dq_coverage_by_city"] = lambda spark, d: quality.coordinate_coverage(A.raw(spark, d), "city")
QUERIES["dq_coverage_by_source"] = lambda spark, d: quality.coordinate_coverage(A.raw(spark, d), "source")
QUERIES["dq_extent"] = lambda spark, d: quality.coordinate_extent(A.raw(spark, d))
QUERIES["dq_station_counts"] = lambda spark, d: quality.station_counts(A.silver(spark, d))
QUERIES["dq_station_counts_raw"] = lambda spark, d: quality.station_counts(A.raw(spark, d))
QUERIES["dq_source_counts"] = lambda spark, d: quality.source_counts(A.raw(spark, d))


@query("dq_row_counts")
def _(spark, d):
    return catalog.row_counts({name: build(A.silver(spark, d)) for name, build in gold.GOLD_TABLES.items()})


QUERIES["dq_null_counts"] = lambda spark, d: quality.null_counts(extreme(spark, d))
QUERIES["dq_missing_months"] = lambda spark, d: quality.missing_months(extreme(spark, d))
QUERIES["dq_missing_detail"] = lambda spark, d: quality.missing_detail(extreme(spark, d))


@query("dq_first_rows")
def _(spark, d):
    return bronze.union_all([quality.first_rows(silver(spark, d), source) for source in ("aemet", "meteostat")])


QUERIES["dq_point_lookup"] = lambda spark, d: quality.point_lookup(A.silver_files(spark, d), "nation_7", 1998, 1).drop("city_key", "ingestion_date")

# ---- audit -----------------------------------------------------------------------------

AUDIT_CAP = 2


@query("audit_trailing_rate")
def _(spark, d):
    return trailing.trailing_requests(A.read(spark, d, "events"), "event_type", "ts")


@query("audit_usage_level")
def _(spark, d):
    used = trailing.usage(A.read(spark, d, "events"), AUDIT_CAP, "event_type", "ts")
    return used.groupBy("source", "usage_level").agg(
        F.count("*").alias("instants"), F.count_if("over_cap").alias("over_cap")
    )


@query("audit_usage_by_provider")
def _(spark, d):
    # against the caps of the two providers
    used = trailing.usage(A.provider_requests(spark, d), trailing.source_cap(F.col("source")))
    return used.groupBy("source", "usage_level").agg(
        F.count("*").alias("instants"), F.count_if("over_cap").alias("over_cap"), F.max("trailing_requests").alias("most")
    )


@query("audit_log_tags")
def _(spark, d):
    records = A.log_records(spark, d)
    total = F.sum(F.col("context")["k"].cast("long")).alias("context_total")
    return records.groupBy(F.to_date("logged_at").alias("day"), "level", "tag").agg(
        F.count("*").alias("records"), total
    )
