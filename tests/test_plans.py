"""What the physical plans must and must not contain."""

from pathlib import Path

from pyspark.sql import functions as F

from conformance import adapter
from isobar.operators import bronze, paging
from isobar.operators.filters import Filters, apply_filters
from isobar.operators.silver import clean
from isobar.plans import gold, quality
from isobar.workspace import shared_folder

from rows import plan

SMALL = "/root/testdata/sf0.001"


def test_duplicates_are_cut_before_the_shuffle(spark):
    text = plan(adapter.deduplicated(spark, SMALL))
    assert text.count("WindowGroupLimit") >= 4 and "Partial" in text and text.count("Arguments: hashpartitioning") == 1


def test_year_filter_prunes_partitions_and_city_filter_reaches_the_scan(spark):
    silver = adapter.silver(spark, SMALL)
    text = plan(apply_filters(gold.city_yearly_summary(silver), Filters(year=1997, cities=["NATION_3"])))
    assert "PartitionFilters: [isnotnull(year" in text and "EqualTo(city,NATION_3)" in text or "In(city" in text


def test_only_needed_columns_are_read(spark):
    text = plan(gold.weather_trends(adapter.silver(spark, SMALL)))
    assert "ReadSchema: struct<city:string,temp_avg_c:double,precip_mm:double>" in text


def test_one_shuffle_per_grouped_table(spark):
    silver = adapter.silver(spark, SMALL)
    for build in (gold.city_yearly_summary, gold.seasonal_analysis, gold.weather_trends, gold.climate_profiles):
        assert plan(build(silver)).count("Arguments: hashpartitioning") == 1
    assert "hashpartitioning" not in plan(gold.weather_alerts(silver))


def test_top_k(spark):
    silver = adapter.silver(spark, SMALL)
    assert "TakeOrderedAndProject" in plan(gold.min_precipitation(silver))
    last = {"city": "NATION_1", "region": "A", "station": "S", "year": "1997", "month": 1}
    assert "TakeOrderedAndProject" in plan(paging.page_after(gold.city_yearly_summary(silver), "summary", last))


def test_no_table_is_numbered_in_one_task(spark):
    silver = adapter.silver(spark, SMALL)
    folder = Path(shared_folder(spark)) / spark.sparkContext.applicationId
    before = set(folder.iterdir())
    compared = gold.climate_comparison(silver)
    alerts = gold.weather_alerts(silver)
    deep = paging.page(alerts, "alerts", number=3, size=2000)
    text = plan(compared) + plan(deep)
    assert set(folder.iterdir()) == before  # neither is written to be planned
    # the sampled rows and one row for each range are the only ones that meet in one task
    main = text.split("Subqueries")[0]
    assert "SinglePartition" not in main and "Subquery" in text
    stations = gold.station_profile(silver).count()
    assert compared.agg(F.max("heat_rank_overall")).first()[0] == stations
    assert deep.count() == max(0, min(2000, alerts.count() - 4000))
    assert "TakeOrderedAndProject" in plan(paging.page(alerts, "alerts", number=3))


def test_a_point_lookup_reaches_the_files(spark):
    text = plan(quality.point_lookup(adapter.silver_files(spark, SMALL), "Nation_7", 1998, 1))
    assert "EqualTo(city_key,nation_7)" in text and "GreaterThanOrEqual(date,1998-01-01)" in text and "LessThan(date,1998-02-01)" in text
    assert "PartitionFilters: [isnotnull(year" in text


def test_filters_reach_the_files(spark):
    silver = adapter.silver(spark, SMALL)
    assert "IsNotNull(tavg)" in plan(clean(adapter.raw(spark, SMALL)))
    assert "IsNotNull(lat)" in plan(gold.station_profile(silver))
    for build in (gold.seasonal_analysis, gold.weather_alerts):
        pruned = plan(build(silver).filter("year = 1997"))
        assert "PartitionFilters: [isnotnull(year" in pruned, pruned


def test_landed_rows_are_not_shuffled_for_their_city(spark):
    landed, places = adapter.landed_a(spark, SMALL), adapter.station_places(spark, SMALL)
    text = plan(bronze.staged(bronze.judge_provider_a(landed), "aemet", places))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
