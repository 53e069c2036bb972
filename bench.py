"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times (``BENCH_RUNS``) into the ``noop``
sink, which computes every row without collecting any; the median counts.  Writing the
stored inputs (raw, silver, landed files) happens once beforehand and is reported as
``setup_seconds``, outside the sum; its work is timed by the bronze and silver queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conformance import adapter  # noqa: E402
from conformance.check import local_session  # noqa: E402
from conformance.queries import QUERIES  # noqa: E402

HEADLINE = [
    "bronze_dedup_pk",
    "bronze_upsert",
    "bronze_coord_enrich",
    "provider_a_normalize",
    "provider_b_normalize",
    "nearest_station",
    "silver_weather_cleaned",
    "gold_city_yearly_summary",
    "gold_climate_profiles",
    "gold_city_extreme_days",
    "gold_monthly_stats",
    "gold_weather_trends",
    "gold_seasonal_analysis",
    "gold_weather_alerts",
    "gold_climate_comparison",
    "gold_min_precipitation",
    "gold_max_precipitation",
    "gold_layer_from_months",
    "page_summary",
    "kpis",
    "temp_histogram",
    "season_radar",
    "alerts_top_cities",
    "map_temperature",
    "dq_missing_months",
    "dq_coverage_by_city",
    "audit_trailing_rate",
    "audit_log_tags",
]


def seconds(work) -> float:
    started = time.monotonic()
    work()
    return time.monotonic() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ["BENCH_QUERIES"].split(",") if "BENCH_QUERIES" in os.environ else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def set_up() -> None:
        for store in (
            adapter.raw, adapter.silver, adapter.two_loads, adapter.landed_a, adapter.landed_b, adapter.log_records
        ):
            store(spark, sf_dir)

    setup = round(seconds(set_up), 4)
    took: dict[str, float] = {}
    for name in names:
        run(name)
        took[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(took.values()), 4),
                "unit": "sec",
                "queries": took,
                "setup_seconds": setup,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": spark.sparkContext.defaultParallelism,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
