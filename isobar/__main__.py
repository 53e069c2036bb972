"""``spark-submit`` entry: run layers over landed files.

    python -m isobar --landing /landing --layers bronze silver gold [--clean] [--config cities.yaml]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.bronze import station_coordinates, union_all
from .operators.nearest import nearest_station
from .plans import jobs
from .sources.config import load_settings
from .sources.landing import read_station_inventory


def nearest_of_cities(spark: SparkSession, inventory_path: str, cities: DataFrame) -> DataFrame:
    """Station, city and region, each city taking its nearest inventory station."""
    places = cities.select(
        F.col("name").alias("city"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "region"
    )
    inventory = station_coordinates(read_station_inventory(spark, inventory_path))
    return nearest_station(places, inventory).join(places.select("city", "region"), "city")


def main() -> None:
    parser = argparse.ArgumentParser(prog="isobar", description=__doc__)
    parser.add_argument("--layers", nargs="*", default=list(jobs.LAYERS), choices=jobs.LAYERS)
    parser.add_argument("--landing", help="folder with provider=a, provider=b and stations.json")
    parser.add_argument("--config", help="YAML or JSON file with cities, start_date, end_date")
    parser.add_argument(
        "--station-cities", help="JSON lines with source, station, city, region; else cities get their nearest stations"
    )
    parser.add_argument("--inventory-b", help="station inventory of provider B, whose stations have ids of their own")
    parser.add_argument("--clean", action="store_true", help="drop all layers first")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("isobar").getOrCreate()
    landing, cities, stations = None, load_settings(spark, args.config).cities, None
    if "bronze" in args.layers:
        if not args.landing:
            parser.error("--landing is needed for the bronze layer")
        landing = {"aemet": f"{args.landing}/provider=a", "meteostat": f"{args.landing}/provider=b"}
        if args.station_cities:
            schema = "source string, station string, city string, region string"
            stations = spark.read.schema(schema).json(args.station_cities)
        else:
            # without an inventory of provider B its rows are reported as of unknown stations
            inventories = {"aemet": f"{args.landing}/stations.json", "meteostat": args.inventory_b}
            stations = union_all([
                nearest_of_cities(spark, path, cities).withColumn("source", F.lit(source))
                for source, path in inventories.items() if path
            ])
    jobs.run(spark, args.layers, landing, cities, stations, args.clean).show(100, truncate=False)


if __name__ == "__main__":
    main()
