"""Nearest station of every city, by Euclidean distance in degrees.

No city meets every station.  Stations are boxed in a grid of three levels, each cell
split 32 x 32; a cell is known by the bounding box of its stations.  From the top level
down, a city keeps a cell only while the cell's nearest possible distance does not exceed
the smallest farthest distance among the city's cells - the rest cannot hold its nearest
station.  Exact distances are computed in the finest cells that survive.

Sizes: at most 45 top cells under one root, at most 1,024 children per cell, and per
finest cell (158 arc-seconds) at most about 25,000 distinct positions, since provider
positions are whole arc-seconds and stations at one position are folded into the first
of them beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_DEGREES = 45.0
SPLIT = 32
LEVELS = 3
# Bounds and distances are both rounded doubles; keep cells that tie within this margin.
MARGIN = 1e-9

_FINEST_DEGREES = TOP_DEGREES / SPLIT ** (LEVELS - 1)
_NEAR = """sqrt(power(greatest(south - lat, 0D, lat - north), 2) + power(greatest(west - lon, 0D, lon - east), 2))"""
_FAR = """sqrt(power(greatest(lat - south, north - lat), 2) + power(greatest(lon - west, east - lon), 2))"""


def _nodes(gridded: DataFrame) -> DataFrame:
    """Every cell (level, x, y) with its child cells and their boxes; the root is level -1."""
    levels = [
        f"struct({k} AS level, x div {SPLIT ** (LEVELS - 1 - k)} AS cx, y div {SPLIT ** (LEVELS - 1 - k)} AS cy)"
        for k in range(LEVELS)
    ]
    cells = (
        gridded.selectExpr("slat", "slon", f"inline(array({', '.join(levels)}))")
        .groupBy("level", "cx", "cy")
        .agg(
            F.min("slat").alias("south"),
            F.max("slat").alias("north"),
            F.min("slon").alias("west"),
            F.max("slon").alias("east"),
        )
    )
    child = F.struct("level", F.col("cx").alias("x"), F.col("cy").alias("y"), "south", "north", "west", "east")
    parent = ["level - 1 AS level", f"cx div {SPLIT} AS x", f"cy div {SPLIT} AS y"]
    grouped = cells.withColumn("child", child).groupBy(*[F.expr(p) for p in parent])
    return grouped.agg(F.collect_list("child").alias("children"))


def _closest(candidates: DataFrame, city: str) -> DataFrame:
    """The candidate cells that can still hold a city's nearest station."""
    return (
        candidates.selectExpr("*", f"{_NEAR} AS near", f"min({_FAR}) OVER (PARTITION BY `{city}`) AS within")
        .filter(f"near <= within + {MARGIN!r}D")
        .select(city, "lat", "lon", "level", "x", "y")
    )


def nearest_station(cities: DataFrame, stations: DataFrame, city: str = "city") -> DataFrame:
    """Station id and distance for each city; ``cities`` has one row per ``city``, lat, lon.

    ``stations`` has station, lat, lon, pos; rows without a position are left out.  On
    equal distances the smallest ``pos`` wins.
    """
    gridded = stations.na.drop(subset=["lat", "lon"]).selectExpr(
        "station",
        "pos",
        "lat AS slat",
        "lon AS slon",
        f"floor((lon + 180D) / {_FINEST_DEGREES!r}D) AS x",
        f"floor((lat + 90D) / {_FINEST_DEGREES!r}D) AS y",
    )
    points = gridded.groupBy("x", "y", "slat", "slon").agg(F.min(F.struct("pos", "station")).alias("first"))
    nodes = _nodes(gridded)
    # the one root row is a value, not a join side
    children = nodes.filter(F.col("level") == -1).select("children").scalar()
    located = cities.select(city, "lat", "lon").na.drop()
    candidates = _closest(located.select(city, "lat", "lon", F.inline(children)), city)
    for _ in range(LEVELS - 1):
        # every level joins the same table, which is computed and exchanged once
        expanded = candidates.join(nodes, ["level", "x", "y"]).select(city, "lat", "lon", F.inline("children"))
        candidates = _closest(expanded, city)
    distance = F.expr("sqrt((lat - slat) * (lat - slat) + (lon - slon) * (lon - slon))")
    best = F.min(F.struct(distance.alias("distance"), "first.pos", "first.station"))
    return (
        candidates.join(points, ["x", "y"])
        .groupBy(city)
        .agg(best.alias("best"))
        .select(city, "best.station", "best.distance")
    )
