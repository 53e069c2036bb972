import math
import random

import pytest

from isobar.operators.nearest import nearest_station


def brute(cities, stations):
    best = {}
    for name, lat, lon in cities:
        for station, slat, slon, pos in stations:
            if slat is None or slon is None:
                continue
            d = math.sqrt((lat - slat) * (lat - slat) + (lon - slon) * (lon - slon))
            if name not in best or (d, pos) < best[name][:2]:
                best[name] = (d, pos, station)
    return {name: (station, d) for name, (d, pos, station) in best.items()}


def solve(spark, cities, stations):
    c = spark.createDataFrame(cities, "city string, lat double, lon double")
    s = spark.createDataFrame(stations, "station string, lat double, lon double, pos long")
    return {r.city: (r.station, r.distance) for r in nearest_station(c, s).collect()}


def dms(rng, low, high):
    return rng.randint(low * 3600, high * 3600) / 3600


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    stations = [(f"S{i}", dms(rng, 36, 44), dms(rng, -9, 4), i) for i in range(120)]
    # a hot spot holding a third of all stations, copies of one position, and a far island
    stations += [(f"H{i}", 40 + i % 8 / 3600, 2 + i // 8 / 3600, 200 + i) for i in range(80)]
    stations += [(f"C{i}", 38.5, -1.5, 400 + i) for i in range(20)] + [("I", -60.0, 179.5, 500)]
    stations += [("N", None, 1.0, 600), ("M", 1.0, None, 601)]
    cities = [(f"c{i}", rng.uniform(35, 45), rng.uniform(-10, 5)) for i in range(40)]
    cities += [("on", 38.5, -1.5), ("south", -89.0, -179.0), ("east", 0.0, 180.0), ("near_hot", 40.01, 2.0005)]
    assert solve(spark, cities, stations) == brute(cities, stations)


def test_equal_distance_takes_the_first(spark):
    stations = [("late", 1.0, 0.0, 9), ("first", 0.0, 1.0, 3), ("mid", -1.0, 0.0, 5)]
    assert solve(spark, [("c", 0.0, 0.0)], stations) == {"c": ("first", 1.0)}


def test_no_stations(spark):
    assert solve(spark, [("c", 0.0, 0.0)], [("x", None, None, 1)]) == {}
