"""Coordinate axes: places on them, projection both ways, regridding of projected cells."""

from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from helioflow.functions.columns import laea_of_lonlat, lonlat_of_laea, place_on_axis
from helioflow.operators import grid as g


@pytest.mark.parametrize("axis", [[0.0, 1.0, 2.0, 3.0], [9.0, 7.5, 1.0, -4.0, -4.5], [5.0, 6.0], [3.0], [float(k * k) for k in range(100)], [float(-k) for k in range(33)]])
def test_places_on_an_axis(spark, axis):
    rng = random.Random(3)
    values = axis + [rng.uniform(min(axis) - 1, max(axis) + 1) for _ in range(200)] + [min(axis) - 0.1, max(axis) + 0.1]
    up = sorted(axis)

    def place(v):
        if not up[0] <= v <= up[-1]:
            return None
        k = max(0, min(bisect.bisect_right(up, v) - 1, len(up) - 2))
        at = 0.0 if len(up) == 1 else k + (v - up[k]) / (up[k + 1] - up[k])
        return at if axis[0] <= axis[-1] else len(axis) - 1 - at

    rows = spark.createDataFrame([(v, axis) for v in values], "v double, axis array<double>").select("v", place_on_axis(F.col("v"), F.col("axis")).alias("at")).collect()
    for r in rows:
        assert r["at"] == (None if place(r["v"]) is None else pytest.approx(place(r["v"]), abs=1e-9))


def test_projection_there_and_back(spark):
    rows = [(float(x), float(y)) for x in range(-900_000, 900_001, 150_000) for y in range(-800_000, 900_001, 170_000)]
    lon, lat = lonlat_of_laea(F.col("x"), F.col("y"))
    there = spark.createDataFrame(rows, "x double, y double").select("x", "y", lon.alias("lon"), lat.alias("lat"))
    back = laea_of_lonlat(F.col("lon"), F.col("lat"))
    worst = there.select(F.max(F.abs(back[0] - F.col("x"))), F.max(F.abs(back[1] - F.col("y")))).first()
    assert max(worst) < 0.05


def test_projected_cells_at_lonlat(spark):
    """Names, then regridding at longitudes and latitudes, then half precision; a frame with NaN goes."""
    cells = [("ukv", f, 1, 2000.0 * y, 2000.0 * x, 70000.0 if f == 3 else float("nan") if f == 2 and x == 0 else 1000.0 * y + x) for f in (1, 2, 3) for y in range(4) for x in range(3)]
    grid = spark.createDataFrame(cells, "provider string, frame int, variable int, y double, x double, value double")
    names = spark.createDataFrame([("ukv", 1, 9)], "provider string, variable int, new int")
    lon, lat = lonlat_of_laea(F.col("x"), F.col("y"))
    targets = spark.createDataFrame([(1, 1000.0, 3000.0), (2, 3000.0, 1000.0), (3, -9000.0, 0.0)], "target_id int, x double, y double").select("target_id", lon.alias("lon"), lat.alias("lat"))
    done = g.prepare_nwp(grid, names, targets, 4, 3, projected=True)
    found = {(r["frame"], r["variable"], r["target_id"]): r["value"] for r in done.collect()}
    assert found == {(1, 9, 1): 1500.0, (1, 9, 2): 501.5, (3, 9, 1): float("inf"), (3, 9, 2): float("inf")}
    assert {"lon", "lat"} <= set(done.columns)


def test_small_weights_shuffle_no_cells(spark):
    grid = spark.createDataFrame([(f, 10.0 - y, float(x), 1.0) for f in range(3) for y in range(4) for x in range(4)], "frame int, lat double, lon double, value double")
    targets = spark.createDataFrame([(1, 8.25, 1.5)], "target_id int, lat double, lon double")
    done = g.regrid_by_coordinates(grid, targets, "lat", "lon", ["frame"], falling=True)
    assert [r["value"] for r in done.collect()] == [1.0] * 3
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
