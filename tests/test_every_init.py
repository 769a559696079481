"""Adjustment, coverage and scoring for all runs at once, against the same for one."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helioflow.operators import adjust, forecast, satellite
from helioflow.operators import timeline as t
from helioflow.sources import store

NOON = datetime(2025, 1, 1, 12)


def test_deltas_of_every_pivot_are_those_of_each(spark):
    hours = [NOON + timedelta(hours=6 * k) for k in range(60)]
    past = spark.createDataFrame([(m, 1 + k % 2, t, 360 * (k % 3), (k * 7 % 11) / 16) for k, t in enumerate(hours) for m in "ab"], "forecaster string, location_id long, target_time timestamp, horizon_mins int, p50 double")
    observed = spark.createDataFrame([(1 + k % 2, t, (k * 5 % 13) / 32) for k, t in enumerate(hours)], "location_id long, target_time timestamp, observed double")
    pivots = [NOON - timedelta(days=1), NOON + timedelta(hours=6), NOON + timedelta(days=5), NOON + timedelta(days=15), NOON + timedelta(days=40)]
    every = adjust.deltas_for_pivots(past, observed, spark.createDataFrame([(x,) for x in pivots], "init_time timestamp"), step=360)
    found = {tuple(r)[:4]: r["delta"] for r in every.collect()}
    wanted = {(p, *tuple(r)[:3]): r["delta"] for p in pivots for r in adjust.week_average_deltas(past, observed, F.lit(p)).collect()}
    assert found.keys() == wanted.keys() and all(abs(found[k] - v) < 1e-12 for k, v in wanted.items()) and len({k[0] for k in found}) == 3
    with pytest.raises(ValueError, match="between slots"):
        adjust.deltas_for_pivots(past, observed, spark.createDataFrame([(NOON + timedelta(minutes=7),)], "init_time timestamp"))


def test_coverage_by_counting(spark):
    """As by listing all expected values: gaps, a value off the half hours, one beyond the horizon, an unknown place, a repeated row."""
    levels, horizons = {"nation": ["p50", "p10"], "location": ["p50"]}, {"short": 3, "long": 5}
    runs = spark.createDataFrame([("a", NOON, "short"), ("b", NOON, "long"), ("c", NOON, "short")], "model string, init_time timestamp, kind string")
    places = spark.createDataFrame([(0,), (1,), (2,)], "location_id long")
    rows = [(m, NOON, p, NOON + timedelta(minutes=30 * k), level) for m in "ab" for p in (0, 1, 2, 9) for k in (0, 1, 2, 3, 7) for level in ("p50", "p10", "p99") if (p, k) != (1, 2)]
    rows += rows[:5] + [("a", NOON, 1, NOON + timedelta(minutes=61), "p50")]
    have = spark.createDataFrame(rows, "model string, init_time timestamp, location_id long, target_time timestamp, level string")
    found = store.coverage_of(runs, places, have, horizons, levels)
    listed = store.coverage(store.expected_values(runs, places, horizons, levels), have, ["model", "init_time", "location_id", "target_time", "level"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, listed.collect())) == [("a", NOON, 12, 1), ("b", NOON, 20, 9), ("c", NOON, 12, 12)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_scores_of_complete_samples(spark, tmp_path):
    def load(folder):
        import glob

        weights = np.array([[float(x) for x in line.split()] for name in glob.glob(f"{folder}/*.txt") for line in open(name)])
        return lambda rows: rows @ weights

    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "weights.txt").write_text("1 0\n2 1\n0.5 -1\n")
    rows = spark.createDataFrame([(1, [1.0, 2.0, 4.0]), (2, [1.0, 2.0]), (3, [float("nan"), 0.0, 0.0]), (4, None), (5, [0.0, 0.0, 2.0]), (6, [1.0, None, 1.0])], "t0 int, values array<double>")
    found = forecast.score_features(rows, str(tmp_path / "model"), load, 3, 2)
    assert {r["t0"]: r["scores"] for r in found.collect()} == {1: [7.0, -2.0], 5: [1.0, -2.0]}
    with pytest.raises(Exception, match="another shape"):
        forecast.score_features(rows, str(tmp_path / "model"), load, 3, 3).collect()


def test_frames_off_the_axis(spark):
    """They stay where nothing is to be filled, or nothing can be; else they only help to fill."""
    at = lambda *ms: [NOON + timedelta(minutes=m) for m in ms]
    cases = {"nothing missing": (at(0, 5, 7, 10), at(0, 5, 7, 10)), "one on the axis": (at(0, 7, 12), at(0, 7, 12)), "a gap": (at(0, 7, 10), at(0, 5, 10)), "shifted": (at(2, 7, 17), at(2, 7, 12, 17)), "alone": (at(3), at(3))}
    rows = [(name, time, float((time - NOON).total_seconds() // 60)) for name, (times, _) in cases.items() for time in times]
    frames = spark.createDataFrame(rows, "k string, time timestamp, value double")
    done = t.interpolate(frames, t.gap_plan(frames, ["k"]), ["k"], []).collect()
    for name, (_, wanted) in cases.items():
        assert sorted(r["time"] for r in done if r["k"] == name) == wanted
    assert all(abs(r["value"] - (r["time"] - NOON).total_seconds() / 60) < 1e-9 for r in done)  # a straight line in time


def test_repair_looks_inside_the_box_only(spark):
    """Zeros outside the box don't count; the decision is made on frames, and no cell is copied for a t0 before it."""
    rows = [(5, NOON - timedelta(minutes=m), y, 0.0 if y > 1 else 1.0) for m in (5, 10) for y in range(4)]
    cells = spark.createDataFrame(rows, "cadence int, time timestamp, y int, value double")
    t0s = spark.createDataFrame([(NOON,), (NOON + timedelta(minutes=5),)], "t0 timestamp")
    checks = [(F.col("value") == 0, 0.1)]
    assert satellite.repair(cells, t0s, checks, ["y"])[0].count() == 0
    done, valid = satellite.repair(cells, t0s, checks, ["y"], inside=F.col("y") < 2)
    assert valid.count() == 2 and done.where("kind = 'seen'").count() == 2 * 8 and done.where("kind = 'extended'").count() == 4 + 8


def test_worst_share_of_a_range_of_time(spark):
    """The window takes frames after t0 - 3 h up to t0, ends as stated, over the buckets' edges."""
    frames = spark.createDataFrame([(5, NOON + timedelta(minutes=m), float(m)) for m in (-180, -179, -60, 0, 1)], "cadence int, time timestamp, share_0 double")
    t0s = spark.createDataFrame([(NOON + timedelta(minutes=m),) for m in (-180, -1, 0, 1, 181, 300)], "t0 timestamp")
    found = {(r["t0"] - NOON) // timedelta(minutes=1): ((r["newest"] - NOON) // timedelta(minutes=1), r["worst_0"]) for r in satellite.recent_frames(frames, t0s, 180, 1).collect()}
    assert found == {-180: (-180, -180.0), -1: (-60, -60.0), 0: (0, 0.0), 1: (1, 1.0)} | {}
