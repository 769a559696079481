"""Known cases of the operators, with results that are given, not worked out by a second query."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helioflow.functions.columns import solar_elevation, sun_place
from helioflow.operators import adjust, forecast, satellite
from helioflow.operators import grid as g
from helioflow.operators import timeline as t
from helioflow.operators import validate as v
from helioflow.sources import store

NOON = datetime(2025, 1, 1, 12)


def minutes(first, last, step, start):
    return [start + timedelta(minutes=m) for m in range(first, last + 1, step)]


@pytest.mark.parametrize(
    "mw, capacity, warn, error, start, valid, warned",
    [
        ([10, 20, 30], 50, 500, 1000, datetime(2025, 1, 1), True, False),
        ([60], 50, 500, 1000, datetime(2025, 1, 1), False, False),
        ([21000], 100000, 500, 1000, datetime(2025, 1, 1), False, False),
        ([1000, 1100, 1050, 1200, 1150], 2000, 500, 1000, datetime(2025, 1, 1), True, False),
        ([1000, 1300, 800, 1200, 500], 2000, 40, 1000, datetime(2025, 1, 1), True, True),
        ([1000, 1600, 800, 1301, 500], 2000, 10, 40, datetime(2025, 1, 1), False, True),
        ([0, 50, 100, -1, 75], 2000, 10, 40, NOON, False, True),
    ],
)
def test_validation(spark, mw, capacity, warn, error, start, valid, warned):
    rows = [("m", start, start + timedelta(minutes=30 * k), float(x)) for k, x in enumerate(mw)]
    national = spark.createDataFrame(rows, "model string, init_time timestamp, target_time timestamp, mw double")
    verdict = v.validate(national, float(capacity), warn, error).first()
    assert verdict["valid"] is valid
    assert bool(verdict["zig_zag_warning"]) is warned


def test_zig_zag_needs_three_steps_above(spark):
    series = {"a": [0, 300, 0, 300], "b": [300, 0, 300, 0], "c": [0, 250, 0, 250], "d": [0, 300, 0], "e": [0, 300, float("nan"), 300, 0, 251]}
    rows = [(k, NOON, NOON + timedelta(minutes=30 * i), float(x)) for k, xs in series.items() for i, x in enumerate(xs)]
    national = spark.createDataFrame(rows, "model string, init_time timestamp, target_time timestamp, mw double")
    found = {r["model"]: r["zig_zag"] for r in v.zig_zag(national, 250.0).collect()}
    assert found == {"a": True, "b": False, "c": False, "d": False, "e": False}


@pytest.mark.parametrize(
    "p50, delta, capacity, expected",
    [(0.5, 0.01, 1, 0.01), (0.5, 0.1, 1, 0.05), (0.5, 0.2, 1, 0.05), (0.5, -0.2, 1, -0.05), (0.8, 0.06, 20, 0.06), (0.8, 0.06, 20_000, 0.05), (0.8, -0.06, 20_000, -0.05)],
)
def test_limit_adjuster(spark, p50, delta, capacity, expected):
    row = spark.createDataFrame([(delta, p50, float(capacity))], "delta double, p50 double, capacity double")
    assert row.select(adjust.limit_adjuster(F.col("delta"), F.col("p50"), F.col("capacity"))).first()[0] == expected


def test_adjusted_levels_shift_alike(spark):
    """Deltas of -0.01 i and more are limited to a tenth of the forecast; all levels move by the same."""
    rows = [("f", h, 0.5, {"p10": 0.3, "p90": 0.7, "p98": 0.93}) for h in range(24)]
    values = spark.createDataFrame(rows, "forecaster string, horizon_mins int, p50 double, levels map<string, double>")
    deltas = spark.createDataFrame([("f", h, -0.01 * h, 0) for h in range(24)], "forecaster string, horizon_mins int, delta double, place int")
    for r in adjust.apply_adjuster(values, deltas, F.lit(20.0)).collect():
        shift = min(0.01 * r["horizon_mins"], 0.05)
        assert r["p50"] == pytest.approx(0.5 + shift) and r["levels"]["p10"] == pytest.approx(0.3 + shift)
        assert r["levels"]["p98"] == pytest.approx(min(0.93 + shift, 1.0)) and r["forecaster"] == "f_adjust"


@pytest.mark.parametrize("have, filled", [("01001010", "01111110"), ("10001010", "10001110")])
def test_gap_fill(spark, have, filled):
    times = [(1, NOON + timedelta(minutes=5 * i)) for i, x in enumerate(have) if x == "1"]
    plan = t.gap_plan(spark.createDataFrame(times, "k int, time timestamp"), ["k"])
    found = {r["time"] for r in plan.collect()}
    assert found == {NOON + timedelta(minutes=5 * i) for i, x in enumerate(filled) if x == "1"}


def test_interpolation_of_a_quarter_hour_series(spark):
    start = datetime(2023, 1, 1)
    times = [x for x in minutes(0, 180, 15, start) if x != start + timedelta(minutes=15)]
    frames = spark.createDataFrame([(1, x, 1.0) for x in times], "k int, time timestamp, value double")
    found = t.interpolate(frames, t.gap_plan(frames, ["k"]), ["k"], []).collect()
    assert sorted(r["time"] for r in found) == [x for x in minutes(0, 180, 5, start) if not start < x < start + timedelta(minutes=30)]
    assert {r["value"] for r in found} == {1.0}


@pytest.mark.parametrize("delay, frames", [(0, 0), (120, 24), (240, 36)])
def test_extension(spark, delay, frames):
    rows = [(1, x, NOON + timedelta(minutes=delay)) for x in minutes(-60, 0, 5, NOON)]
    found = t.extension_times(spark.createDataFrame(rows, "k int, time timestamp, t0 timestamp"), ["k"], "t0", limit=180)
    assert sorted(r["time"] for r in found.collect()) == minutes(5, 5 * frames, 5, NOON)


@pytest.mark.parametrize("last, missing, ok", [(-5, None, True), (-15, None, True), (-35, None, False), (-5, -30, False), (-5, -60, False)])
def test_satellite_inputs(spark, last, missing, ok):
    t0 = datetime(2023, 1, 1)
    models = spark.createDataFrame([("m", -60, -30, 0.0, 0)], "model string, start_min int, end_min int, dropout_fraction double, dropout_min int")
    times = [(x,) for x in minutes(-120, last, 5, t0) if missing is None or x != t0 + timedelta(minutes=missing)]
    needs = t.satellite_needs(models, spark.createDataFrame([(t0,)], "t0 timestamp"))
    assert t.available(needs, spark.createDataFrame(times, "time timestamp"), ["time"]).first()["ok"] is ok


@pytest.mark.parametrize("done, missing_critical, missing_any", [(["a"], [], ["b"]), (["b"], ["a"], ["a"]), (["a", "b"], [], [])])
def test_finished_models(spark, done, missing_critical, missing_any):
    models = spark.createDataFrame([(NOON, "a", True), (NOON, "b", False)], "init_time timestamp, model string, is_critical boolean")
    runs = spark.createDataFrame([(NOON, m) for m in done], "init_time timestamp, model string")
    for required, missing in ((models.where("is_critical"), missing_critical), (models, missing_any)):
        rows = store.incomplete_models(required.drop("is_critical"), runs)
        assert [r["model"] for r in rows.collect()] == missing
        if missing:
            with pytest.raises(ValueError, match=missing[0]):
                store.require_none(rows, "models without a finished run")
        else:
            store.require_none(rows, "models without a finished run")


@pytest.mark.parametrize("bad", [0.0, float("nan")])
def test_frames_with_half_bad_values(spark, bad):
    """Every other frame is wholly zero or NaN: too many of it at any threshold below one; none in the clean table."""
    rows = [(f, y, bad if f % 2 else 1.0) for f in range(6) for y in range(4)]
    cells = spark.createDataFrame(rows, "frame int, y int, value double")
    hit = F.isnan("value") if bad != bad else F.col("value") == 0
    shares = g.value_fraction(cells, ["frame"], hit)
    assert {r["frame"]: r["fraction"] for r in shares.collect()} == {f: float(f % 2) for f in range(6)}
    too = lambda table, threshold: g.too_many(g.value_fraction(table, ["frame"], hit).withColumn("k", F.lit(1)), ["k"], threshold).first()["too_many"]
    assert too(cells, 0.1) and not too(cells, 1.0)
    assert not too(cells.where("frame % 2 = 0"), 0.0)


def test_solar_elevation(spark):
    """The published example of a solar position algorithm: 39.872046 degrees without refraction."""
    row = spark.createDataFrame([(datetime(2003, 10, 17, 19, 30, 30),)], "at timestamp")
    found = row.select(solar_elevation(F.col("at"), 39.742476, -105.1786)).first()[0]
    assert abs(found - 39.872046) < 0.001


def test_sun_place(spark):
    """Published places of the sun: 1992-10-13 0h terrestrial time, and the example above."""
    times = [datetime(1992, 10, 12, 23, 58, 53), datetime(2003, 10, 17, 19, 30, 30)]
    place = sun_place(F.col("at"))
    ascension, declination, sidereal, distance = (place[x] for x in ("ascension", "declination", "sidereal", "distance"))
    rows = spark.createDataFrame([(t,) for t in times], "at timestamp").select("at", F.pmod(F.degrees(ascension), F.lit(360.0)), F.degrees(declination), F.pmod(F.degrees(sidereal), F.lit(360.0)), distance)
    found = {r[0]: tuple(r)[1:] for r in rows.collect()}
    for time, wanted in zip(times, [(198.378178, -7.783871, None, 0.997609), (202.227408, -9.314340, 318.511910, 0.996542)], strict=True):
        assert all(w is None or abs(a - w) < 0.0006 for a, w in zip(found[time], wanted, strict=True))


def test_latest_init_looks_back_as_far_as_it_must(spark):
    t0s = spark.createDataFrame([(NOON,), (NOON + timedelta(minutes=1),), (NOON - timedelta(days=40),), (NOON + timedelta(days=900),)], "t0 timestamp")
    inits = spark.createDataFrame([(NOON - timedelta(days=5),), (NOON,), (NOON,)], "init_time timestamp")
    found = {r["t0"]: r["init_time"] for r in t.latest_init_asof(t0s, inits).collect()}
    assert found == {NOON: NOON, NOON + timedelta(minutes=1): NOON, NOON - timedelta(days=40): None, NOON + timedelta(days=900): NOON}
    fresh = {r["t0"]: r["init_time"] for r in t.latest_init_asof(t0s, inits, max_staleness=60).collect()}
    assert fresh[NOON + timedelta(days=900)] is None and fresh[NOON] == NOON


def forecast_rows(spark, inits, models=("a", "b")):
    rows = [(m, i, 1, i + timedelta(minutes=30), float(k)) for k, i in enumerate(inits) for m in models]
    return spark.createDataFrame(rows, "model string, init_time timestamp, location_id long, target_time timestamp, mw double")


def test_guards_name_what_is_wrong(spark):
    """A run that can't go on fails and says why; the same calls without the guard return rows."""
    t0s = spark.createDataFrame([(NOON,), (NOON + timedelta(hours=3),)], "t0 timestamp")
    times = spark.createDataFrame([(NOON, 5, NOON - timedelta(minutes=5)), (NOON, 15, NOON)], "t0 timestamp, cadence int, time timestamp")
    assert [(r["t0"], r["cadence"]) for r in t.choose_freshest(times).collect()] == [(NOON, 15)]
    with pytest.raises(ValueError, match="no satellite source.*15:00"):
        t.choose_freshest(times, t0s)
    checks = spark.createDataFrame([("a", NOON, False), ("b", NOON, False)], "model string, t0 timestamp, ok boolean")
    assert t.runnable(checks).where("runnable").count() == 0
    with pytest.raises(ValueError, match="no model can run"):
        t.runnable(checks, required=True)
    verdicts = spark.createDataFrame([("a", NOON, False)], "model string, init_time timestamp, valid boolean")
    rows = forecast_rows(spark, [NOON])
    assert v.filter_bad(rows, verdicts).count() == 0
    with pytest.raises(ValueError, match="no valid forecast"):
        v.filter_bad(rows, verdicts, required=True)
    uuids = spark.createDataFrame([(2, "u")], "location_id long, location_uuid string")
    with pytest.raises(ValueError, match="without uuid: 1"):
        store.with_uuid(rows, uuids)
    cells = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, 0.0), (2, 1.0), (3, float("nan"))], "frame int, value double")
    with pytest.raises(ValueError, match="zero: 1$"):
        g.require_not_zero(cells, ["frame"])
    g.require_not_zero(cells.where("frame > 1"), ["frame"])


def test_levels_that_are_missing(spark):
    labels = ["forecast_mw", "forecast_mw_plevel_10", "forecast_mw_plevel_90"]
    rows = [("a", NOON, k, NOON, label, 1.0) for k in (1, 2) for label in labels if (k, label) != (2, labels[2])]
    frame = spark.createDataFrame(rows, "model string, init_time timestamp, location_id long, target_time timestamp, output_label string, value double")
    assert forecast.select_levels(frame).count() == 5
    assert forecast.select_levels(frame.where("location_id = 1"), required=True).count() == 3
    with pytest.raises(ValueError, match="p90"):
        forecast.select_levels(frame, required=True)


def test_regrid_to_the_same_cells_changes_nothing(spark):
    cells = spark.createDataFrame([(1, y, x, float(10 * y + x)) for y in range(3) for x in range(2)], "frame int, y long, x long, value double")
    own = spark.createDataFrame([(100 + 2 * y + x, float(y), float(x)) for y in range(3) for x in range(2)], "target_id long, ty double, tx double")
    same = g.regrid_unless_same(cells, own, 3, 2, ["frame"])
    assert "Aggregate" not in same._jdf.queryExecution().optimizedPlan().toString()
    found = {r["target_id"]: r["value"] for r in same.collect()}
    assert found == {100 + 2 * y + x: 10.0 * y + x for y in range(3) for x in range(2)}
    moved = own.withColumn("ty", F.least(F.col("ty") + 0.5, F.lit(2.0)))
    assert {r["target_id"]: r["value"] for r in g.regrid_unless_same(cells, moved, 3, 2, ["frame"]).collect()} == {100: 5.0, 101: 6.0, 102: 15.0, 103: 16.0, 104: 20.0, 105: 21.0}


def test_forecast_part_of_an_axis(spark):
    row = spark.createDataFrame([([0.1, 0.2, 0.3, 0.4],)], "axis array<double>")
    assert row.select(forecast.forecast_part(F.col("axis"), 3)).first()[0] == [0.2, 0.3, 0.4]


def test_backup_capacities_are_quoted_numbers(spark, tmp_path):
    (tmp_path / "backup.csv").write_text('"gsp_id","capacity_mwp"\n"0","15000.5"\n"338","1.25"\n')
    assert [tuple(r) for r in store.read_backup_capacities(spark, str(tmp_path / "backup.csv")).collect()] == [(0, 15000.5), (338, 1.25)]


def test_satellite_repair(spark):
    """The 5-minute source is fresher; one frame is missing; two hours without frames before t0 are extended."""
    t0 = NOON
    five = [x for x in minutes(-170, -120, 5, t0) if x != t0 + timedelta(minutes=-140)]
    rows = [(5, x, y, float(y)) for x in five for y in (1, 2)] + [(15, x, y, 9.0) for x in minutes(-170, -125, 15, t0) for y in (1, 2)]
    cells = spark.createDataFrame(rows, "cadence int, time timestamp, y int, value double")
    t0s = spark.createDataFrame([(t0,)], "t0 timestamp")
    done, valid = satellite.repair(cells, t0s, [(F.col("value") == 0, 0.1)], ["y"])
    kinds = {k: sorted({r["time"] for r in done.where(F.col("kind") == k).collect()}) for k in ("seen", "filled", "extended")}
    assert kinds == {"seen": five, "filled": [t0 + timedelta(minutes=-140)], "extended": minutes(-115, 0, 5, t0)}
    assert valid.first()["valid_times"] == minutes(-170, -120, 5, t0)
    assert done.where("kind = 'filled' and value = y").count() == 2 and done.where("kind = 'extended' and isnan(value)").count() == 48
    bad, none = satellite.repair(cells.withColumn("value", F.lit(0.0)), t0s, [(F.col("value") == 0, 0.1)], ["y"])
    assert bad.count() == none.count() == 0


def test_features_of_a_sample(spark):
    """Slices of three steps of a 2 x 2 window; the accumulated variable is differenced first and lacks its last step."""
    cells = spark.createDataFrame([(k, s, y, x, float(100 * k + 10 * s * s + 3 * y + x)) for k in (0, 1) for s in range(5) for y in range(3) for x in range(3)], "variable long, step long, y long, x long, value double")
    samples = spark.createDataFrame([("c", 4), ("d", 4)], "config string, t0 long")
    places = spark.createDataFrame([(7, 1, 1), (8, 1, 1), (9, 2, 2)], "location_id long, loc_y long, loc_x long")
    constants = spark.createDataFrame([(0, 0.0, 1.0), (1, 10.0, 2.0)], "variable long, mean double, std double")
    made = g.sample_features(cells, samples, {"c": (2, 0), "d": (0, 0)}, places, constants, (2, 2), [1])
    models = spark.createDataFrame([("m", "c"), ("n", "c"), ("o", "d")], "model string, config string")
    found = {(r["model"], r["location_id"], r["variable"]): r["values"] for r in g.features_of(made, models, places).collect()}
    wanted = {0: [10.0 * s * s + 3 * y + x for s in (2, 3, 4) for y in (0, 1) for x in (0, 1)], 1: [(10.0 * (2 * s + 1) - 10) / 2 for s in (2, 3) for _ in range(4)]}
    for model in "mn":
        for place in (7, 8):
            assert {k[2]: v for k, v in found.items() if k[:2] == (model, place)} == wanted
    assert found["o", 9, 0] == [160.0 + 3 * y + x for y in (1, 2) for x in (1, 2)] and ("o", 9, 1) not in found
    # Places and configurations that models share are made once, from one scan of the grid.
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert made.count() == 2 * 2 + 2 and len(re.findall(r"Scan ExistingRDD\[variable#\d+L?,step#", plan)) == 1
