"""Stored grids and forecasts: chunks, late frames, time zones, publication and retraction, late frames of a stream."""

from __future__ import annotations

import glob
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helioflow.operators import validate as v
from helioflow.sources import store
from helioflow.streaming import jobs

NOON = datetime(2025, 1, 1, 12)
CELL = "provider string, time timestamp, variable int, y long, x long, value double"


@pytest.fixture
def london(spark):
    """A session whose clock goes through 01:00 to 02:00 twice on 2024-10-27."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def at(minutes):
    """A time that Spark takes as an instant, minutes after midnight UTC of the day when summer time ends."""
    return datetime(2024, 10, 27, tzinfo=timezone.utc) + timedelta(minutes=minutes)


def frame(spark, time, provider="rapid", places=((0, 0), (0, 90), (150, 0), (150, 90)), factor=1.0):
    return spark.createDataFrame([(provider, time, 1, y, x, factor * (y + x)) for y, x in places], CELL)


def forecast_rows(spark, inits, models=("a", "b")):
    rows = [(m, i, 1, i + timedelta(minutes=30), float(k)) for k, i in enumerate(inits) for m in models]
    return spark.createDataFrame(rows, "model string, init_time timestamp, location_id long, target_time timestamp, mw double")


def test_store_keeps_every_init(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    first, second = NOON, NOON + timedelta(minutes=30)
    store.write_forecast(forecast_rows(spark, [first]), path)
    store.write_forecast(forecast_rows(spark, [second]), path)
    store.write_forecast(forecast_rows(spark, [second], ["a"]), path)  # again: no second copy, and b stays
    found = sorted((r["model"], r["init_time"]) for r in store.read_forecast(spark, path).collect())
    assert found == sorted((m, i) for m in "ab" for i in (first, second))


def test_hours_that_come_twice(london, tmp_path):
    """00:30 and 01:30 UTC show the same time on London's clock: both frames and both runs stay."""
    grid, forecasts = str(tmp_path / "grid"), str(tmp_path / "forecasts")
    micros = lambda df, c: sorted(r[0] for r in df.select(F.unix_micros(c)).distinct().collect())
    wanted = [int(at(m).timestamp()) * 1_000_000 for m in (30, 90)]
    for m in (30, 90):
        store.write_grid(frame(london, at(m)), grid, "satellite")
        store.write_forecast(forecast_rows(london, [at(m)], ["a"]), forecasts)
    cells = store.read_grid(london, grid)
    assert micros(cells, "time") == wanted and cells.count() == 8 and micros(store.stored_times(london, grid), "time") == wanted
    assert micros(store.read_forecast(london, forecasts), "init_time") == wanted
    one = store.read_grid(london, grid, "rapid", datetime(2024, 10, 27, 1), datetime(2024, 10, 27, 2))  # in UTC
    assert micros(one, "time") == wanted[1:]
    assert [x.rsplit("=", 1)[1] for x in glob.glob(f"{grid}/provider=rapid/*")] == ["2024-10-27"]


def test_late_frame_takes_its_place(spark, tmp_path):
    """A day of 5-minute frames: a row for six frames of a tile, one file a day; a late frame changes nothing else."""
    path = str(tmp_path / "grid")
    times = [NOON.replace(hour=0) + timedelta(minutes=5 * k) for k in range(288)]
    day = spark.createDataFrame([("rapid", t, 1, y, x, float(k)) for k, t in enumerate(times) for y in (0, 1, 150) for x in (0, 1)], CELL)
    late = (F.col("time") == F.lit(times[100])) | (F.col("time") == F.lit(times[7]))
    store.write_grid(day.where(~late), path, "satellite")
    store.write_grid(day.where(late), path, "satellite")
    store.write_grid(day.where(late).withColumn("value", F.col("value") + 1000), path, "satellite")  # and once more
    assert len(glob.glob(f"{path}/provider=rapid/*/*.parquet")) == 1
    chunks = store.read_chunks(spark, path)
    assert chunks.count() == 2 * 48 and {r[0] for r in chunks.select(F.size("frames")).collect()} == {6}
    assert chunks.where(F.exists("frames", lambda f: f["places"].isNotNull())).count() == 0
    cells = store.read_grid(spark, path)
    got = {(r["time"], r["y"], r["x"]): r["value"] for r in cells.collect()}
    assert got == {(t, y, x): k + (1000.0 if k in (7, 100) else 0.0) for k, t in enumerate(times) for y in (0, 1, 150) for x in (0, 1)}
    named = store.stored_times(spark, path)
    assert sorted(r["time"] for r in named.collect()) == times
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<frames:array<struct<time:timestamp>>>" in plan


def test_crop_of_full_and_sparse_tiles(spark, tmp_path):
    """A box is cut out of arrays; where cells are absent, places go along. NaN and null stay what they are."""
    path = str(tmp_path / "grid")
    full = [("rapid", NOON, 1, y, x, float("nan") if y == x else 100.0 * y + x) for y in range(95, 106) for x in range(4)]
    some = [("rapid", NOON + timedelta(minutes=5), 2, y, x, None if y == 99 else 100.0 * y + x) for y in range(95, 106) for x in range(4) if (y + x) % 3]
    cells = spark.createDataFrame(full + some, CELL)
    store.write_grid(cells, path, "satellite")
    key = lambda r: (r["time"], int(r["variable"]), r["y"], r["x"], str(r["value"]))
    assert sorted(map(key, store.read_grid(spark, path).collect())) == sorted(map(key, cells.collect()))
    for box in (((97, 102), (1, 2)), ((0, 99), (2, 9)), ((100, 100), (0, 0)), ((200, 300), (0, 9))):
        (y0, y1), (x0, x1) = box
        found = store.read_grid(spark, path, box=box, layout="satellite")
        assert sorted(map(key, found.collect())) == sorted(key(r) for r in cells.collect() if y0 <= r["y"] <= y1 and x0 <= r["x"] <= x1)


def test_reads_are_pruned(spark, tmp_path):
    path = str(tmp_path / "grid")
    for provider, days in (("rapid", 0), ("rapid", 1), ("full", 1)):
        store.write_grid(frame(spark, NOON + timedelta(days=days), provider), path, "satellite")
    one = store.read_grid(spark, path, provider="rapid", start=NOON + timedelta(hours=13), tile_y=(1, 1))
    assert sorted((r["time"], r["y"], r["x"]) for r in one.collect()) == [(NOON + timedelta(days=1), 150, x) for x in (0, 90)]
    assert [x.split("date=")[1][:10] for x in one.inputFiles()] == ["2025-01-02"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(tile_y)" in plan
    assert store.read_grid(spark, path, provider="absent").count() == 0


def test_only_demanded_files_are_read(spark, tmp_path):
    """Providers that no chosen model needs are pruned at run time, tiles outside the box of all windows by scalar filters."""
    path = str(tmp_path / "grid")
    for provider in ("rapid", "full", "other"):
        store.write_grid(frame(spark, NOON, provider, [(y, x) for y in (0, 150, 950) for x in (0, 250)]), path, "satellite")
    needs = str(tmp_path / "needs")  # a table of its own, so that Spark can't work the filter out beforehand
    spark.createDataFrame([("m", "rapid"), ("n", "full")], "model string, provider string").coalesce(1).write.parquet(needs)
    places = spark.createDataFrame([(1, 120, 40), (2, 160, 60)], "location_id int, loc_y int, loc_x int")
    chunks = store.demanded_chunks(spark, path, spark.read.parquet(needs).where("model = 'm'"), places, (24, 24), "satellite")
    found = store.cells_of(chunks)
    assert sorted((r["provider"], r["y"], r["x"]) for r in found.collect()) == [("rapid", 150, 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    parts = plan[plan.index("PartitionFilters") :]
    assert "dynamicpruning" in parts[: parts.index("ReadSchema")], plan
    assert parts.lower().count("subquery") >= 4, plan


def test_file_times(spark, tmp_path):
    path = str(tmp_path / "grid")
    before = datetime.now() - timedelta(minutes=1)
    store.write_grid(frame(spark, NOON), path, "satellite")
    (row,) = store.file_times(spark, path, "provider").collect()
    assert row["provider"] == "rapid" and before.timestamp() < row["modified"].replace(tzinfo=timezone.utc).timestamp() < datetime.now().timestamp() + 60


def test_forecast_with_metadata(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    notes = spark.createDataFrame([("modified_rapid", NOON), ("observed_1", NOON + timedelta(hours=1))], "name string, at timestamp")
    store.write_forecast(forecast_rows(spark, [NOON], ["a"]), path, notes)
    assert spark.read.parquet(path).select("values.mw").first()[0] == [0.0]
    row = store.read_forecast(spark, path).first()
    assert row["metadata"] == {"modified_rapid": "2025-01-01T12:00:00Z", "observed_1": "2025-01-01T13:00:00Z"} and row["target_time"] == NOON + timedelta(minutes=30)


def test_run_that_turns_invalid_is_retracted(spark, tmp_path):
    """Each half of a run passes; together they zig-zag: what was published goes. Replays of any batch change nothing."""
    out, path = str(tmp_path / "out"), str(tmp_path / "store")
    rows = [("z", NOON, NOON + timedelta(minutes=30 * k), float(x)) for k, x in enumerate([10, 900, 10, 900])] + [("s", NOON, NOON + timedelta(minutes=30 * k), 10.0) for k in range(4)]
    national = spark.createDataFrame(rows, "model string, init_time timestamp, target_time timestamp, mw double")
    write = jobs.validated_writer(lambda batch: v.validate(batch, 2000.0, 250.0, 500.0, 90.0), out, path)
    halves = [national.where(F.minute("target_time") == m) for m in (0, 30)]
    verdicts = lambda: {r["model"]: r["valid"] for r in jobs.latest_verdicts(spark.read.parquet(f"{out}/verdicts")).collect()}
    published = lambda: sorted(r["model"] for r in store.read_forecast(spark, path).collect())
    write(halves[0], 0)
    assert verdicts() == {"z": True, "s": True} and published() == ["s", "s", "z", "z"]
    for half in (1, 1, 0):  # the last two are replays
        write(halves[half], half)
        assert verdicts() == {"z": False, "s": True} and published() == ["s"] * 4
    assert spark.read.parquet(f"{out}/rows").count() == 8
    # What was rejected and is put right by later rows is published again.
    write(spark.createDataFrame([("z", NOON, NOON + timedelta(minutes=15), 450.0)], national.schema), 2)
    assert verdicts()["z"] == (published().count("z") > 0)


def test_late_frames_of_a_stream(spark, tmp_path):
    """A frame that comes takes its source's timer away; one three hours late is NaN, up to three hours of them."""
    path = str(tmp_path)
    parts = [[("a", 0), ("b", 1), ("a", 2)], [("a", 170)], [("a", 400)], [("b", 401)], [("c", 3000)]]
    parts = [[(source, NOON + timedelta(minutes=m)) for source, m in rows] for rows in parts]
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, "source string, time timestamp").coalesce(1).write.parquet(f"{path}/in/{k}")
    stream = spark.readStream.schema("source string, time timestamp").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        jobs.run_available(jobs.late_frames(stream), f"{path}/out", f"{path}/state")
    finally:
        spark.conf.set(name, before)
    found = sorted(((r["time"] - NOON) // timedelta(minutes=1), r["source"]) for r in spark.read.parquet(f"{path}/out").collect())
    after = lambda start, source: [(start + k, source) for k in range(5, 181, 5)]
    # By the time that 401 comes the watermark is 400, and three hours of b are late. Frames of a come before they are.
    assert found == sorted(after(1, "b") + after(400, "a") + after(401, "b"))
