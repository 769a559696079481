"""What depends on a place alone is worked out once for each place, not for each location or target."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from helioflow.operators import grid as g
from helioflow.plans import queries


def shuffled_by(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\((.*?)\), ", plan)}


@pytest.mark.parametrize("name", ["regrid_bilinear", "regrid_coordinates", "prepare_nwp"])
def test_products_of_weights_are_not_shuffled(spark, sf_dir, name):
    assert not any("target_id" in by for by in shuffled_by(queries.QUERIES[name](spark, sf_dir)))


def test_windows_are_not_shuffled_by_location(spark, sf_dir):
    assert not any(re.match("location_id, variable", by) for by in shuffled_by(queries.QUERIES["location_window"](spark, sf_dir)))


def test_checksums_are_made_before_locations(spark, sf_dir, monkeypatch):
    seen, own = [], g.features_of
    monkeypatch.setattr(g, "features_of", lambda made, *rest: seen.append(set(made.columns)) or own(made, *rest))
    queries.QUERIES["assemble_features"](spark, sf_dir)
    assert seen == [{"config", "t0", "loc_y", "loc_x", "variable", "n_values", "checksum", "first_value"}]


def test_scores_are_made_before_locations(spark, sf_dir, monkeypatch):
    seen, own = [], queries.f.score_features
    monkeypatch.setattr(queries.f, "score_features", lambda features, *rest: seen.append(set(features.columns)) or own(features, *rest))
    queries.QUERIES["score_features"](spark, sf_dir)
    assert seen == [{"config", "t0", "loc_y", "loc_x", "variable", "values"}]


def test_targets_of_one_place(spark):
    """Targets at one place share its values; a cell that is absent adds nothing, a null is no value, targets outside have no row."""
    cells = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, 3.0), (0, 1, 0, None), (1, 1, 1, 8.0)], "frame long, y long, x long, value double")
    targets = spark.createDataFrame([(1, 0.0, 0.5), (2, 0.0, 0.5), (3, 1.0, 0.0), (4, 5.0, 0.0), (5, None, 0.0), (6, 0.5, 1.0)], "target_id long, ty double, tx double")
    found = g.regrid_unless_same(cells, targets, 2, 2, ["frame"]).orderBy("frame", "target_id").collect()
    assert [tuple(r) for r in found] == [(0, 1, 2.0), (0, 2, 2.0), (0, 3, None), (0, 6, 1.5), (1, 6, 4.0)]


def test_frames_are_summed_in_blocks(spark, monkeypatch):
    """However many frames there are, a task sums no more values than it may; the result is that of one block."""
    monkeypatch.setattr(g, "TASK_VALUES", 40)
    monkeypatch.setattr(g, "BLOCK_VALUES", 10)
    cells = spark.range(50).select(F.col("id").alias("frame"), F.posexplode(F.array(*(F.col("id") * k * 1.0 for k in range(4))))).selectExpr("frame", "cast(pos div 2 as long) y", "cast(pos % 2 as long) x", "col value")
    targets = spark.createDataFrame([(i, i % 5 / 4, i % 3 / 2) for i in range(60)], "target_id long, ty double, tx double")
    found = g.regrid_unless_same(cells, targets, 2, 2, ["frame"], lambda v: F.round(v, 3))
    assert found.rdd.getNumPartitions() >= 50 * 15 // 40
    rows = [(r["frame"], r["target_id"], r["value"]) for r in found.collect()]
    assert sorted(rows) == [(f, i, round(f * (i % 5 / 2 + i % 3 / 2), 3)) for f in range(50) for i in range(60)]


@pytest.mark.parametrize("name", ["regrid_bilinear", "regrid_coordinates", "prepare_nwp"])
def test_values_are_rounded_before_targets(spark, sf_dir, name):
    """Values at a place are rounded once, and come out in runs of their targets."""
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Generate explode(ids") < plan.index("round(")


def test_features_of_keeps_what_was_made(spark):
    made = spark.range(1).select(F.lit("a").alias("config"), F.lit(3).alias("t0"), F.lit(1).alias("loc_y"), F.lit(2).alias("loc_x"), F.lit(0).alias("variable"), F.lit(0.5).alias("score"))
    models = spark.createDataFrame([("m", "a")], "model string, config string")
    places = spark.createDataFrame([(7, 1, 2), (8, 1, 2), (9, 2, 2)], "location_id long, loc_y int, loc_x int")
    found = g.features_of(made, models, places).orderBy("location_id").collect()
    assert [(r["model"], r["location_id"], r["score"]) for r in found] == [("m", 7, 0.5), ("m", 8, 0.5)]


def test_features_are_dealt_before_locations(spark):
    """Few rows become many: they are spread over all cores however few bytes they have, and none is lost."""
    made = spark.range(600).select(F.lit("a").alias("config"), F.col("id").alias("t0"), F.lit(1).alias("loc_y"), F.lit(2).alias("loc_x"), F.lit(0).alias("variable"), F.lit(0.5).alias("score"))
    models = spark.createDataFrame([("m", "a"), ("n", "a")], "model string, config string")
    places = spark.range(50).selectExpr("id as location_id", "1 as loc_y", "2 as loc_x")
    found = g.features_of(made.coalesce(1), models, places)
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 600 * 2 * 50 and len(tasks) > spark.sparkContext.defaultParallelism


def test_features_come_out_in_runs(spark, monkeypatch):
    """In a task, some of a place's locations are named for all its samples before others are; no row is lost, nor are null ids and models."""
    monkeypatch.setattr(g, "RUN", 8, raising=False)
    made = spark.range(600).selectExpr("'a' as config", "id div 2 as t0", "id % 2 as loc_y", "2 as loc_x", "0 as variable", "id * 0.5D as score")
    models = spark.createDataFrame([("m", "a"), (None, "a"), ("o", "b")], "model string, config string")
    places = spark.range(81).selectExpr("if(id = 80, null, id) as location_id", "id % 2 as loc_y", "2 as loc_x")
    found = g.features_of(made, models, places).withColumn("task", F.spark_partition_id()).collect()
    rows = [(r["model"], r["t0"], r["location_id"], r["score"]) for r in found]
    ids = [*range(80), None]
    assert set(rows) == {(m, t, i, t + (i or 0) % 2 * 0.5) for m in ("m", None) for t in range(300) for i in ids} and len(rows) == 2 * 300 * 81
    order = {i: (y, n // 8) for y in (0, 1) for n, i in enumerate([None] * (1 - y) + [k for k in range(80) if k % 2 == y])}
    for task in {r["task"] for r in found}:
        seen = [order[r["location_id"]] for r in found if r["task"] == task]
        assert seen == sorted(seen)
