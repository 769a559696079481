"""Views that give the driver's tables the shapes of grids, forecasts and locations, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioflow.functions.columns import floor_minutes, plus_minutes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``time, value``: the satellite's time axis, every 5 minutes with natural gaps."""
    return events(spark, sf_dir).groupBy(floor_minutes(F.col("ts"), 5).alias("time")).agg(F.max("value").alias("value"))


def provider_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``provider, time, value``."""
    return events(spark, sf_dir).groupBy(F.col("event_type").alias("provider"), floor_minutes(F.col("ts"), 5).alias("time")).agg(F.max("value").alias("value"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``frame, variable, y, x, value``: 8 x 8 cells."""
    cells = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame"), F.col("label").cast("long").alias("variable"), F.posexplode("embedding").alias("i", "v"))
    return cells.select("frame", "variable", F.expr("i div 8").alias("y"), (F.col("i") % 8).cast("long").alias("x"), F.col("v").cast("double").alias("value"))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model, init_time, location_id, target_time, mw``: half-hours of a day."""
    ev = events(spark, sf_dir)
    keys = [
        F.col("event_type").alias("model"), floor_minutes(F.col("ts"), 1440).alias("init_time"), F.col("user_id").alias("location_id"), floor_minutes(F.col("ts"), 30).alias("target_time"),
    ]
    return ev.groupBy(*keys).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("mw"))


def national(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model, init_time, target_time, mw``: all 48 half-hours, 0 where nothing is."""
    own = forecast(spark, sf_dir).groupBy("model", "init_time", "target_time").agg(F.sum(F.col("mw").cast("decimal(18,2)")).cast("double").alias("mw"))
    slots = own.select("model", "init_time").distinct().withColumn("target_time", F.explode(F.transform(F.sequence(F.lit(0), F.lit(47)), lambda k: plus_minutes(F.col("init_time"), k * 30))))
    return slots.join(own, ["model", "init_time", "target_time"], "left").withColumn("mw", F.coalesce("mw", F.lit(0.0)))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``location_id, name, nation, capacity``; a balance of 0 or less is no capacity."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    capacity = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_custkey").alias("location_id"), F.col("c_name").alias("name"), F.col("n_nationkey").cast("long").alias("nation"), capacity.alias("capacity"))


VIEWS_SQL = {
    "frames": "select time_bucket(interval '5 minutes', ts) as time, max(value) as value from events group by 1",
    "provider_frames": "select event_type as provider, time_bucket(interval '5 minutes', ts) as time, max(value) as value from events group by 1, 2",
    "cells": "select vec_id, label, embedding, unnest(range(64)) as i from embeddings",
    "grid": "select vec_id as frame, cast(label as bigint) as variable, i // 8 as y, i % 8 as x, cast(embedding[i + 1] as double) as value from cells",
    "forecast": """select event_type as model, cast(date_trunc('day', ts) as timestamp) as init_time, user_id as location_id,
        time_bucket(interval '30 minutes', ts) as target_time, cast(sum(cast(value as decimal(18, 2))) as double) as mw from events group by 1, 2, 3, 4""",
    "own_national": "select model, init_time, target_time, cast(sum(cast(mw as decimal(18, 2))) as double) as mw from forecast group by 1, 2, 3",
    "slots": "select model, init_time, init_time + to_minutes(30 * unnest(range(48))) as target_time from (select distinct model, init_time from own_national)",
    "national": "select model, init_time, target_time, coalesce(mw, 0.0) as mw from slots left join own_national using (model, init_time, target_time)",
    "locations": """select c_custkey as location_id, c_name as name, cast(n_nationkey as bigint) as nation, case when c_acctbal > 0 then c_acctbal end as capacity
        from customer join nation on c_nationkey = n_nationkey""",
}
_NEEDS = {"grid": ["cells"], "own_national": ["forecast"], "slots": ["own_national"], "national": ["slots"]}


def with_views(sql: str, *names: str) -> str:
    """SQL with the named views, and those they need, before it. ``sql`` may begin with more of them."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({VIEWS_SQL[n]})" for n in wanted) + (",\n" if sql.lstrip().startswith(">") else "\n") + sql.lstrip().removeprefix(">")
