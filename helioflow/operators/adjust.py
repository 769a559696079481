"""Adjusting national forecasts by their recent error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioflow.functions.columns import epoch_minutes, plus_minutes
from helioflow.functions.tables import require_none, small

LARGEST_SHARE = 0.1
LARGEST_MW = 1000.0


def week_average_deltas(forecast: DataFrame, observed: DataFrame, pivot: Column, days: int = 7) -> DataFrame:
    """Mean of forecast less observation, as fractions, by forecaster, location and horizon, over the
    days before the pivot (its own time left out)."""
    inside = forecast.where((F.col("target_time") >= plus_minutes(pivot, -days * 1440)) & (F.col("target_time") < pivot))
    both = inside.join(observed, ["location_id", "target_time"])
    return both.groupBy("forecaster", "location_id", "horizon_mins").agg(F.avg(F.col("p50") - F.col("observed")).alias("delta"))


def deltas_for_pivots(forecast: DataFrame, observed: DataFrame, pivots: DataFrame, days: int = 7, step: int = 1440) -> DataFrame:
    """``week_average_deltas`` for every pivot of a table (``init_time``) in one pass: ``init_time, forecaster, location_id, horizon_mins, delta``.

    Errors are summed by slots of ``step`` minutes, on whose bounds the pivots must lie; a window by range over the slots adds up the
    ``days`` before each pivot. A pivot without any error in them has no row.
    """
    keys, span = ["forecaster", "location_id", "horizon_mins"], days * 1440 // step
    asked = pivots.select("init_time", (epoch_minutes(F.col("init_time")) / step).alias("at")).distinct()
    require_none(asked.where(F.col("at") != F.floor("at")).select("init_time"), f"pivots between slots of {step} minutes")
    errors = forecast.join(observed, ["location_id", "target_time"]).withColumn("slot", F.floor(epoch_minutes(F.col("target_time")) / step))
    parts = errors.groupBy(*keys, "slot").agg(F.sum(F.col("p50") - F.col("observed")).alias("error"), F.count("*").alias("n"))
    lived = parts.groupBy(*keys).agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    slots = lived.select(*keys, F.explode(F.sequence(F.col("first") + 1, F.col("last") + span)).alias("slot"))
    asks = slots.join(small(asked.select(F.col("at").cast("long").alias("slot"), "init_time")), "slot")
    both = parts.withColumn("init_time", F.lit(None).cast("timestamp")).unionByName(asks.withColumns({"error": F.lit(None).cast("double"), "n": F.lit(None).cast("long")}))
    week = Window.partitionBy(*keys).orderBy("slot").rangeBetween(-span, -1)
    summed = both.withColumns({"error": F.sum("error").over(week), "n": F.sum("n").over(week)}).where("init_time is not null and n > 0")
    return summed.select("init_time", *keys, (F.col("error") / F.col("n")).alias("delta"))


def limit_adjuster(delta: Column, p50: Column, capacity_mw: Column) -> Column:
    """Within 10 % of the forecast first, then within 1000 MW; a NaN delta stays."""
    share, fixed = LARGEST_SHARE * p50, LARGEST_MW / capacity_mw
    first = F.when(F.isnan(delta), delta).when(delta > share, share).when(delta < -share, -share).otherwise(delta)
    return F.when(F.isnan(first), first).when(first > fixed, fixed).when(first < -fixed, -fixed).otherwise(first)


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("rank", rank).where("rank = 1").drop("rank")


def apply_adjuster(values: DataFrame, deltas: DataFrame, capacity_mw: Column) -> DataFrame:
    """Subtract the limited delta of the same horizon (none: 0) from the forecast and each level, within [0, 1].

    ``deltas`` may repeat a horizon: the first one by ``place`` counts. If they have an ``init_time`` they are a run's own.
    """
    keys = ["forecaster", "horizon_mins", *(c for c in ("init_time",) if c in deltas.columns)]
    one = first_per_key(deltas, keys, ["place"]).select(*keys, "delta")
    joined = values.join(one, keys, "left")
    limited = limit_adjuster(F.coalesce("delta", F.lit(0.0)), F.col("p50"), capacity_mw)
    unit = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    out = joined.withColumn("limited", limited)
    return out.withColumns({
        "p50": unit(F.col("p50") - F.col("limited")), "levels": F.transform_values("levels", lambda _, v: unit(v - F.col("limited"))),
        "forecaster": F.concat("forecaster", F.lit("_adjust")),
    }).drop("delta")
