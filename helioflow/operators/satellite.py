"""Repair of the satellite's frames: choose, check, fill and extend, for many t0 at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioflow.functions.columns import epoch_minutes, plus_minutes, time_range
from helioflow.functions.tables import require_none, small
from helioflow.operators import timeline as t


def frame_shares(cells: DataFrame, checks: list[tuple[Column, float]], keys: list[str]) -> DataFrame:
    """One row for each frame: the share of its cells for which each check's condition holds, as ``share_0`` and on."""
    return cells.groupBy(*keys).agg(*((F.count_if(hit) / F.count("*")).alias(f"share_{k}") for k, (hit, _) in enumerate(checks)))


def _bucket(c: str, minutes: int) -> Column:
    return F.floor(epoch_minutes(F.col(c)) / minutes)


def recent_frames(frames: DataFrame, t0s: DataFrame, minutes: int, n_checks: int) -> DataFrame:
    """For each t0 and cadence: the newest frame of the ``minutes`` up to t0 (that one included), and the worst share of each check.

    A window by a range of time runs over the frames' rows, with a row in between for each t0. Frames are put to their own and
    the next bucket of ``minutes``, so that no window is longer than two buckets, however long the archive is.
    """
    shares = [f"share_{k}" for k in range(n_checks)]
    seen = frames.select("cadence", "time", *shares, F.explode(F.array(_bucket("time", minutes), _bucket("time", minutes) + 1)).alias("bucket"), F.lit(None).cast("timestamp").alias("t0"))
    cadences = frames.select("cadence").distinct()
    asks = t0s.select("t0").distinct().crossJoin(small(cadences)).select("cadence", F.col("t0").alias("time"), *(F.lit(None).cast("double").alias(s) for s in shares), _bucket("t0", minutes).alias("bucket"), "t0")
    span = Window.partitionBy("cadence", "bucket").orderBy("at").rangeBetween(-(minutes * 60_000_000 - 1), 0)
    both = seen.unionByName(asks).withColumn("at", F.unix_micros("time"))
    found = both.withColumns({"newest": F.max(F.when(F.col("t0").isNull(), F.col("time"))).over(span), **{f"worst_{k}": F.max(s).over(span) for k, s in enumerate(shares)}})
    return found.where("t0 is not null and newest is not null").select("t0", "cadence", "newest", *(f"worst_{k}" for k in range(n_checks)))


def repair(
    cells: DataFrame, t0s: DataFrame, checks: list[tuple[Column, float]], cell: list[str], minutes: int = 180, step: int = 5, max_gap: int = 15, limit: int = 180,
    required: bool = False, inside: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """For each t0: the frames of the freshest cadence, checked, with short gaps filled, extended to t0.

    ``cells`` has ``cadence, time, value`` and the ``cell`` columns. A t0 of which any frame fails a check
    (condition, largest share) has no frames; the check looks at the cells ``inside`` only, such as those of
    the locations' box. Returns ``t0, cadence, time, *cell, value, kind``, where kind is ``seen``, ``filled`` or ``extended`` (value
    NaN), and ``t0, valid_times``: the times before extension, which decide what models can run. With
    ``required`` it fails if a t0 has no source.

    What is decided is decided on a row for each frame. Cells are read once for the frames' shares and once for
    the result: a filled frame is made once, of its two neighbours, and frames are copied to the t0 that read them at the end.
    """
    shares = frame_shares(cells if inside is None else cells.where(inside), checks, ["cadence", "time"])
    # A frame without a cell inside is a frame that fails no check.
    frames = shares if inside is None else cells.select("cadence", "time").distinct().join(shares, ["cadence", "time"], "left")
    recent = recent_frames(frames, t0s, minutes, len(checks))
    if required:
        require_none(t0s.select("t0").join(recent.select("t0"), "t0", "left_anti"), "no satellite source for t0")
    rank = F.row_number().over(Window.partitionBy("t0").orderBy(F.desc("newest"), "cadence"))
    good = recent.withColumn("rank", rank).where("rank = 1")
    for k, (_, threshold) in enumerate(checks):
        good = good.where(F.coalesce(F.col(f"worst_{k}") <= threshold, F.lit(True)))
    asks = good.select("t0", "cadence", F.explode(F.sequence(_bucket("t0", minutes) - 1, _bucket("t0", minutes))).alias("bucket"))
    seen = frames.select("cadence", "time", _bucket("time", minutes).alias("bucket")).join(asks, ["cadence", "bucket"])
    age = F.unix_micros("t0") - F.unix_micros("time")
    plan = t.gap_plan(seen.where((age >= 0) & (age < minutes * 60_000_000)).select("t0", "cadence", "time"), ["t0", "cadence"], step, max_gap)
    valid = plan.groupBy("t0").agg(F.array_sort(F.collect_list("time")).alias("valid_times"))
    newest = F.max("time").over(Window.partitionBy("t0", "cadence"))
    last = plan.select("t0", "cadence", "time", F.when(F.col("weight").isNull(), "seen").otherwise("filled").alias("kind"), newest.alias("newest"))
    stop = F.least(F.col("t0"), plus_minutes(F.col("newest"), limit))
    more = F.when(F.col("time") == F.col("newest"), time_range(plus_minutes(F.col("newest"), step), stop, step)).otherwise(F.array().cast("array<timestamp>"))
    wanted = last.select("t0", "cadence", "time", "kind", more.alias("more"))
    made = t.interpolate(cells, plan.drop("t0").distinct(), ["cadence"], cell).drop("filled")
    copied = made.join(wanted, ["cadence", "time"])
    own = F.array(F.struct("time", "value", "kind"))
    nan = F.transform("more", lambda m: F.struct(m.alias("time"), F.lit(float("nan")).alias("value"), F.lit("extended").alias("kind")))
    each = copied.select("t0", "cadence", *cell, F.explode(F.concat(own, nan)).alias("f"))
    return each.select("t0", "cadence", "f.time", *cell, "f.value", "f.kind"), valid
