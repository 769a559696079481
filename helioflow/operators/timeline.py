"""Operators on a source's time axis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioflow.functions.columns import ceil_minutes, epoch_minutes, plus_minutes, time_range
from helioflow.functions.tables import require_none, small


def source_times(grid: DataFrame) -> DataFrame:
    return grid.select("provider", "time").distinct()


def optional_sources(expected: DataFrame, times: DataFrame) -> DataFrame:
    """Which expected sources have any data; a missing one has none and doesn't stop the run."""
    found = times.groupBy("provider").agg(F.count("*").alias("n_times"))
    joined = expected.join(found, "provider", "left")
    return joined.select("provider", F.coalesce("n_times", F.lit(0)).alias("n_times"), F.col("n_times").isNotNull().alias("available"))


def demanded(grid: DataFrame, model_inputs: DataFrame) -> DataFrame:
    """Only the sources that some model needs."""
    return grid.join(model_inputs.select("provider").distinct(), "provider", "left_semi")


def choose_freshest(times: DataFrame, t0s: DataFrame | None = None) -> DataFrame:
    """For each t0 the cadence with the newest frame; the shorter cadence wins a tie.

    With ``t0s``, all t0 that must have a source, it fails if one has neither.
    """
    if t0s is not None:
        require_none(t0s.select("t0").join(times.select("t0"), "t0", "left_anti"), "no satellite source for t0")
    newest = times.groupBy("t0", "cadence").agg(F.max("time").alias("newest"))
    rank = F.row_number().over(Window.partitionBy("t0").orderBy(F.desc("newest"), "cadence"))
    return newest.withColumn("rank", rank).where("rank = 1").drop("rank")


def data_delay(times: DataFrame, keys: list[str], t0: str) -> DataFrame:
    newest = times.groupBy(*keys).agg(F.max("time").alias("newest"), F.max(t0).alias(t0))
    return newest.withColumn("delay_minutes", epoch_minutes(F.col(t0)) - epoch_minutes(F.col("newest")))


def check_cadence(times: DataFrame, keys: list[str], allowed: list[int]) -> DataFrame:
    """Whether all steps between successive times are of an allowed number of minutes."""
    before = F.lag("time").over(Window.partitionBy(*keys).orderBy("time"))
    step = epoch_minutes(F.col("time")) - epoch_minutes(F.col("before"))
    steps = times.withColumn("before", before).withColumn("step", step).where("step is not null")
    return steps.groupBy(*keys).agg(F.count("*").alias("n_steps"), F.max("step").alias("longest"), F.bool_and(F.col("step").isin(allowed)).alias("regular"))


def gap_plan(times: DataFrame, keys: list[str], step: int = 5, max_gap: int = 15) -> DataFrame:
    """How to make a dense axis: ``time, before, after, weight`` for each time that is kept.

    The axis runs from the first time of the keys to the last, every ``step`` minutes. Present times have weight null. Missing ones
    are kept in runs of at most ``max_gap / step - 1``, bounded on both sides; times off the axis support the
    interpolation, but aren't kept, unless nothing is missing or fewer than two times are on the axis: then all stay as
    they are. There is one row for each frame, so this table is small beside the grid.
    """
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("time")
    since = lambda a, b: epoch_minutes(F.col(b)) - epoch_minutes(F.col(a))
    seen = times.select(*keys, "time", F.min("time").over(whole).alias("first"), F.max("time").over(whole).alias("last")).withColumn("on_axis", since("first", "time") % step == 0)
    n_on, n_axis = F.count_if("on_axis").over(whole), F.floor(since("first", "last") / step) + 1
    seen = seen.withColumn("as_is", (n_on >= n_axis) | (n_on < 2)).drop("first", "last")
    on_axis = seen.where(F.col("on_axis") & ~F.col("as_is")).withColumn("next_on_axis", F.lead("time").over(w))
    missing = since("time", "next_on_axis") / step - 1
    gaps = on_axis.where(missing.between(1, max_gap // step - 1)).select(
        *keys, F.explode(time_range(plus_minutes(F.col("time"), step), plus_minutes(F.col("next_on_axis"), -step), step)).alias("out")
    )
    own = F.col("on_axis") | F.col("as_is")
    marks = seen.select(*keys, "time", own.alias("kept"), F.lit(False).alias("out")).unionByName(gaps.select(*keys, F.col("out").alias("time"), F.lit(True).alias("kept"), F.lit(True).alias("out")))
    # At one time a present frame comes before a missing one: there is none, both can't be.
    # Both frames run from their start to the current row: one that ends at the partition's end is quadratic.
    so_far = (Window.unboundedPreceding, Window.currentRow)
    present = F.when(~F.col("out"), F.col("time"))
    forward = Window.partitionBy(*keys).orderBy("time").rowsBetween(*so_far)
    backward = Window.partitionBy(*keys).orderBy(F.desc("time")).rowsBetween(*so_far)
    near = marks.withColumns({"before": F.last(present, ignorenulls=True).over(forward), "after": F.last(present, ignorenulls=True).over(backward)})
    return near.where("kept").select(*keys, "time", "before", "after", F.when(F.col("out"), since("before", "time") / since("before", "after")).alias("weight"))


def interpolate(frames: DataFrame, plan: DataFrame, keys: list[str], cell: list[str]) -> DataFrame:
    """Apply a gap plan to values: present frames pass, missing ones mix their neighbours.

    A frame's row in the plan says which frames it makes, itself or a mixture; the frames are joined to that once, and the two
    halves of a mixture meet by cell. No window runs over cells.
    """
    part = lambda source, second: F.struct(F.col(source).alias("source"), F.lit(second).alias("second"))
    halves = F.when(F.col("weight").isNull(), F.array(part("time", False))).otherwise(F.array(part("before", False), part("after", True)))
    roles = plan.select(*keys, "time", "weight", F.explode(halves).alias("h")).select(*keys, F.col("h.source").alias("source"), F.struct("time", "weight", "h.second").alias("role"))
    of = roles.groupBy(*keys, "source").agg(F.collect_list("role").alias("roles"))
    met = frames.select(*keys, *cell, F.col("time").alias("source"), "value").join(of, [*keys, "source"]).select(*keys, *cell, "value", F.explode("roles").alias("r"))
    side = lambda second: F.max(F.when(F.col("r.second") == second, F.struct("value")))["value"]
    both = met.groupBy(*keys, *cell, F.col("r.time").alias("time"), F.col("r.weight").alias("weight")).agg(side(False).alias("a"), side(True).alias("b"), F.count("*").alias("n"))
    mixed = F.when(F.col("weight").isNull(), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("weight"))
    # A cell that one of the neighbours lacks is not made.
    return both.where(F.col("weight").isNull() | (F.col("n") == 2)).select(*keys, *cell, "time", mixed.alias("value"), F.col("weight").isNotNull().alias("filled"))


def extension_times(times: DataFrame, keys: list[str], t0: str, step: int = 5, limit: int = 180) -> DataFrame:
    """Frames to append after the newest one, up to t0 and ``limit`` minutes at most; none without delay."""
    newest = times.groupBy(*keys).agg(F.max("time").alias("newest"), F.max(t0).alias(t0))
    stop = F.least(F.col(t0), plus_minutes(F.col("newest"), limit))
    return newest.select(*keys, F.explode(time_range(plus_minutes(F.col("newest"), step), stop, step)).alias("time"))


def satellite_needs(models: DataFrame, t0s: DataFrame) -> DataFrame:
    """Every 5 minutes from t0+start to t0+end that a model reads; a dropout ends it earlier."""
    end = F.when(F.col("dropout_fraction") > 0, F.least("end_min", "dropout_min")).otherwise(F.col("end_min"))
    span = time_range(plus_minutes(F.col("t0"), F.col("start_min")), plus_minutes(F.col("t0"), end), 5)
    return _pairs(models, t0s).select("model", "t0", F.explode(span).alias("time"))


def nwp_needs(models: DataFrame, t0s: DataFrame, resolution: int = 60) -> DataFrame:
    """Times from t0+start to t0+end, both rounded up; one more for accumulated channels."""
    start = ceil_minutes(plus_minutes(F.col("t0"), F.col("start_min")), resolution)
    end = ceil_minutes(plus_minutes(F.col("t0"), F.col("end_min")), resolution)
    end = F.when(F.col("accumulated"), plus_minutes(end, resolution)).otherwise(end)
    return _pairs(models, t0s).select("model", "t0", "provider", F.explode(time_range(start, end, resolution)).alias("time"))


def _pairs(models: DataFrame, t0s: DataFrame) -> DataFrame:
    """Every model for every t0: the wanted result."""
    return t0s.crossJoin(small(models))


def missing_inputs(needs: DataFrame, times: DataFrame, on: list[str]) -> DataFrame:
    return needs.join(times.select(*on).distinct(), on, "left_anti")


def available(needs: DataFrame, times: DataFrame, on: list[str]) -> DataFrame:
    """For each (model, t0): how many needed times are missing, and whether none is."""
    have = times.select(*on).distinct().withColumn("have", F.lit(1))
    counted = needs.join(have, on, "left").groupBy("model", "t0").agg((F.count("*") - F.count("have")).alias("n_missing"))
    return counted.withColumn("ok", F.col("n_missing") == 0)


def runnable(*checks: DataFrame, required: bool = False) -> DataFrame:
    """A model runs if every check that covers it holds.

    With ``required`` it fails if there is a t0 for which no model can run.
    """
    both = checks[0].select("model", "t0", "ok")
    for check in checks[1:]:
        both = both.unionByName(check.select("model", "t0", "ok"))
    found = both.groupBy("model", "t0").agg(F.bool_and("ok").alias("runnable"))
    if required:
        require_none(found.groupBy("t0").agg(F.bool_or("runnable").alias("any")).where("not any").select("t0"), "no model can run for t0")
    return found


def latest_init_asof(t0s: DataFrame, inits: DataFrame, keys: list[str] | None = None, max_staleness: int | None = None, bucket: int = 1440) -> DataFrame:
    """For each row of ``t0s`` the newest init of its keys not after its t0 (null: none).

    ``max_staleness``: an init older than so many minutes counts as none; by default there is no limit. Both
    tables are sorted together within buckets of time; what a bucket starts with is the last init of
    all buckets before it, from a table of one row a bucket. The work is linear in the rows.
    """
    keys = keys or []
    place = lambda c: F.floor(epoch_minutes(F.col(c)) / bucket)
    asks = t0s.select(*keys, "t0").distinct().select(*keys, place("t0").alias("bucket"), F.col("t0").alias("at"), F.lit(None).cast("timestamp").alias("init"))
    given = inits.select(*keys, place("init_time").alias("bucket"), F.col("init_time").alias("at"), F.col("init_time").alias("init"))
    both = asks.unionByName(given)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*keys, "bucket").orderBy("at", F.col("init").isNull()).rowsBetween(*so_far)
    ends = both.groupBy(*keys, "bucket").agg(F.max("init").alias("own"))
    carried = ends.withColumn("carried", F.max("own").over(Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).drop("own")
    seen = both.withColumn("own", F.max("init").over(inside)).where("init is null").join(carried, [*keys, "bucket"])
    init = F.coalesce("own", "carried")
    if max_staleness is not None:
        init = F.when(epoch_minutes(F.col("at")) - epoch_minutes(init) <= max_staleness, init)
    return t0s.join(seen.select(*keys, F.col("at").alias("t0"), init.alias("init_time")), [*keys, "t0"], "left")
