"""Operators on gridded sources: rows of (frame keys, variable, y, x, value)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioflow.functions.columns import is_number, laea_of_lonlat, lonlat_of_laea, place_on_axis, plus_minutes, to_float16
from helioflow.functions.tables import require_none, small

#: Rows of regridding weights, some 40 bytes each, that may go to every task.
MOST_WEIGHTS = 1_000_000
#: Regridded values, some 100 bytes each, that a task sums at most, and those of a block of its frames.
TASK_VALUES, BLOCK_VALUES = 400_000, 50_000
#: Tasks for each core, where few rows become many: the last ones end nearly together.
TASKS_PER_CORE = 4
#: Locations of a place that are named for one sample before they are for the next: a short list, of a multiple of the eight values that files pack together.
RUN = 512


def rename_variables(grid: DataFrame, names: DataFrame) -> DataFrame:
    """Rename by (provider, variable) -> new; unknown names pass through. The grid is not shuffled."""
    return grid.join(small(names), ["provider", "variable"], "left").withColumn("variable", F.coalesce("new", "variable")).drop("new")


def with_valid_time(grid: DataFrame) -> DataFrame:
    """``valid_time`` = init_time + step, with the step in hours or minutes by ``step_unit``."""
    minutes = F.when(F.col("step_unit") == "hours", F.col("step") * 60).otherwise(F.col("step"))
    return grid.withColumn("valid_time", plus_minutes(F.col("init_time"), minutes))


def half_precision(grid: DataFrame) -> DataFrame:
    return grid.withColumn("value", to_float16(F.col("value")))


def spatial_filter(grid: DataFrame, x0: float, x1: float, y0: float, y1: float) -> DataFrame:
    """Cells in a box, edges included, whatever the order of the bounds."""
    return grid.where(F.col("x").between(min(x0, x1), max(x0, x1)) & F.col("y").between(min(y0, y1), max(y0, y1)))


def select_channels(grid: DataFrame, channels: DataFrame) -> DataFrame:
    return grid.join(small(channels.select("provider", "variable").distinct()), ["provider", "variable"], "left_semi")


def normalise(grid: DataFrame, constants: DataFrame) -> DataFrame:
    """(value - mean) / std by variable."""
    return grid.join(small(constants), "variable").withColumn("value", (F.col("value") - F.col("mean")) / F.col("std")).drop("mean", "std")


def value_fraction(grid: DataFrame, keys: list[str], hit: Column) -> DataFrame:
    """The share of a frame's cells for which ``hit`` holds."""
    return grid.groupBy(*keys).agg((F.count_if(hit) / F.count("*")).alias("fraction"))


def too_many(fractions: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Whether any frame's share is above the threshold (strictly)."""
    return fractions.groupBy(*keys).agg(F.max("fraction").alias("worst")).withColumn("too_many", F.col("worst") > threshold)


def data_ok(grid: DataFrame, keys: list[str], frame: str, checks: list[tuple[Column, float]]) -> DataFrame:
    """All checks (condition, largest share in any frame) at once: one pass over the cells."""
    shares = [(F.count_if(hit) / F.count("*")).alias(f"share_{k}") for k, (hit, _) in enumerate(checks)]
    worst = grid.groupBy(*keys, frame).agg(*shares).groupBy(*keys).agg(*(F.max(f"share_{k}").alias(f"worst_{k}") for k in range(len(checks))))
    ok = F.lit(True)
    for k, (_, threshold) in enumerate(checks):
        ok = ok & (F.col(f"worst_{k}") <= threshold)
    return worst.withColumn("ok", ok)


def has_nan(grid: DataFrame, keys: list[str]) -> DataFrame:
    return grid.groupBy(*keys).agg(F.bool_or(~is_number(F.col("value"))).alias("has_nan"))


def require_not_zero(grid: DataFrame, keys: list[str], what: str = "all values are zero") -> None:
    """Fail, naming them, if some keys have nothing but zeros."""
    require_none(all_zero(grid, keys).where("all_zero").select(*keys), what)


def all_zero(grid: DataFrame, keys: list[str]) -> DataFrame:
    """NaN and null are not zero."""
    return grid.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col("value") == 0, F.lit(False))).alias("all_zero"))


def window_cells(grid: DataFrame, locations: DataFrame, height: int, width: int, tile: int) -> DataFrame:
    """Cells in each location's window (height x width around its y and x, the middle rounded down).

    A window names the tiles that it touches; tiles are joined by equality and the edges checked
    after, so the work follows the windows' cells.
    """
    y0, x0 = F.col("loc_y") - height // 2, F.col("loc_x") - width // 2
    spans = locations.select(
        "location_id", y0.alias("y0"), (y0 + height - 1).alias("y1"), x0.alias("x0"), (x0 + width - 1).alias("x1")
    )
    tiles = spans.withColumn("tile_y", F.explode(F.sequence(F.floor(F.col("y0") / tile), F.floor(F.col("y1") / tile)))).withColumn(
        "tile_x", F.explode(F.sequence(F.floor(F.col("x0") / tile), F.floor(F.col("x1") / tile)))
    )
    cells = grid.withColumns({"tile_y": F.floor(F.col("y") / tile), "tile_x": F.floor(F.col("x") / tile)})
    joined = cells.join(tiles, ["tile_y", "tile_x"])
    return joined.where(F.col("y").between(F.col("y0"), F.col("y1")) & F.col("x").between(F.col("x0"), F.col("x1"))).drop("tile_y", "tile_x", "y0", "y1", "x0", "x1")


def bounding_box(cells: DataFrame) -> DataFrame:
    return cells.agg(*(f(c).alias(f"{c}_{name}") for c in ("x", "y") for f, name in ((F.min, "min"), (F.max, "max"))))


def bilinear_weights(targets: DataFrame, height: int, width: int) -> DataFrame:
    """Weights of the (up to) four cells around each target's (ty, tx), in cell units; targets outside give none."""
    inside = targets.where(F.col("ty").between(0, height - 1) & F.col("tx").between(0, width - 1))
    low = lambda c, n: F.least(F.floor(c), F.lit(n - 2))
    base = inside.withColumns({"y_low": low("ty", height), "x_low": low("tx", width)})
    corners = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (0, 1) for dx in (0, 1)))
    each = base.withColumn("c", F.explode(corners)).select("target_id", "ty", "tx", "y_low", "x_low", "c.dy", "c.dx")
    part = lambda t, low, d: F.when(F.col(d) == 1, F.col(t) - F.col(low)).otherwise(1 - (F.col(t) - F.col(low)))
    weight = part("ty", "y_low", "dy") * part("tx", "x_low", "dx")
    return each.select("target_id", (F.col("y_low") + F.col("dy")).alias("y"), (F.col("x_low") + F.col("dx")).alias("x"), weight.alias("w")).where("w > 0")


def axes_of(grid: DataFrame, y: str, x: str, falling: bool = False) -> DataFrame:
    """One row with the sorted coordinates of a grid's rows and columns: ``y_axis`` (from the top, if ``falling``) and ``x_axis``."""
    return grid.agg(F.sort_array(F.collect_set(y), not falling).alias("y_axis"), F.sort_array(F.collect_set(x)).alias("x_axis"))


def on_axes(targets: DataFrame, axes: DataFrame, y: str, x: str) -> DataFrame:
    """``targets`` with ``ty, tx``: their coordinates in steps of the axes; null where an axis doesn't reach."""
    both = targets.crossJoin(F.broadcast(axes))  # one row
    placed = both.withColumns({"ty": place_on_axis(F.col(y), F.col("y_axis")), "tx": place_on_axis(F.col(x), F.col("x_axis"))})
    return placed.select(*targets.columns, "ty", "tx")


def regrid_by_coordinates(
    grid: DataFrame, targets: DataFrame, y: str, x: str, keys: list[str], falling: bool = False, of: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``regrid`` of cells that carry coordinates, to targets that do: ``target_id`` and the columns ``y`` and ``x``; ``of`` as in ``regrid_unless_same``.

    Targets are looked up in the grid's axes, and the weights' corners get the axes' own values, so that cells are joined by their
    coordinates.
    """
    axes = axes_of(grid, y, x, falling)
    placed = on_axes(targets.select("target_id", y, x), axes, y, x)
    size = axes.select(F.size("y_axis").alias("h"), F.size("x_axis").alias("w")).first()
    weights = bilinear_weights(places_of(placed), size["h"], size["w"]).crossJoin(F.broadcast(axes))
    corners = weights.select("target_id", F.get("y_axis", F.col("y").cast("int")).alias(y), F.get("x_axis", F.col("x").cast("int")).alias(x), "w")
    return at_targets(_block_values(grid, corners, keys, (y, x)), placed, keys, of)


def places_of(targets: DataFrame) -> DataFrame:
    """The distinct ``ty, tx`` of targets, each a target of its own: ``target_id`` has both."""
    return targets.select("ty", "tx").distinct().withColumn("target_id", F.struct("ty", "tx"))


def _block_values(grid: DataFrame, weights: DataFrame, keys: list[str], cell: tuple[str, str]) -> DataFrame:
    """``regrid`` with columns ``part``, the task, and ``block``, one of its groups of frames: a task's sums fit into its memory, however many frames there are."""
    targets, frames = (t.count() for t in (weights.select("target_id").distinct(), grid.select(*keys).distinct()))
    parts = max(int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions")), frames * targets // TASK_VALUES + 1)
    blocks = frames * targets // (parts * BLOCK_VALUES) + 1
    hashed = F.xxhash64(*keys)
    own = [F.pmod(hashed, F.lit(parts)).cast("int").alias("part"), F.pmod(F.shiftright(hashed, 32), F.lit(blocks)).cast("int").alias("block")]
    dealt = grid.select(*keys, *cell, "value", *own).repartitionById(parts, F.col("part"))
    summed = dealt.join(small(weights, MOST_WEIGHTS), list(cell)).groupBy("part", "block", *keys, "target_id")
    return summed.agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def regrid(grid: DataFrame, weights: DataFrame, keys: list[str], cell: tuple[str, str] = ("y", "x")) -> DataFrame:
    """A sparse matrix product: join on the cell, sum weight times value, for each of the keys and ``target_id``.

    Cells are dealt by their keys before they are multiplied: the products, which are far more, are summed where they are made.
    """
    return _block_values(grid, weights, keys, cell).drop("part", "block")


def at_targets(values: DataFrame, targets: DataFrame, keys: list[str], of: Callable[[Column], Column] | None = None) -> DataFrame:
    """Values of ``places_of``, with their ``part`` and ``block``, to all targets that lie there.

    A block's values at a place are one row until the targets are joined. The rows come out by place, then by frame: runs of equal values and a short
    list of targets that repeats, which columns of a file store in little space.
    """
    values = values.withColumn("value", of(F.col("value"))) if of else values
    rows = values.groupBy("part", "block", "target_id").agg(F.collect_list(F.struct(*keys, "value")).alias("rows"))
    named = targets.where("ty is not null and tx is not null").groupBy("ty", "tx").agg(F.sort_array(F.collect_list("target_id")).alias("ids"))
    placed = rows.select(F.col("target_id.ty").alias("ty"), F.col("target_id.tx").alias("tx"), "rows")
    each = placed.join(small(named, MOST_WEIGHTS), ["ty", "tx"]).select(F.explode("rows").alias("r"), "ids")
    return each.select("r.*", F.explode("ids").alias("target_id")).select(*keys, "target_id", "value")


def same_coordinates(targets: DataFrame, height: int, width: int) -> bool:
    """Whether the targets are the grid's own cells, in any order: then there is nothing to regrid."""
    own = (F.col("ty") == F.rint("ty")) & (F.col("tx") == F.rint("tx")) & F.col("ty").between(0, height - 1) & F.col("tx").between(0, width - 1)
    n, on_cells, distinct = targets.agg(F.count("*"), F.count_if(own), F.count_distinct("ty", "tx")).first()
    return n == on_cells == distinct == height * width


def regrid_unless_same(
    grid: DataFrame, targets: DataFrame, height: int, width: int, keys: list[str], of: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Bilinear values at the targets, made once for each place of some target; values are only renamed if coordinates are equal.

    ``of`` is what to make of a value, such as a rounded one: it is made for each place, not for each target."""
    if same_coordinates(targets, height, width):
        cells = small(targets.select("target_id", F.col("ty").cast("long").alias("y"), F.col("tx").cast("long").alias("x")))
        return grid.join(cells, ["y", "x"]).select(*keys, "target_id", (of or (lambda v: v))(F.col("value")).alias("value"))
    return at_targets(_block_values(grid, bilinear_weights(places_of(targets), height, width), keys, ("y", "x")), targets, keys, of)


def diff_accumulated(grid: DataFrame, keys: list[str], step: str) -> DataFrame:
    """The next step's value less this one's; the last step has none."""
    ahead = F.lead("value").over(Window.partitionBy(*keys).orderBy(step))
    return grid.withColumn("value", ahead - F.col("value")).where(F.col("value").isNotNull()).withColumn("variable", F.concat(F.lit("diff_"), F.col("variable")))


def lonlat_lookup(cells: DataFrame) -> DataFrame:
    """Longitude and latitude for each distinct (x, y), in metres of the projection."""
    lon, lat = lonlat_of_laea(F.col("x"), F.col("y"))
    return cells.select("x", "y").distinct().select("x", "y", lon.alias("lon"), lat.alias("lat"))


def time_slices(rows: DataFrame, samples: DataFrame, spans: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows of the steps that each sample (``config, t0``) reads: from ``before`` steps ahead of t0 to ``after`` steps past it, both included.

    ``spans`` has ``before, after`` for each config. ``step`` and ``t0`` are whole numbers. Each step names the samples that may read it, so that
    the join is one of equality and the work follows the slices.
    """
    offsets = F.array(*(F.struct(F.lit(c).alias("config"), F.lit(k).alias("k")) for c, (before, after) in spans.items() for k in range(-after, before + 1)))
    asked = rows.withColumn("o", F.explode(offsets)).withColumns({"config": F.col("o.config"), "t0": F.col("step") + F.col("o.k")}).drop("o")
    return asked.join(samples, ["config", "t0"])


def patches(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One array for each key and step, of the values of a window's cells in (y, x) order."""
    rows = F.array_sort(F.collect_list(F.struct("y", "x", "value")))
    return cells.groupBy(*keys, "step").agg(F.transform(rows, lambda r: r["value"]).alias("patch"))


def assemble_features(steps: DataFrame, keys: list[str]) -> DataFrame:
    """One array for each key, of its patches' values in the order of steps.

    Keys must name one sample, such as (config, t0, place, variable): an array is as long as its sample.
    """
    rows = F.array_sort(F.collect_list(F.struct("step", "patch")))
    return steps.groupBy(*keys).agg(F.flatten(F.transform(rows, lambda r: r["patch"])).alias("values"))


def sample_features(
    grid: DataFrame, samples: DataFrame, spans: dict[str, tuple[int, int]], locations: DataFrame, constants: DataFrame, window: tuple[int, int],
    accumulated: list[int] | None = None, tile: int = 4,
) -> DataFrame:
    """Features ``config, t0, loc_y, loc_x, variable, values``: the slice of time, cropped, differenced and normalised.

    ``grid`` has ``variable, step, y, x, value``; ``samples`` ``config, t0``; ``spans`` how many steps a config reads before and
    after t0; ``window`` is the height and width around each place of ``locations``. Accumulated variables become the
    next step's value less this one's before the slice, so their last step is absent.

    Features belong to an input configuration and a place, and are made once for all models and locations that share
    them (see ``features_of``). The grid is read once: cells outside all windows go before anything is worked out, and cells are gathered
    into patches before the slices overlap, so that a step is copied for each t0 as one row.
    """
    places = locations.select("loc_y", "loc_x").distinct().withColumn("location_id", F.struct("loc_y", "loc_x"))
    y0, x0 = F.col("loc_y") - window[0] // 2, F.col("loc_x") - window[1] // 2
    used = places.select(F.explode(F.sequence(y0, y0 + window[0] - 1)).alias("y"), "loc_x").distinct().select("y", F.explode(F.sequence(x0, x0 + window[1] - 1)).alias("x")).distinct()
    rows = grid.join(small(used), ["y", "x"], "left_semi")
    if accumulated:
        ahead = F.lead("value").over(Window.partitionBy("variable", "y", "x").orderBy("step"))
        value = F.when(F.col("variable").isin(accumulated), ahead - F.col("value")).otherwise(F.col("value"))
        rows = rows.withColumn("value", value).where(F.col("value").isNotNull())
    near = window_cells(normalise(rows, constants), places, *window, tile)
    done = assemble_features(time_slices(patches(near, ["location_id", "variable"]), samples, spans), ["config", "t0", "location_id", "variable"])
    return done.select("config", "t0", "location_id.loc_y", "location_id.loc_x", "variable", "values")


def features_of(features: DataFrame, models: DataFrame, locations: DataFrame) -> DataFrame:
    """``sample_features``, or what was made of them, for each model (``model, config``) and location that has them: ``model, t0, location_id, variable`` and
    all columns beside the keys. What depends on the values alone should be made before, once for all models and locations.

    A task's rows come out by place and by run of its locations (``RUN``), then by sample: runs of equal values and a short list of locations
    that repeats, which columns of a file store in little space.
    """
    # A row becomes one for each model and location: tasks of as many bytes as others would make far more rows, so rows are dealt evenly first.
    dealt = features.repartition(TASKS_PER_CORE * features.sparkSession.sparkContext.defaultParallelism, "config", "t0", "loc_y", "loc_x", "variable")
    place, number = ["loc_y", "loc_x"], F.row_number().over(Window.partitionBy("loc_y", "loc_x").orderBy("location_id")) - 1
    runs = locations.groupBy(*place).agg(F.floor((F.count("*") - 1) / RUN).cast("int").alias("last"))
    listed = locations.select("location_id", *place, F.floor(number / RUN).cast("int").alias("run"))
    of_config = models.groupBy("config").agg(F.collect_list(F.struct("model")).alias("models"))
    asked = dealt.join(small(of_config), "config").join(small(runs), place).withColumn("run", F.explode(F.sequence(F.lit(0), "last")))
    # Models are exploded after the sort: right below a join, Spark would leave the sort out.
    ordered = asked.sortWithinPartitions(*place, "run", "config", "variable", "t0").withColumn("model", F.explode("models.model"))
    named = ordered.join(small(listed, MOST_WEIGHTS), [*place, "run"])
    return named.select("model", "t0", "location_id", "variable", *(c for c in features.columns if c not in ("config", "t0", "loc_y", "loc_x", "variable")))


def prepare_nwp(
    grid: DataFrame, names: DataFrame, targets: DataFrame | None, height: int, width: int, half: bool = True, projected: bool = False,
    of: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One provider's frames, checked and made ready: frames with NaN go, variables are renamed, cells are regridded to
    targets, values are rounded to half precision, each after the other; ``of`` is what to make of a regridded value before that.

    ``grid`` has ``provider, frame, variable, y, x, value``. Where ``projected``, y and x are metres, and targets have ``lon`` and ``lat``, which
    are projected and looked up on the grid's axes; without targets each cell gets its own ``lon`` and ``lat``. Else targets
    have ``ty, tx`` in cells. Returns the keys and the value, and ``lon, lat`` where ``projected``. To be saved by
    ``store.write_grid``.
    """
    bad = has_nan(grid, ["provider", "frame"]).where("has_nan").select("provider", "frame")
    rows = rename_variables(grid.join(bad, ["provider", "frame"], "left_anti"), names)
    keys = ["provider", "frame", "variable"]
    own = of or (lambda v: v)
    made = (lambda v: to_float16(own(v))) if half else own
    if projected and targets is not None:
        x, y = laea_of_lonlat(F.col("lon"), F.col("lat"))
        at = small(targets.select("target_id", "lon", "lat"), MOST_WEIGHTS)
        rows = regrid_by_coordinates(rows, targets.select("target_id", y.alias("y"), x.alias("x")), "y", "x", keys, of=made).join(at, "target_id")
        half = False
    elif projected:
        # The places of the cells are those of any frame: the keys' own columns are all that is read of the grid.
        rows = rows.join(small(lonlat_lookup(grid), MOST_WEIGHTS), ["x", "y"])
    elif targets is not None:
        rows, half = regrid_unless_same(rows, targets, height, width, keys, made), False
    return half_precision(rows) if half else rows
