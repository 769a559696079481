"""Tables on disk, capacities, and the forecast store."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helioflow.functions.columns import epoch_minutes, plus_minutes
from helioflow.functions.tables import require_none, small

#: Tile edge in cells, frames of a chunk (0: all of a day), and minutes between frames, of stored grids.
LAYOUTS = {"satellite": (100, 6, 5), "ukv": (100, 10, 60), "ecmwf": (50, 10, 60), "cloudcasting": (100, 0, 15)}
BACKUP_SCHEMA = "gsp_id int, capacity_mwp double"
_FRAME = "struct<time: timestamp, y0: int, x0: int, h: int, w: int, places: array<int>, values: array<double>>"
CHUNK_SCHEMA = f"span long, variable string, tile_y int, tile_x int, frames array<{_FRAME}>, provider string, date date"
_DAY = ["provider", "date"]
_TILE = [*_DAY, "span", "variable", "tile_y", "tile_x"]


def utc_date(ts: Column) -> Column:
    """The date in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(epoch_minutes(ts) / 1440).cast("int"))


def to_chunks(grid: DataFrame, layout: str) -> DataFrame:
    """Rows of cells (``provider, time, variable, y, x, value``) as tiles: a row is a tile of one variable over a few frames.

    A frame's values are one array in the order of (y, x) over the box ``y0, x0, h, w`` that it fills; if cells of
    that box are absent, ``places`` says where the values are. A tile has 100 x 100 cells at most.
    """
    tile, frames, step = LAYOUTS[layout]
    minutes = frames * step or 1440
    at = F.floor(epoch_minutes(F.col("time")) / minutes)
    placed = grid.select(
        "provider", utc_date(F.col("time")).alias("date"), at.alias("span"), F.col("variable").cast("string").alias("variable"), (F.floor(F.col("y") / tile)).cast("int").alias("tile_y"),
        (F.floor(F.col("x") / tile)).cast("int").alias("tile_x"), "time", F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("value").cast("double").alias("value"),
    )
    size = lambda c: (F.max(c) - F.min(c) + 1).alias("h" if c == "y" else "w")
    boxed = placed.groupBy(*_TILE, "time").agg(F.min("y").alias("y0"), F.min("x").alias("x0"), size("y"), size("x"), F.array_sort(F.collect_list(F.struct("y", "x", "value"))).alias("cells"))
    places = F.transform("cells", lambda c: (c["y"] - F.col("y0")) * F.col("w") + c["x"] - F.col("x0"))
    full = F.col("places") == F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)
    framed = boxed.withColumn("places", places).select(*_TILE, F.struct("time", "y0", "x0", "h", "w", F.when(~full, F.col("places")).alias("places"), F.transform("cells", lambda c: c["value"]).alias("values")).alias("frame"))
    return framed.groupBy(*_TILE).agg(F.array_sort(F.collect_list("frame")).alias("frames"))


def write_grid(grid: DataFrame, path: str, layout: str, parts: int | None = None) -> None:
    """Replace what is stored of the grid's frames (provider and time); other frames stay.

    A provider's UTC date is a folder of chunks. A late frame takes its place in its chunk: the chunks of the dates that
    the grid touches are read, lose the grid's frames, gain the new ones and replace their folders.
    """
    spark, new = grid.sparkSession, to_chunks(grid, layout)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        times = grid.select("provider", utc_date(F.col("time")).alias("date"), "time").distinct()
        gone = times.groupBy(*_DAY).agg(F.collect_list("time").alias("gone"))
        old = spark.read.schema(CHUNK_SCHEMA).parquet(path).join(gone, _DAY)
        left = old.withColumn("frames", F.filter("frames", lambda f: ~F.array_contains(F.col("gone"), f["time"]))).where(F.size("frames") > 0)
        both = left.select(*new.columns).unionByName(new).groupBy(*_TILE).agg(F.flatten(F.collect_list("frames")).alias("frames"))
        new = both.withColumn("frames", F.array_sort("frames"))
    dealt = new.repartition(parts, *_DAY, "span") if parts else new.repartition(*_DAY)
    dealt.sortWithinPartitions(*_TILE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_DAY).parquet(path)


def _folders(spark: SparkSession, path: str, provider: str | None, start: datetime | None, stop: datetime | None) -> list[str]:
    """The stored date folders of a provider in a span of time: only their parents are listed."""
    names = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/provider={provider or '*'}/date=*")
    found = [str(x.getPath()) for x in names.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(names)]
    day = lambda at: (at if at.tzinfo is None else at.astimezone(timezone.utc)).strftime("%Y-%m-%d")
    dates = {x: x.rsplit("date=", 1)[1] for x in found}
    return [x for x in found if (start is None or dates[x] >= day(start)) and (stop is None or dates[x] <= day(stop))]


def read_chunks(spark: SparkSession, path: str, provider: str | None = None, start: datetime | None = None, stop: datetime | None = None) -> DataFrame:
    """Stored chunks of a provider, with their frames from ``start`` to ``stop`` (UTC, if they name no zone), ends included.

    Dates are folders that are not listed if they aren't asked for; frames are cut out of the chunks.
    """
    reader = spark.read.schema(CHUNK_SCHEMA).option("basePath", path)
    folders = _folders(spark, path, provider, start, stop) if start or stop or provider else [path]
    chunks = reader.parquet(*folders) if folders else spark.createDataFrame([], CHUNK_SCHEMA)
    for bound, after in ((start, True), (stop, False)):
        if bound is not None:
            aware = bound if bound.tzinfo else bound.replace(tzinfo=timezone.utc)
            at = F.timestamp_micros(F.lit((aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)))
            chunks = chunks.withColumn("frames", F.filter("frames", lambda f: f["time"] >= at if after else f["time"] <= at))  # noqa: B023
    return chunks.where(F.size("frames") > 0) if start or stop else chunks


def crop(chunks: DataFrame, y: tuple[int, int], x: tuple[int, int]) -> DataFrame:
    """Chunks cut to the cells from ``y[0]`` to ``y[1]`` and ``x[0]`` to ``x[1]``, ends included, by slices of their arrays."""

    def cut(f: Column) -> Column:
        top, left = F.greatest(f["y0"], F.lit(y[0])), F.greatest(f["x0"], F.lit(x[0]))
        h = F.least(f["y0"] + f["h"], F.lit(y[1] + 1)) - top
        w = F.least(f["x0"] + f["w"], F.lit(x[1] + 1)) - left
        rows = F.when((h > 0) & (w > 0), F.sequence(top - f["y0"], top - f["y0"] + F.greatest(h, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
        whole = F.flatten(F.transform(rows, lambda r: F.slice(f["values"], r * f["w"] + left - f["x0"] + 1, F.greatest(w, F.lit(0)))))
        inside = lambda p: F.floor(p / f["w"]).between(top - f["y0"], top - f["y0"] + h - 1) & (p % f["w"]).between(left - f["x0"], left - f["x0"] + w - 1)
        some = F.filter(F.arrays_zip(f["places"].alias("p"), f["values"].alias("v")), lambda z: inside(z["p"]))
        moved = F.transform(some, lambda z: ((F.floor(z["p"] / f["w"]) - (top - f["y0"])) * w + z["p"] % f["w"] - (left - f["x0"])).cast("int"))
        dense = f["places"].isNull()
        return F.struct(
            f["time"].alias("time"), top.alias("y0"), left.alias("x0"), h.alias("h"), w.alias("w"), F.when(~dense, moved).alias("places"), F.when(dense, whole).otherwise(F.transform(some, lambda z: z["v"])).alias("values")
        )

    cropped = chunks.withColumn("frames", F.filter(F.transform("frames", cut), lambda f: F.size(f["values"]) > 0))
    return cropped.where(F.size("frames") > 0)


def cells_of(chunks: DataFrame) -> DataFrame:
    """Chunks as rows of cells: ``provider, time, variable, y, x, value, tile_y, tile_x``."""
    frames = chunks.select("provider", "variable", "tile_y", "tile_x", F.explode("frames").alias("f"))
    each = frames.select("*", F.posexplode("f.values").alias("i", "value")).withColumn("p", F.coalesce(F.get("f.places", F.col("i")), F.col("i")))
    y, x = (F.col("f.y0") + F.floor(F.col("p") / F.col("f.w"))).cast("long"), (F.col("f.x0") + F.col("p") % F.col("f.w")).cast("long")
    return each.select("provider", F.col("f.time").alias("time"), "variable", y.alias("y"), x.alias("x"), "value", "tile_y", "tile_x")


def read_grid(
    spark: SparkSession, path: str, provider: str | None = None, start: datetime | None = None, stop: datetime | None = None,
    tile_y: tuple[int, int] | None = None, tile_x: tuple[int, int] | None = None, box: tuple[tuple[int, int], tuple[int, int]] | None = None, layout: str | None = None,
) -> DataFrame:
    """A stored grid as cells, or a provider's frames from ``start`` to ``stop``, tiles in ranges, and a box of (y, x); ends included.

    Providers and days are folders that are not listed into the scan; tiles are pushed to it, a box's tiles too if the layout is
    named; a box is cut out of the arrays.
    """
    chunks = read_chunks(spark, path, provider, start, stop)
    spans = [("tile_y", tile_y), ("tile_x", tile_x)]
    if box and layout:
        spans += [(name, tuple(v // LAYOUTS[layout][0] for v in side)) for name, side in zip(("tile_y", "tile_x"), box, strict=True)]
    for name, span in spans:
        if span is not None:
            chunks = chunks.where(F.col(name).between(*span))
    return cells_of(crop(chunks, *box) if box else chunks)


def demanded_chunks(spark: SparkSession, path: str, model_inputs: DataFrame, locations: DataFrame, window: tuple[int, int], layout: str) -> DataFrame:
    """Stored chunks that some model needs (``provider`` of ``model_inputs``), of tiles that the locations' windows touch.

    Providers reach the scan as dynamic partition filters, so that other sources' files aren't listed into it; the box of all
    windows reaches it as scalar filters on the tiles.
    """
    edge = LAYOUTS[layout][0]
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    for axis, size in zip("yx", window, strict=True):
        low = F.col(f"loc_{axis}") - size // 2
        ends = locations.agg(F.floor(F.min(low) / edge).cast("int").alias("first"), F.floor(F.max(low + size - 1) / edge).cast("int").alias("last"))
        chunks = chunks.where((F.col(f"tile_{axis}") >= ends.select("first").scalar()) & (F.col(f"tile_{axis}") <= ends.select("last").scalar()))
    return chunks.join(small(model_inputs.select("provider").distinct()), "provider", "left_semi")


def stored_times(spark: SparkSession, path: str) -> DataFrame:
    """``provider, time`` of the stored frames: of the chunks only their frames' times are read, a row for each tile, none for cells."""
    return spark.read.schema(CHUNK_SCHEMA).parquet(path).select("provider", F.explode("frames.time").alias("time")).distinct()


def file_times(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``key, modified``: when the newest file of each value of a folder's key changed, from the files' metadata alone."""
    files = spark.read.parquet(path).select(key, F.col("_metadata.file_modification_time").alias("modified"))
    return files.groupBy(key).agg(F.max("modified").alias("modified"))


def read_backup_capacities(spark: SparkSession, path: str) -> DataFrame:
    """CSV with quoted numbers, read by a fixed schema."""
    return spark.read.schema(BACKUP_SCHEMA).option("header", True).csv(path)


def read_locations(regions: DataFrame, nations: DataFrame) -> DataFrame:
    """Both kinds of location that carry a ``gsp_id``, with watts as megawatts."""
    both = regions.unionByName(nations).where(F.map_contains_key("metadata", "gsp_id"))
    return both.select("location_uuid", F.element_at("metadata", "gsp_id").cast("int").alias("location_id"), (F.col("effective_capacity_watts") / 1e6).alias("capacity"))


def capacities_with_backup(requested: DataFrame, live: DataFrame, backup: DataFrame) -> DataFrame:
    """Capacities of the requested ids and the nation, by run.

    If any is missing or NaN, all of that run come from the backup. ``source`` says which; a
    capacity that the backup lacks too is null (see ``unresolved``).
    """
    nation = requested.select("run_id").distinct().withColumn("location_id", F.lit(0).cast("long"))
    ids = requested.select("run_id", "location_id").unionByName(nation).distinct()
    joined = ids.join(live.select("location_id", F.col("capacity").alias("live")), "location_id", "left")
    good = F.bool_and(F.col("live").isNotNull() & ~F.isnan(F.coalesce("live", F.lit(0.0)))).over(Window.partitionBy("run_id"))
    both = joined.withColumn("good", good).join(backup.select("location_id", F.col("capacity").alias("backup")), "location_id", "left")
    return both.select(
        "run_id", "location_id", F.when(F.col("good"), F.col("live")).otherwise(F.col("backup")).alias("capacity"), F.when(F.col("good"), "live").otherwise("backup").alias("source")
    )


def unresolved(rows: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Rows whose key can't be resolved."""
    return rows.join(known, on, "left_anti")


def with_uuid(rows: DataFrame, uuids: DataFrame) -> DataFrame:
    """Rows with their location's uuid; fails, naming them, if some locations have none."""
    require_none(unresolved(rows, uuids, "location_id").select("location_id").distinct(), "locations without uuid")
    return rows.join(uuids, "location_id")


def location_uuid_map(locations: DataFrame) -> DataFrame:
    """The last row of an id wins, by ``load_order``."""
    return locations.groupBy("location_id").agg(F.max_by("location_uuid", "load_order").alias("location_uuid"))


RUN = ["init_date", "model", "init"]


def write_runs(rows: DataFrame, path: str) -> None:
    """Replace whole runs, one of each model and init time: writing twice leaves the same rows, and runs of other init times stay.

    Folders are named by the UTC date and the microseconds of the init time, so no time zone makes two runs one.
    """
    dated = rows.withColumns({"init_date": utc_date(F.col("init_time")), "init": F.unix_micros("init_time")})
    dated.repartition(*RUN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).parquet(path)


def write_forecast(forecast: DataFrame, path: str, metadata: DataFrame | None = None, retracted: DataFrame | None = None) -> None:
    """Publish runs: a row for each (model, location, init time), with the list of its values and its metadata.

    ``forecast`` has ``model, init_time, location_id, target_time`` and any other columns, which are a value's own.
    ``metadata`` has ``name, at`` (see ``run_metadata``) and comes along with each forecast. A run that is published again
    replaces its earlier rows; runs ``retracted`` (``model, init_time``) lose theirs: a mark without values takes their place, which
    ``read_forecast`` leaves out. Both can be repeated without any other effect.
    """
    keys = ["model", "init_time", "location_id"]
    value = F.struct("target_time", *(c for c in forecast.columns if c not in [*keys, "target_time"]))
    packed = forecast.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("values"))
    notes = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")))))
    if metadata is not None:
        packed = packed.crossJoin(F.broadcast(metadata.agg(notes.alias("metadata"))))
    else:
        packed = packed.withColumn("metadata", F.lit(None).cast("map<string,string>"))
    packed = packed.withColumn("retracted", F.lit(False))
    if retracted is not None:
        marks = retracted.select("model", "init_time", F.lit(None).cast(forecast.schema["location_id"].dataType).alias("location_id"), F.lit(True).alias("retracted"))
        packed = packed.unionByName(marks.distinct(), allowMissingColumns=True)
    write_runs(packed, path)


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    """Published values: ``model, init_time, location_id``, a value's columns, and ``metadata``; retracted runs have none."""
    stored = spark.read.parquet(path).where(~F.col("retracted"))
    return stored.select("model", "init_time", "location_id", F.explode("values").alias("v"), "metadata").select("model", "init_time", "location_id", "v.*", "metadata")


def write_snapshot(features: DataFrame, path: str, model_order: str) -> None:
    """Keep the first model's features as the latest snapshot."""
    first = features.agg(F.min_by("model", model_order).alias("model"))
    features.join(F.broadcast(first), "model", "left_semi").write.mode("overwrite").parquet(path)


def register_forecasters(registry: DataFrame, wanted: DataFrame) -> DataFrame:
    """The next registry: names with ``-`` as ``_``; present ones get the new version, others are added."""
    new = wanted.select(F.translate("name", "-", "_").alias("name"), F.col("version").alias("new")).dropDuplicates(["name"])
    joined = registry.join(new, "name", "full_outer")
    action = F.when(F.col("version").isNull(), "insert").when(F.col("new").isNull() | (F.col("new") == F.col("version")), "keep").otherwise("update")
    return joined.select("name", F.coalesce("new", "version").alias("version"), action.alias("action"))


def run_metadata(observations: DataFrame, modified: DataFrame) -> DataFrame:
    """Name and time of the newest observation and of each source's last change; missing ones are skipped."""
    newest = observations.groupBy("location_id").agg(F.max("timestamp_utc").alias("at")).select(F.concat(F.lit("observed_"), "location_id").alias("name"), "at")
    changed = modified.groupBy("provider").agg(F.max("modified").alias("at")).select(F.concat(F.lit("modified_"), "provider").alias("name"), "at")
    return newest.unionByName(changed).where(F.col("at").isNotNull())


def latest_forecasts(forecast: DataFrame) -> DataFrame:
    """All values of the newest init of each location and model."""
    keys = ["location_id", "model"]
    newest = forecast.groupBy(*keys).agg(F.max("init_time").alias("init_time"))
    return forecast.join(newest, [*keys, "init_time"], "left_semi")


def forecast_at(forecast: DataFrame, ts: Column) -> DataFrame:
    """The value at one time for each location and model, from the latest init that covers it."""
    return forecast.where(F.col("target_time") == ts).groupBy("location_id", "model").agg(F.max_by("mw", "init_time").alias("mw"), F.max("init_time").alias("init_time"))


def forecast_timeseries(values: DataFrame, model: str, init: Column, start: Column, stop: Column) -> DataFrame:
    target = plus_minutes(F.col("init_time"), F.col("horizon_mins"))
    return values.where((F.col("model") == model) & (F.col("init_time") == init)).withColumn("target_time", target).where(F.col("target_time").between(start, stop))


def latest_observation(observations: DataFrame) -> DataFrame:
    return observations.groupBy("location_id").agg(F.max("timestamp_utc").alias("timestamp_utc"), F.max_by("value", F.struct("timestamp_utc", "value")).alias("value"))


def incomplete_models(required: DataFrame, done: DataFrame) -> DataFrame:
    """Required (init_time, model) without a finished run."""
    return required.join(done, ["init_time", "model"], "left_anti")


def check_models_finished(models: DataFrame, done: DataFrame, every: bool = False) -> DataFrame:
    """For each init: the missing critical models, and all missing ones, as sorted arrays.

    ``models`` has ``init_time, model, is_critical``. It fails if a critical model is missing, or any with ``every``.
    """
    missing = incomplete_models(models, done)
    require_none((missing if every else missing.where("is_critical")).select("init_time", "model"), "models without a finished run")
    return missing_models(models, done)


def missing_models(models: DataFrame, done: DataFrame) -> DataFrame:
    """As ``check_models_finished``, without failing."""
    missing = models.join(done.select("init_time", "model", F.lit(True).alias("done")).distinct(), ["init_time", "model"], "left").withColumn("gone", F.col("done").isNull())
    lists = [F.array_sort(F.collect_set(F.when(hit, F.col("model")))).alias(name) for name, hit in (("missing_critical", F.col("gone") & F.col("is_critical")), ("missing", F.col("gone")))]
    return missing.groupBy("init_time").agg(*lists)


def coverage(expected: DataFrame, forecast: DataFrame, keys: list[str]) -> DataFrame:
    """For each (model, init_time): rows expected and missing."""
    have = forecast.select(*keys).distinct().withColumn("have", F.lit(1))
    joined = expected.join(have, keys, "left")
    return joined.groupBy("model", "init_time").agg(F.count("*").alias("n_expected"), (F.count("*") - F.count("have")).alias("n_missing"))


def coverage_of(runs: DataFrame, places: DataFrame, forecast: DataFrame, horizons: dict[str, int], levels: dict[str, list[str]], step: int = 30) -> DataFrame:
    """For each run (``model, init_time, kind``): values expected and missing, as ``coverage`` of ``expected_values``, by counting.

    What is expected is a product of numbers; of ``forecast`` (``model, init_time, location_id, target_time, level``) the distinct rows that
    are expected are counted. Which ones are missing can be asked of ``expected_values`` for the runs that lack some.
    """
    known = places.select("location_id").distinct()
    n = known.agg(F.count_if(F.col("location_id") != 0).alias("n"), F.count_if(F.col("location_id") == 0).alias("nation"))
    ahead = F.create_map(*(F.lit(x) for kind, k in horizons.items() for x in (kind, k)))[F.col("kind")]
    counted = runs.select("model", "init_time", ahead.alias("ahead")).crossJoin(F.broadcast(n))  # one row
    expected = counted.select("model", "init_time", "ahead", (F.col("ahead") * (F.col("n") * len(levels["location"]) + F.col("nation") * len(levels["nation"]))).alias("n_expected"))
    horizon = epoch_minutes(F.col("target_time")) - epoch_minutes(F.col("init_time"))
    asked = F.when(F.col("location_id") == 0, F.col("level").isin(levels["nation"])).otherwise(F.col("level").isin(levels["location"]))
    own = forecast.where(asked & (F.unix_micros("target_time") - F.unix_micros("init_time") == horizon * 60_000_000) & (horizon % step == 0)).join(known, "location_id", "left_semi")
    met = own.join(small(expected.select("model", "init_time", "ahead")), ["model", "init_time"]).where(horizon.between(step, F.col("ahead") * step))
    have = met.select("model", "init_time", "location_id", "target_time", "level").distinct().groupBy("model", "init_time").agg(F.count("*").alias("have"))
    return expected.join(have, ["model", "init_time"], "left").select("model", "init_time", "n_expected", (F.col("n_expected") - F.coalesce("have", F.lit(0))).alias("n_missing"))


def expected_values(runs: DataFrame, locations: DataFrame, horizons: dict[str, int], levels: dict[str, list[str]], step: int = 30) -> DataFrame:
    """Every value that a run must have: ``model, init_time, location_id, target_time, level``.

    ``runs`` has ``model, init_time, kind``; ``horizons``: the number of steps of each kind of model;
    ``levels``: those of the nation (``"nation"``, location 0) and of other places (``"location"``).
    """
    ahead = F.create_map(*(F.lit(x) for kind, n in horizons.items() for x in (kind, n)))
    steps = F.sequence(F.lit(1), ahead[F.col("kind")])
    targets = runs.select("model", "init_time", F.explode(F.transform(steps, lambda k: plus_minutes(F.col("init_time"), k * step))).alias("target_time"))
    own = F.when(F.col("location_id") == 0, F.lit(levels["nation"])).otherwise(F.lit(levels["location"]))
    each = locations.select("location_id").distinct().select("location_id", F.explode(own).alias("level"))
    return targets.crossJoin(small(each))
