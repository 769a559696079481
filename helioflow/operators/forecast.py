"""From raw scores to regional and national forecasts, in long form:
(model, init_time, location_id, target_time, output_label, value)."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helioflow.functions.columns import epoch_minutes, is_number
from helioflow.functions.tables import require_none

NATION = 0
MIN_DAY_ELEVATION = 0.0
NATION_LEVELS = ["p02", "p10", "p25", "p75", "p90", "p98"]
LOCATION_LEVELS = ["p10", "p90"]
LEVEL_LIMIT = 1.09
KEYS = ["model", "init_time", "target_time", "output_label"]


def label_of(quantile: Column) -> Column:
    """0.5 is the forecast itself; other levels are named by their truncated percentage."""
    return F.when(quantile == 0.5, F.lit("forecast_mw")).otherwise(
        F.concat(F.lit("forecast_mw_plevel_"), F.lpad((quantile * 100).cast("int").cast("string"), 2, "0"))
    )


def quantile_labels(scores: DataFrame, quantiles: list[float]) -> DataFrame:
    """One labelled row for each quantile of the ``scores`` array."""
    if quantiles and 0.5 not in quantiles:
        raise ValueError("the quantiles must include 0.5")
    names = F.array(*(label_of(F.lit(float(q))) for q in quantiles)) if quantiles else F.array(F.lit("forecast_mw"))
    rows = scores.select("*", F.posexplode("scores").alias("place", "value")).drop("scores")
    return rows.withColumn("output_label", F.get(names, F.col("place"))).drop("place")


def clip_negative(v: Column) -> Column:
    """Negative values become 0; NaN stays."""
    return F.when(v < 0, 0.0).otherwise(v)


def is_dark(elevation: Column) -> Column:
    return elevation < MIN_DAY_ELEVATION


def mask_sundown(v: Column, dark: Column) -> Column:
    """0 in the dark; null and NaN become 0 as well."""
    return F.when(dark | ~is_number(v), 0.0).otherwise(v)


def unscale_elevation(scaled: Column) -> Column:
    return (scaled - 0.5) * 180


def national_sum(regional: DataFrame) -> DataFrame:
    return regional.groupBy(*KEYS).agg(F.sum("value").alias("value")).withColumn("location_id", F.lit(NATION).cast("long"))


def national_dark(masks: DataFrame) -> DataFrame:
    """The nation is dark where all locations are."""
    return masks.groupBy("model", "init_time", "target_time").agg(F.bool_and("dark").alias("all_dark"))


def weighted_national(regional: DataFrame, weights: DataFrame) -> DataFrame:
    """A linear location-to-nation model: the weighted sum of the locations' values."""
    joined = regional.join(weights, "location_id")
    return joined.groupBy(*KEYS).agg(F.sum(F.col("weight") * F.col("value")).alias("value"))


def score_national(regional: DataFrame, predictor: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Any location-to-nation model, on the regional rows of one (model, init_time) at a time."""
    return regional.groupBy("model", "init_time").applyInPandas(predictor, schema)


def score_model(features: DataFrame, predictor: Callable[[pd.DataFrame], list[list[float]]], width: int) -> DataFrame:
    """Batch inference: ``predictor`` gets a batch of feature rows and returns ``width`` scores for each."""

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            found = predictor(rows)
            if len(found) != len(rows) or any(len(x) != width for x in found):
                raise ValueError("the predictor returned another shape")
            yield rows[["model", "init_time", "location_id"]].assign(scores=found)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in features.select("model", "init_time", "location_id").schema)
    return features.mapInPandas(scored, f"{fields}, scores array<double>")


def _sent(spark: SparkSession, folder: str) -> str:
    """A folder, in whatever store it is in, sent to every executor; its name there, for ``SparkFiles``.

    It goes as an archive of a name of its own: Spark sends no local folder where executors are other processes, and files by their last name only.
    """
    name, jvm, hadoop = f"folder-{uuid.uuid4().hex}", spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    own = os.path.realpath(tempfile.mkdtemp(prefix="helioflow-"))
    local = jvm.org.apache.hadoop.fs.FileSystem.getLocal(hadoop).getRaw()
    jvm.org.apache.hadoop.fs.FileUtil.copy(path.getFileSystem(hadoop), path, local, jvm.org.apache.hadoop.fs.Path(f"{own}/copy"), False, hadoop)
    packed = shutil.make_archive(f"{own}/{name}", "zip", f"{own}/copy")
    shutil.rmtree(f"{own}/copy")
    # The driver serves the archive to executors as long as it runs.
    local.deleteOnExit(jvm.org.apache.hadoop.fs.Path(own))
    spark.sparkContext.addArchive(f"file://{packed}")
    return f"{name}.zip"


def score_features(features: DataFrame, folder: str, load: Callable[[str], Callable[[np.ndarray], np.ndarray]], length: int, width: int, batch: int = 4096) -> DataFrame:
    """Batch inference on assembled features (``values`` beside their keys): ``scores`` of ``width`` for each row of ``length`` values.

    ``folder`` holds the predictor and is copied to every executor, from whatever store it is in; ``load`` gets the local copy's path,
    once for each Python worker, and returns a function of a batch of rows (a matrix) that returns a matrix of scores. Rows
    whose sample isn't complete, of another length or with null or NaN, are left out.
    """
    name = _sent(features.sparkSession, folder)

    def made() -> Callable[[np.ndarray], np.ndarray]:
        predictor = load(SparkFiles.get(name))

        def predict(rows: np.ndarray) -> np.ndarray:
            found = np.asarray(predictor(rows), np.float64)
            if found.shape != (len(rows), width):
                raise ValueError("the predictor returned another shape")
            return found

        return predict

    score = predict_batch_udf(made, return_type=T.ArrayType(T.DoubleType()), batch_size=batch, input_tensor_shapes=[[length]])
    whole = features.where((F.size("values") == length) & F.forall("values", is_number))
    return whole.withColumn("scores", score("values")).drop("values")


def to_absolute(fractions: DataFrame, capacity: DataFrame) -> DataFrame:
    """Fractions of capacity to megawatts, joined by location."""
    return fractions.join(capacity, "location_id").withColumn("value", F.col("value") * F.col("capacity")).drop("capacity")


def fraction_label(label: Column) -> Column:
    return F.replace(label, F.lit("_mw"), F.lit("_fraction"))


def peak_forecast(forecast: DataFrame) -> DataFrame:
    own = forecast.where("output_label = 'forecast_mw'")
    return own.groupBy("model", "init_time", "location_id").agg(F.max("value").alias("peak"))


def forecast_part(axis: Column, n: int) -> Column:
    """The last ``n`` entries of an array over history and forecast: the forecast's own."""
    return F.slice(axis, -n, n)


def postprocess(
    scores: DataFrame, quantiles: list[float], capacity: DataFrame, nation_capacity: float | None = None, nation: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Scores of all locations to megawatts for locations and nation.

    ``scores`` has the keys, ``elevation`` and an array of fractions for each target time. Labels,
    clipping and the sundown mask come first. The nation is the sum of the locations; with ``nation``, a
    model of the locations' raw fractions (``KEYS``, ``location_id``, ``value``, ``relative`` for the share of
    ``nation_capacity``) that returns fractions by ``KEYS``, it is clipped and masked likewise. It is dark
    where all locations are. With ``nation_capacity``, fractions come along under their own labels.
    """
    rows = quantile_labels(scores, quantiles).withColumn("dark", is_dark(F.col("elevation")))
    masked = rows.withColumn("value", mask_sundown(clip_negative(F.col("value")), F.col("dark")))
    regional = to_absolute(masked.withColumn("fraction", F.col("value")), capacity)
    dark = F.bool_and("dark").alias("dark")
    if nation is None:
        total = regional.groupBy(*KEYS).agg(F.sum("value").alias("value"), dark).withColumn("value", mask_sundown(F.col("value"), F.col("dark")))
        total = total.withColumn("fraction", F.col("value") / nation_capacity if nation_capacity else F.lit(None).cast("double"))
    else:
        raw = rows.join(capacity.withColumn("relative", F.col("capacity") / nation_capacity), "location_id")
        predicted = nation(raw.select(*KEYS, "location_id", "value", "relative")).join(rows.groupBy(*KEYS).agg(dark), KEYS)
        total = predicted.withColumn("fraction", mask_sundown(clip_negative(F.col("value")), F.col("dark"))).withColumn("value", F.col("fraction") * nation_capacity)
    names = [*KEYS, "location_id", "value"]
    if nation_capacity:
        names += ["fraction", "fraction_label"]
    both = total.withColumn("location_id", F.lit(NATION).cast("long")).select(*KEYS, "location_id", "value", "fraction").unionByName(
        regional.select(*KEYS, "location_id", "value", "fraction")
    )
    return both.withColumn("fraction_label", fraction_label(F.col("output_label"))).select(*names)


def relative_capacities(capacity: DataFrame, group: str) -> DataFrame:
    """Each location's share of its group's capacity; locations without a capacity are left out."""
    known = capacity.where("capacity is not null")
    total = known.groupBy(group).agg(F.sum(F.col("capacity").cast("decimal(18,2)")).cast("double").alias("total"))
    return known.join(total, group).select("location_id", (F.col("capacity") / F.col("total")).alias("relative"))


def weighted_sum(raw: DataFrame) -> DataFrame:
    """The simplest nation model: the locations' fractions, weighed by their share of the capacity."""
    return raw.groupBy(*KEYS).agg(F.sum(F.col("value") * F.col("relative")).alias("value"))


def horizon_minutes(init: Column, target: Column) -> Column:
    return (epoch_minutes(target) - epoch_minutes(init)).cast("int")


def select_levels(forecast: DataFrame, required: bool = False) -> DataFrame:
    """The forecast and the levels that are saved: more of them for the nation.

    With ``required`` it fails, naming them, if a forecast lacks one of its levels.
    """
    level = F.concat(F.lit("p"), F.substring_index("output_label", "_", -1))
    wanted = F.when(F.col("location_id") == NATION, level.isin(NATION_LEVELS)).otherwise(level.isin(LOCATION_LEVELS))
    kept = forecast.withColumn("level", F.when(F.col("output_label") == "forecast_mw", "p50").otherwise(level)).where((F.col("level") == "p50") | wanted)
    if required:
        all_levels = F.when(F.col("location_id") == NATION, F.lit(["p50", *NATION_LEVELS])).otherwise(F.lit(["p50", *LOCATION_LEVELS]))
        keys = ["model", "init_time", "location_id"]
        missing = kept.groupBy(*keys).agg(F.collect_set("level").alias("have")).select(*keys, F.array_except(all_levels, "have").alias("missing"))
        require_none(missing.where(F.size("missing") > 0), "forecasts without a level")
    return kept


def clamp_levels(levels: Column) -> Column:
    """Levels of the limit or more become the limit; NaN stays."""
    return F.transform_values(levels, lambda _, v: F.when((v >= LEVEL_LIMIT) & ~F.isnan(v), LEVEL_LIMIT).otherwise(v))


def pack_values(levels: DataFrame) -> DataFrame:
    """One row for each target time: horizon, the forecast's fraction, a map of the other levels."""
    pairs = F.collect_list(F.when(F.col("level") != "p50", F.struct("level", "value")))
    packed = levels.groupBy("model", "init_time", "location_id", "target_time").agg(
        F.max(F.when(F.col("level") == "p50", F.col("value"))).alias("p50_fraction"),
        F.map_from_entries(F.array_sort(pairs)).alias("other_statistics"),
    )
    return packed.withColumn("horizon_mins", horizon_minutes(F.col("init_time"), F.col("target_time")))
