"""Structured Streaming forms: frame quality, late frames, source freshness, validated forecasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from helioflow.functions.columns import epoch_minutes
from helioflow.functions.tables import small
from helioflow.sources.store import utc_date, write_forecast


def frame_quality(cells: DataFrame, lateness: str = "3 hours") -> DataFrame:
    """Share of zero cells by source and 5-minute frame; a frame is final when the watermark has passed it."""
    seen = cells.withWatermark("time", lateness)
    shares = seen.groupBy(F.window("time", "5 minutes"), "source").agg(F.count("*").alias("n_cells"), F.count_if(F.col("value") == 0).alias("n_zero"))
    return shares.select(F.col("window.start").alias("frame"), "source", "n_cells", "n_zero")


class _LateFrames(StatefulProcessor):
    """The newest time of a source and the frame that is waited for, with a timer at which that one counts as absent."""

    def __init__(self, step: int, limit: int) -> None:
        self.step, self.limit = step * 60_000, limit * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getValueState("times", "newest long, next long")

    def _given(self, key: Any, watermark: int) -> pd.DataFrame:
        """The frames that are late by now; a watermark that jumps passes several at once."""
        times = []
        if self.times.exists():
            newest, at = self.times.get()
            while at + self.limit <= watermark and at <= newest + self.limit:
                times.append(at)
                at += self.step
            if times:
                self._wait(newest, at)
        return pd.DataFrame({"source": pd.Series([key[0]] * len(times), dtype=object), "ms": pd.Series(times, dtype="int64")})

    def _wait(self, newest: int, at: int) -> None:
        """Wait for the frame at ``at`` instead of any other, if there is still one to be given."""
        self.times.update((newest, at))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at <= newest + self.limit:
            self.handle.registerTimer(at + self.limit)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        late = self._given(key, timerValues.getCurrentWatermarkInMs())
        seen = max(int(part["ms"].max()) for part in rows)
        if not self.times.exists() or seen > self.times.get()[0]:
            self._wait(seen, seen + self.step)
        yield late

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._given(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def late_frames(frames: DataFrame, step: int = 5, limit: int = 180, delay: str = "0 seconds") -> DataFrame:
    """NaN frames of sources whose frames stay away: ``source, time, is_nan``, for a stream ``frames`` of ``source, time``.

    A frame is expected ``step`` minutes after the newest one of its source. When the stream's watermark is ``limit`` minutes past
    it, it is given as NaN, and the one after is waited for, up to ``limit`` minutes after the newest. A newer frame
    takes the timer away. Once no more frames come this is what the batch operator ``extension_times`` appends. State is
    one time and one timer for each source. It needs the RocksDB state store.
    """
    processor = _LateFrames(step, limit)
    # Times go through Python as milliseconds, which no time zone changes.
    kept = frames.withWatermark("time", delay).withColumn("ms", F.unix_millis("time"))
    found = kept.groupBy("source").transformWithStateInPandas(processor, "source string, ms long", "append", "EventTime")
    return found.select("source", F.timestamp_millis("ms").alias("time"), F.lit(True).alias("is_nan"))


def source_freshness(cells: DataFrame, t0: Column | None = None) -> DataFrame:
    """The newest time of each source, one small state row for each; with ``t0`` the delay in minutes against it, at each update."""
    newest = cells.groupBy("source").agg(F.max("time").alias("newest"))
    return newest if t0 is None else newest.withColumn("delay_minutes", epoch_minutes(t0) - epoch_minutes(F.col("newest")))


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """Of all verdicts kept by ``validated_writer`` the last of each run."""
    own = [c for c in verdicts.columns if c not in ("model", "init_time", "batch_id")]
    last = verdicts.groupBy("model", "init_time").agg(F.max_by(F.struct(*own), "batch_id").alias("v"))
    return last.select("model", "init_time", "v.*")


def validated_writer(validate: Callable[[DataFrame], DataFrame], path: str, forecasts: str | None = None, metadata: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: judge the runs that a micro-batch of national forecasts touches, on all their rows so far.

    Rows are kept under ``path``/rows, so that a run that comes in several micro-batches is judged as a whole. A batch's
    verdicts are kept under ``path``/verdicts (see ``latest_verdicts``). With ``forecasts``, runs that are valid now are
    published in that store, and runs that are not lose what was published of them. A replayed batch replaces its own rows and
    verdicts and publishes the same. Only dates of the batch's runs are read back.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        replace = lambda rows, keys, name: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/{name}")
        dated = batch.withColumns({"init_date": utc_date(F.col("init_time")), "batch_id": F.lit(batch_id)})
        replace(dated.repartition("init_date"), ["init_date", "batch_id"], "rows")
        kept = spark.read.schema(dated.schema).parquet(f"{path}/rows")
        runs = kept.where(F.col("batch_id") == batch_id).select("init_date", "model", "init_time").distinct()
        # A replay judges what was there at its own time: later batches' rows don't count.
        rows = kept.where(F.col("batch_id") <= batch_id).join(small(runs), ["init_date", "model", "init_time"], "left_semi").select(*batch.columns)
        replace(validate(rows).withColumn("batch_id", F.lit(batch_id)).coalesce(1), ["batch_id"], "verdicts")
        if forecasts is not None:
            judged = spark.read.parquet(f"{path}/verdicts")
            touched = judged.where(F.col("batch_id") >= batch_id).join(small(runs.select("model", "init_time")), ["model", "init_time"], "left_semi")
            last = latest_verdicts(touched).select("model", "init_time", "valid")
            # After a replay of an old batch the last verdict still decides, on the rows that it was about.
            latest = kept.join(small(runs), ["init_date", "model", "init_time"], "left_semi").select(*batch.columns)
            placed = latest if "location_id" in latest.columns else latest.withColumn("location_id", F.lit(0).cast("long"))
            good = placed.join(small(last.where("valid").select("model", "init_time")), ["model", "init_time"], "left_semi")
            write_forecast(good, forecasts, metadata, retracted=last.where("not valid"))

    return write


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there, to Parquet."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
