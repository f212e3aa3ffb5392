"""Structured Streaming versions of the realtime steps.

Every job takes a streaming DataFrame, an output folder and a checkpoint folder (both on shared
storage) and runs until the available input is used up; a service would pass another trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geocadence.operators.alerts import classify_default
from geocadence.sources.versions import Versions, merge


def file_stream(spark: SparkSession, folder: str, glob: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def _finish(writer, checkpoint: str, path: str | None = None) -> None:
    w = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.start(path) if path else w.start()
    q.awaitTermination()


def _zoned(df: DataFrame, ts: str, zone: str) -> DataFrame:
    """Event time as a zoned timestamp: naive wall-clock time of ``zone``."""
    return df.withColumn("_ts", F.to_utc_timestamp(F.col(ts).cast("timestamp"), zone) if zone != "UTC" else F.col(ts).cast("timestamp"))


# --- R1 ------------------------------------------------------------------------------------------
def hourly_means(stream: DataFrame, late: str, ts: str = "ts", area: str = "area", value: str = "value", zone: str = "UTC") -> DataFrame:
    """Hourly mean per area; an hour is final once the watermark passes its end."""
    return (
        _zoned(stream, ts, zone).withWatermark("_ts", late)
        .groupBy(F.window("_ts", "1 hour").alias("w"), area)
        .agg(F.avg(value).alias("value"), F.count(F.lit(1)).alias("n"))
    )


def run_hourly_means(stream: DataFrame, late: str, path: str, checkpoint: str, **kw) -> None:
    out = hourly_means(stream, late, **kw).select(F.col("w.start").cast("timestamp_ntz").alias("time"), "area", "value", "n")
    _finish(out.writeStream.format("parquet").outputMode("append"), checkpoint, path)


# --- R2 ------------------------------------------------------------------------------------------
def run_sliding_sums(stream: DataFrame, late: str, hours: int | list[int], path: str, checkpoint: str, **kw) -> None:
    """Sums of the hourly means over the last N hours of each width N, where all N hours have one.

    ``hours``: one width (column ``value``) or several (columns ``value_3H``, ...; NULL where a width is not complete, rows without any
    are left out). State: per area a map of the last hours of the widest window, from which all widths are summed, so an hour
    is stored once and its rows are not multiplied. An event timer lets the map of an area go that has been silent for as
    long. The hourly means are final and in order before they reach the state. The session must use ``STATE_STORE``.
    """
    widths = [hours] if isinstance(hours, int) else sorted(set(hours))
    hourly = hourly_means(stream, late, **kw)
    rows = hourly.select("area", F.window_time("w").alias("event_time"), F.col("w.start").alias("start"), "value")
    names = ["value"] if isinstance(hours, int) else [f"value_{w}H" for w in widths]
    sums = rows.groupBy("area").transformWithStateInPandas(
        statefulProcessor=_ring_processor(widths, names), outputStructType="area string, start timestamp, " + ", ".join(f"{n} double" for n in names),
        outputMode="Append", timeMode="EventTime")
    out = sums.select(F.col("start").cast("timestamp_ntz").alias("time"), "area", *names)
    _finish(out.writeStream.format("parquet").outputMode("append"), checkpoint, path)


_HOUR_MS = 3_600_000


def ring_sums(hours: np.ndarray, values: np.ndarray, widths: list[int]) -> list[np.ndarray]:
    """Per width the sum over the last so many hours, NaN unless they follow each other and all have a value; hours ascend."""
    out = [np.full(len(hours), np.nan) for _ in widths]
    has = np.flatnonzero(~np.isnan(values))
    for run in np.split(has, np.flatnonzero(np.diff(hours[has]) != 1) + 1):
        for o, w in zip(out, widths):
            if len(run) >= w:
                o[run[w - 1:]] = np.lib.stride_tricks.sliding_window_view(values[run], w).sum(1)
    return out


def _ring_processor(widths: list[int], names: list[str]):
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class SlidingSums(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.ring = handle.getMapState("hours", "hour long", "value double")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            new = pd.concat(list(rows)).sort_values("start", ignore_index=True)
            held = sorted((k[0], v[0]) for k, v in self.ring.iterator())
            own = (new["start"] - pd.Timestamp(0, tz=new["start"].dt.tz)).dt.total_seconds().round().astype("int64").to_numpy() // 3600
            hours = np.concatenate([np.array([h for h, _ in held], np.int64), own])
            values = np.concatenate([np.array([v for _, v in held], float), new["value"].astype("float64").to_numpy()])
            sums = ring_sums(hours, values, widths)
            oldest = int(hours[-1]) - max(widths) + 2  # what the next hour can still reach
            for h, _ in held:
                if h < oldest:
                    self.ring.removeKey((h,))
            for h, v in zip(own.tolist(), values[len(held):].tolist()):
                if h >= oldest and v == v:
                    self.ring.updateValue((h,), (v,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((int(hours[-1]) + 1 + max(widths)) * _HOUR_MS)
            out = pd.DataFrame({"area": key[0], "start": new["start"], **{n: s[len(held):] for n, s in zip(names, sums)}})
            out = out[out[names].notna().any(axis=1)]
            yield out.astype({n: object for n in names}).where(out.notna(), None) if len(out) else out

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.ring.clear()
            return iter([])

        def close(self) -> None:
            pass

    return SlidingSums()


# --- R3 ------------------------------------------------------------------------------------------
def run_newest_rows(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str,
                    time: str, late: str, zone: str = "UTC") -> None:
    """Newest row per key, as a table with a part per date of ``time`` (one of the keys).

    Each batch merges its changed keys into the dates they belong to; other dates are neither read nor written. A batch that is run again
    changes nothing. The state of keys whose ``time`` is older than the limit ``late`` is let go; rows that come later still than that
    are dropped.
    """
    rest = [c for c in stream.columns if c not in keys]
    newest = _zoned(stream, time, zone).withWatermark("_ts", late).groupBy(*keys, "_ts").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))

    def store(batch: DataFrame, number: int) -> None:
        changes = batch.select(*keys, "r.*")
        merge(Versions(batch.sparkSession, path), changes, F.date_format(time, "yyyy-MM-dd"), keys, order, checkpoint, number)

    _finish(newest.writeStream.outputMode("update").foreachBatch(store), checkpoint)


def read_newest_rows(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table that ``run_newest_rows`` keeps: one row per key, nothing is aggregated again. ``schema``: of the empty table before the first batch."""
    rows = Versions(spark, path).read()
    if rows is None and schema is None:
        raise FileNotFoundError(f"no version of {path}")
    return rows if rows is not None else spark.createDataFrame([], schema)


# the option and the class that ``run_sliding_sums`` and ``run_level_changes`` need
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


# --- R4 ------------------------------------------------------------------------------------------
def run_level_changes(stream: DataFrame, late: str, path: str, checkpoint: str, divisor: int = 1, **kw) -> None:
    """Alert level of the hourly event count per area, written only when it differs from the last one.

    The hourly counts are final before they reach the state, and the rows of an area in one batch are
    bounded by its hours. State: the last level. The session must use a state store that holds it (``STATE_STORE``).
    """
    hourly = hourly_means(stream, late, **kw)
    counted = hourly.select("area", F.window_time("w").alias("event_time"),
                            F.col("w.start").alias("start"), F.floor(F.col("n") / divisor).cast("int").alias("slips"))
    levelled = classify_default(counted, "slips").select("area", "event_time", "start", F.col("slip_alert_id").alias("level"))
    changes = levelled.groupBy("area").transformWithStateInPandas(
        statefulProcessor=_level_processor(), outputStructType="area string, start timestamp, previous int, level int",
        outputMode="Append", timeMode="None")
    out = changes.select("area", F.col("start").cast("timestamp_ntz").alias("time"), "previous", "level")
    _finish(out.writeStream.format("parquet").outputMode("append"), checkpoint, path)


def _level_processor():
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class LevelChanges(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", "level int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            hours = pd.concat(list(rows)).sort_values("start", ignore_index=True)
            hours["level"] = hours["level"].astype("Int32")
            hours["previous"] = hours["level"].shift(fill_value=self.last.get()[0] if self.last.exists() else pd.NA)
            self.last.update((int(hours["level"].iloc[-1]),))
            changed = hours[hours["level"].ne(hours["previous"]).fillna(True)]
            yield changed.assign(area=key[0])[["area", "start", "previous", "level"]]

        def close(self) -> None:
            pass

    return LevelChanges()


# --- R5 ------------------------------------------------------------------------------------------
def run_distinct_steps(stream: DataFrame, keys: list[str], late: str, path: str, checkpoint: str, ts: str = "ts",
                       zone: str = "UTC") -> None:
    """Drops steps delivered again within the late limit."""
    out = _zoned(stream, ts, zone).withWatermark("_ts", late).dropDuplicatesWithinWatermark(keys).select(*keys)
    _finish(out.writeStream.format("parquet").outputMode("append"), checkpoint, path)
