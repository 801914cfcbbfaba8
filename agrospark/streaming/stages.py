"""Stage events as weather days arrive: running degree days per plot as keyed state that ends with the season."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.streaming import state as K

EVENT_SCHEMA = "plot_id long, stage string, stage_date date, gdd double, revision long"


def with_growth_inputs(days: DataFrame, plots: DataFrame, base: float = S.GDD_BASE_C) -> DataFrame:
    """Days since planting, counted from 1970, with their degree days in whole units (missing where a temperature is)
    and the plot's thresholds (a stream-static join)."""
    static = plots.select(
        "plot_id", "planting_date", *[C.stage_threshold(F.col("altitude"), s).alias(s) for s in S.STAGES])
    gdd = C.daily_gdd(F.col("max_temp_c"), F.col("min_temp_c"), base)
    return days.join(static, "plot_id").where(F.col("date") >= F.col("planting_date")).select(
        "plot_id", F.unix_date("date").alias("day"), F.when(gdd.isNotNull(), C.gdd_units(gdd)).cast("double").alias("units"), *S.STAGES)


class Season(StatefulProcessor):
    """One plot's season: its complete days in order with their degree days, and what was reported.

    The first delivery of a day that has both temperatures counts. A day without them adds nothing, until it comes
    complete. Degree days are never negative, so a stage can only move to an earlier day: days after R6 say nothing
    more and are not kept. All a plot has is one value, read and written once a micro-batch.

    When R6 is reached, the season is kept for `grace` days, else for `idle` days from its last delivery; then a timer
    clears it. What is left is a mark, for `remember` days, by which days that come after the end are known and
    passed over; then nothing is. (Without a mark, the days of a part of a season would begin another one.)
    """

    def __init__(self, grace: float, idle: float, remember: float):
        self.grace, self.idle, self.remember = grace, idle, remember

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.season = handle.getValueState("season", "revision bigint, days binary, units binary, " + ", ".join(f"{s} int" for s in S.STAGES))
        self.ended = handle.getValueState("ended", "day int", max(1, int(self.remember * K.DAY_MS)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        given: dict[int, float] = {}
        thresholds = None
        for chunk in rows:
            if thresholds is None:
                thresholds = {s: float(chunk[s].iloc[0]) * S.GDD_UNIT for s in S.STAGES}
            chunk = chunk.dropna(subset=["units"])
            for day, units in zip(chunk["day"].tolist(), chunk["units"].tolist()):
                given.setdefault(day, units)
        if thresholds is None:
            return
        held = self.season.get() if self.season.exists() else None
        if held is None and self.ended.exists():
            return
        revision, days, units = held[:3] if held is not None else (0, b"", b"")
        before = dict(zip(S.STAGES, held[3:] if held is not None else [None] * len(S.STAGES)))
        days, units = self._enter(given, np.frombuffer(days, np.int32), np.frombuffer(units, np.int64))
        sums = np.cumsum(units)
        places = {s: int(np.searchsorted(sums, need)) for s, need in thresholds.items()}
        stages = {s: int(days[p]) if p < len(days) else None for s, p in places.items()}
        changed = [s for s in S.STAGES if stages[s] != before[s]]
        revision += 1
        end = stages[S.STAGES[-1]]
        kept = len(days) if end is None else places[S.STAGES[-1]] + 1
        self.season.update((revision, days[:kept].tobytes(), units[:kept].tobytes(), *stages.values()))
        K.set_timer(self.handle, now, int((self.idle if end is None else self.grace) * K.DAY_MS), first=held is None)
        if changed:
            yield pd.DataFrame({
                "plot_id": [key[0]] * len(changed), "stage": changed,
                "stage_date": [K.EPOCH + dt.timedelta(days=stages[s]) for s in changed],
                "gdd": [int(sums[places[s]]) / S.GDD_UNIT for s in changed], "revision": [revision] * len(changed)})

    @staticmethod
    def _enter(given: dict[int, float], days: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The known days and, of the given ones, those that are not known, in order."""
        came = np.fromiter(given.keys(), np.int32, len(given))
        new = ~np.isin(came, days)
        days = np.concatenate([days, came[new]])
        units = np.concatenate([units, np.fromiter(given.values(), np.float64, len(given))[new].astype(np.int64)])
        order = np.argsort(days)
        return days[order], units[order]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.season.get()[-1] if self.season.exists() else None
        self.season.clear()
        self.ended.update((last,))
        return iter(())

    def close(self) -> None:
        pass


def stage_events(
    days: DataFrame, plots: DataFrame, base: float = S.GDD_BASE_C, grace: float = 30, idle: float = 400, remember: float = 400,
) -> DataFrame:
    """Emits a stage when it is reached, and again under a higher revision when a late or completed day moves it.

    `grace`, `idle` and `remember` are days of processing time, see `Season`.
    """
    return with_growth_inputs(days, plots, base).groupBy("plot_id").transformWithStateInPandas(
        Season(grace, idle, remember), EVENT_SCHEMA, "update", "ProcessingTime")


def start_stages(
    days: DataFrame, plots: DataFrame, events_path: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """The events of every micro-batch under its own `batch` folder, which a replayed batch overwrites."""
    trigger = trigger or {"availableNow": True}
    with K.settings(days.sparkSession, trigger):
        return (
            stage_events(days, plots, **options).writeStream.outputMode("update")
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{events_path}/batch={n}"))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )


def settled_stages(events: DataFrame) -> DataFrame:
    """The latest revision of every (plot, stage) from the collected event log."""
    return events.groupBy("plot_id", "stage").agg(
        F.max_by("stage_date", "revision").alias("stage_date"))
