"""Episodes from a stream as keyed state with a watermark and timers.

Where ``live.episodes_stream`` keeps a table up to date, this form emits each
episode once, when no row can extend it any more.  State per cell holds the flagged stretches
that the watermark has not passed, so it is bounded by the delay allowed, not by the
stream; the state store checkpoints it, and a restart goes on where the query stopped.  Rows later
than the watermark are left to the incremental refresh.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kpiloom.functions.timegrid import grid_us
from kpiloom.schema import GRID

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPISODE = "cell_id string, start_ts timestamp, end_ts timestamp, points long"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store; call it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def merged_runs(runs: list[tuple[int, int]], step: int) -> list[tuple[int, int]]:
    """Stretches of steps, joined where they touch or overlap."""
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1] + step:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


class OpenEpisodes(StatefulProcessor):
    """Stretches of one cell that may still grow, in microseconds; a timer closes them behind the watermark."""

    def __init__(self, step: int) -> None:
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "starts array<long>, ends array<long>")

    def _known(self) -> list[tuple[int, int]]:
        held = self.open.get() if self.open.exists() else None
        return list(zip(held[0], held[1])) if held is not None else []

    def _keep(self, runs: list[tuple[int, int]]) -> None:
        if not runs:
            self.open.clear()
            return
        self.open.update(([a for a, _ in runs], [b for _, b in runs]))
        # one timer: the first end that can be passed
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((min(b for _, b in runs) + self.step) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs = self._known()
        for batch in rows:
            at = batch["ts"].astype("datetime64[us]").astype("int64").tolist()
            runs = merged_runs(runs + [(t, t) for t in at], self.step)
        self._keep(runs)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        runs = self._known()
        closed = [(a, b) for a, b in runs if b + self.step < passed]
        self._keep([r for r in runs if r not in closed])
        yield pd.DataFrame(
            {
                "cell_id": [key[0]] * len(closed),
                "start_ts": pd.to_datetime([a for a, _ in closed], unit="us"),
                "end_ts": pd.to_datetime([b for _, b in closed], unit="us"),
                "points": [(b - a) // self.step + 1 for a, b in closed],
            }
        )

    def close(self) -> None:
        pass


def closed_episodes(flags: DataFrame, delay: str, grid: str = GRID) -> DataFrame:
    """Episodes of a stream of ``cell_id, ts, is_anomaly`` grid rows, each once, when the watermark has passed it.

    A row that arrives twice within ``delay`` counts once.  Only flagged rows reach the state.
    """
    marked = flags.withWatermark("ts", delay)
    # A condition on the flag alone would be moved below the watermark, which rows without a flag advance too.
    flagged = F.when(F.col("is_anomaly"), F.col("ts")).isNotNull()
    found = marked.where(flagged).select("cell_id", "ts").dropDuplicatesWithinWatermark(["cell_id", "ts"])
    return found.groupBy("cell_id").transformWithStateInPandas(
        statefulProcessor=OpenEpisodes(grid_us(grid)), outputStructType=EPISODE, outputMode="Append", timeMode="EventTime"
    )
