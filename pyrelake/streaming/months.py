"""Months counted while days arrive, by state that knows which days it has seen.

State is held for a block of cells and a month: a bit for each day and cell, and a count for each threshold and cell,
in arrays; values are never kept. Days may come in any order. A day that comes again is refused and given out as
such at once; a month is given out when the watermark has passed its end, with the days that it lacks. Days behind the
watermark are left out by Spark, which counts them in the query's progress.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.exceedance import compared

#: Cells of a block: state and Python calls are per block.
BLOCK = 1024
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ROWS = "kind string, world string, year int, month int, cell_id long, date date, threshold string, days int, day_mask int"


class Months(StatefulProcessor):
    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("month", "masks binary, hits binary")

    def _stored(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.state.exists():
            return np.zeros(BLOCK, np.int32), np.zeros((len(self.names), BLOCK), np.int32)
        masks, hits = self.state.get()
        return np.frombuffer(masks, np.int32).copy(), np.frombuffer(hits, np.int32).reshape(-1, BLOCK).copy()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        world, year, month, block = key
        masks, hits = self._stored()
        if not masks.any():
            following = dt.datetime(year + month // 12, month % 12 + 1, 1, tzinfo=dt.timezone.utc)
            self.handle.registerTimer(int(following.timestamp() * 1000))
        for some in rows:
            at, day = (some["cell_id"] % BLOCK).to_numpy(), some["day"].to_numpy()
            again = (masks[at] >> (day - 1) & 1).astype(bool) | some.duplicated(["cell_id", "day"]).to_numpy()
            new = ~again
            np.bitwise_or.at(masks, at[new], (1 << (day[new] - 1)).astype(np.int32))
            for k, n in enumerate(self.names):
                np.add.at(hits[k], at[new], some[f"hit_{n}"].to_numpy(bool)[new])
            if again.any():
                yield self._refused(world, year, month, some[again])
        self.state.update((masks.tobytes(), hits.tobytes()))

    @staticmethod
    def _refused(world: str, year: int, month: int, rows: pd.DataFrame) -> pd.DataFrame:
        dates = [dt.date(year, month, int(d)) for d in rows["day"]]
        return pd.DataFrame({"kind": "refused", "world": world, "year": year, "month": month, "cell_id": rows["cell_id"].to_numpy(), "date": dates, "threshold": None, "days": None, "day_mask": None})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        world, year, month, block = key
        masks, hits = self._stored()
        cells = np.flatnonzero(masks)
        for k, n in enumerate(self.names):
            yield pd.DataFrame({"kind": "month", "world": world, "year": year, "month": month, "cell_id": block * BLOCK + cells, "date": None, "threshold": n, "days": hits[k][cells], "day_mask": masks[cells]})
        self.state.clear()

    def close(self) -> None:
        pass


def closing_months(stream: DataFrame, thresholds: DataFrame, names: list[str], lateness: str = "3 days") -> DataFrame:
    """Rows of kind 'month' (world, year, month, cell_id, threshold, days, day_mask) and 'refused' (world, cell_id, date): for append mode.

    stream has (world, date, cell_id, fwi), thresholds are wide and static.
    """
    use_state(stream.sparkSession)
    timed = stream.withColumn("event_time", F.col("date").cast("timestamp")).withWatermark("event_time", lateness)
    hits = compared(timed, thresholds, names)
    keyed = hits.select("world", F.year("date").alias("year"), F.month("date").alias("month"), F.floor(F.col("cell_id") / BLOCK).cast("long").alias("block"), "cell_id", F.dayofmonth("date").alias("day"), "event_time", *[f"hit_{n}" for n in names])
    return keyed.groupBy("world", "year", "month", "block").transformWithStateInPandas(Months(names), ROWS, "Append", "EventTime")


def use_state(spark: SparkSession) -> None:
    """State that processors keep needs a store with column families."""
    spark.conf.set(*PROVIDER)


def missing_of(months: DataFrame) -> DataFrame:
    """(world, year, month, cell_id, missing) of closed months: the days of the month that a cell lacks."""
    last = F.dayofmonth(F.last_day(F.make_date("year", "month", F.lit(1))))
    days = F.filter(F.sequence(F.lit(1), last), lambda d: F.getbit("day_mask", d - 1) == 0)
    return months.where("kind = 'month'").select("world", "year", "month", "cell_id", days.alias("missing")).distinct().where(F.size("missing") > 0)
