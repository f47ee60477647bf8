"""Transactions per minute as a windowed aggregation with eviction (D3).

The engine's windows close when the watermark passes them and drop what comes
later; here late transactions count as well (W3).  So the rows first pass a step
in event-time mode that knows the watermark: it counts them per minute, and gives
the counts of late rows the watermark itself as event time.  The aggregation is
keyed by (window of that time, minute of the transaction): counts on time are a
window of their own minute, counts that come late a correction in the window that is
open now.  Both come out in append mode when their window closes and leave the state,
which therefore holds the open windows only.  A minute's count is the sum of its rows
in the table, plus what the state still holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from utxoflow.operators.watermark import with_watermark
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.session import pickle_by_value

MINUTE = 60_000
SLOTS = 16
COUNTED = "event_time timestamp, minute long, n long"


def counted(ts: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(event time, minute, count) of epoch-ms times: times before ``mark`` count
    at ``mark``."""
    minute = ts - ts % MINUTE
    at = np.where(ts < mark, mark, minute)
    at = np.maximum(at, mark)  # an open minute that began before the mark
    keys, n = np.unique(np.stack([at, minute]), axis=1, return_counts=True)
    return keys[0], keys[1], n


class VolumeProcessor(StatefulProcessor):
    """Counts per minute of a slot's rows; the state is the slot's total."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = int(timerValues.getCurrentWatermarkInMs())
        seen = 0
        for part in rows:
            at, minute, n = counted(part["timestamp"].to_numpy(np.int64), mark)
            seen += len(part)
            yield pd.DataFrame({"event_time": pd.to_datetime(at, unit="ms", utc=True), "minute": minute, "n": n})
        before = self.total.get()
        self.total.update(((0 if before is None else int(before[0])) + seen,))

    def close(self) -> None:
        pass


def volume_stream(tx: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """minute, txs and the window they were counted in, for append mode."""
    timed = with_watermark(tx.withColumn("event_time", F.timestamp_millis("timestamp")), opts.late_tolerance_ms)
    slots = timed.select(F.pmod(F.xxhash64("tx_id"), F.lit(SLOTS)).cast("int").alias("slot"), "timestamp")
    counts = slots.groupBy("slot").transformWithStateInPandas(
        statefulProcessor=VolumeProcessor(), outputStructType=COUNTED, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="event_time")
    return counts.groupBy(F.window("event_time", "1 minute"), "minute").agg(F.sum("n").alias("txs"))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """minute and txs of the windows the state still holds."""
    st = spark.read.format("statestore").option("operatorId", 0).load(checkpoint)
    return st.select(F.col("key.minute").alias("minute"), F.col("value.sum").alias("txs"))


pickle_by_value(__name__)
