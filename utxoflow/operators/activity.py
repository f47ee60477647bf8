"""Recent-activity alerts (L5; A3 velocity_spike, A4 structuring, A5 late_event).

The reference keeps a per-address buffer in arrival order: append the update,
then pop from the head while ``t - head.ts > W`` (``W`` = the larger window).
With ``M_i`` = running max event time of the address up to update ``i``, the
buffer at ``i`` is exactly ``{j <= i : M_j >= M_i - W}`` -- a contiguous range
in arrival order because ``M`` is monotone.  The velocity count is the number
of buffer rows with ``t_i - t_j <= wv``; structuring counts the outputs with
``value <= ceiling`` and ``t_i - t_j <= ws``.

Counting "rows in a range with a per-row threshold" is not a window function,
so this is the one pandas step of the batch ledger (``mapInPandas`` over
sorted partitions, many addresses per Arrow batch).  Groups are bounded: an
ordinary address is one group; an address with at least ``hot_key_rows``
updates is cut into chunks of ``M`` at least ``W`` wide, each chunk carrying
the previous chunk as read-only context (all rows it can see).  Counts take
O(n log n) array steps in any order of event times.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxoflow.operators.alerts import alert_struct
from utxoflow.options import DEFAULT, LedgerOptions

COUNT_SCHEMA = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("tx_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("arrival_ms", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("velocity_count", T.LongType()),
    T.StructField("structuring_count", T.LongType()),
])


class RangeCounts:
    """Counts of values below a bound in a range of positions, for many queries
    at once: a wavelet matrix over value ranks, one array step per bit, so n
    values and q queries cost O((n + q) log n) in whatever order values come."""

    def __init__(self, values: np.ndarray):
        self.sorted = np.unique(values)
        ranks = np.searchsorted(self.sorted, values)
        self.bits = max(1, len(self.sorted).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (ranks >> bit) & 1 == 0
            before = np.concatenate([[0], np.cumsum(zero)])  # zeros before each position
            self.levels.append((bit, before))
            ranks = np.concatenate([ranks[zero], ranks[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values at positions lo <= j < hi are less than ``bound``."""
        x = np.searchsorted(self.sorted, bound)
        lo, hi, found = lo.astype(np.int64), hi.astype(np.int64), np.zeros(len(x), np.int64)
        for bit, before in self.levels:
            a, b, up = before[lo], before[hi], (x >> bit) & 1 == 1
            found += np.where(up, b - a, 0)
            lo, hi = np.where(up, before[-1] + lo - a, a), np.where(up, before[-1] + hi - b, b)
        return found


def window_counts(seg: np.ndarray, ts: np.ndarray, m: np.ndarray, small: np.ndarray,
                  w: int, wv: int, ws: int, first: int = 0, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Velocity and structuring counts of the rows from ``first`` on (or of those
    ``at`` the given places), for rows sorted by (group, arrival).

    ``seg`` numbers the groups (non-decreasing), ``m`` is the running max of
    ``ts`` in the group.  A row's buffer starts at the first row of its group
    with ``m >= m_i - w`` (one ``searchsorted`` over all groups laid side by
    side by rank); the buffer rows recent enough are counted by
    ``RangeCounts``."""
    n = len(ts)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i = np.arange(first, n) if at is None else at
    marks = np.unique(np.concatenate([m, m - w]))
    group = seg.astype(np.int64) * (len(marks) + 1)
    start = np.searchsorted(group + np.searchsorted(marks, m), group[i] + np.searchsorted(marks, m[i] - w), side="left")
    vel = (i + 1 - start) - RangeCounts(ts).below(start, i + 1, ts[i] - wv)
    before = np.concatenate([[0], np.cumsum(small.astype(np.int64))])  # small rows before each position
    lo, hi = before[start], before[i + 1]
    st = hi - lo
    if small.any():
        st = st - RangeCounts(ts[small]).below(lo, hi, ts[i] - ws)
    return vel, st


_OUT = ["address", "tx_id", "timestamp", "arrival_ms", "seq", "pos"]


def _counter(opts: LedgerOptions):
    w, wv, ws = opts.activity_window_ms, opts.velocity_window_ms, opts.structuring_window_ms
    nv, ns = opts.velocity_count, opts.structuring_count

    def process(pdf: pd.DataFrame, first: int) -> pd.DataFrame:
        addr, chunk = pdf["address"].to_numpy(), pdf["_chunk"].to_numpy()
        seg = np.cumsum(np.concatenate([[0], ((addr[1:] != addr[:-1]) | (chunk[1:] != chunk[:-1])).astype(np.int64)]))
        vel, st = window_counts(seg, pdf["timestamp"].to_numpy(np.int64), pdf["max_ts"].to_numpy(np.int64),
                                pdf["small"].to_numpy(bool), w, wv, ws, first)
        rows = pdf.iloc[first:]
        keep = rows["is_query"].to_numpy(bool) & ((vel >= nv) | (st >= ns))
        out = rows.loc[keep, _OUT].copy()
        out["velocity_count"] = vel[keep]
        out["structuring_count"] = st[keep]
        return out

    def run(batches):
        # Rows arrive sorted by (address, chunk, arrival order).  A row's
        # counts depend only on earlier rows of its group, so every batch is
        # emitted at once; only the rows of the last group that can still be
        # in a later row's buffer (M >= M_last - W) are carried forward, as
        # context that is not counted again.  Memory is bounded by the buffer,
        # not by the group.
        carry = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            first = 0 if carry is None else len(carry)
            if first:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            yield process(pdf, first)
            addr, chunk, m = pdf["address"].to_numpy(), pdf["_chunk"].to_numpy(), pdf["max_ts"].to_numpy()
            last = (addr == addr[-1]) & (chunk == chunk[-1]) & (m >= m[-1] - w)
            carry = pdf.loc[last]

    return run


def activity_counts(led: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """Rows of ``ledger(...)`` whose velocity or structuring count reaches its
    threshold, with both counts.  ``led`` needs ``max_ts`` and ``_hot``.

    Groups: (address, chunk) -- one chunk for an ordinary address, chunks of
    ``max_ts`` at least ``W`` wide for a hot one, each with the previous chunk
    as read-only context.  The rows of a group are brought together by a window
    over it, so a ledger that is dealt by address (no hot one) is not moved again,
    any other is once; then ``mapInPandas`` over many groups per Arrow batch."""
    w = opts.activity_window_ms
    small = (F.col("kind") == "output") & (F.col("value") <= F.lit(str(opts.structuring_ceiling)).cast("decimal(38,8)"))
    base = led.select("address", "tx_id", "timestamp", "arrival_ms", "seq", "pos", "max_ts", "_hot",
                      small.alias("small"))
    chunk_w = F.lit(int(max(w, 1)))
    chunk = F.when(F.col("_hot"), F.floor(F.col("max_ts") / chunk_w)).otherwise(F.lit(0)).cast("long")
    # Each row once as a query of its chunk and, for a hot address, once more
    # as read-only context of the next chunk -- one pass (no union branch that
    # would recompute the ledger).
    copies = F.filter(F.array(
        F.struct(chunk.alias("c"), F.lit(True).alias("q")),
        F.when(F.col("_hot"), F.struct((chunk + 1).alias("c"), F.lit(False).alias("q")))),
        lambda x: x.isNotNull())
    order = ["arrival_ms", "seq", "tx_id", "pos"]
    grouped = (base.withColumn("_copy", F.explode(copies))
                   .withColumn("_chunk", F.col("_copy.c")).withColumn("is_query", F.col("_copy.q"))
                   .drop("_copy", "_hot")
                   .withColumn("_place", F.row_number().over(Window.partitionBy("address", "_chunk").orderBy(*order)))
                   .sortWithinPartitions("address", "_chunk", *order))
    return grouped.mapInPandas(_counter(opts), schema=COUNT_SCHEMA)


def _velocity(opts: LedgerOptions):
    return alert_struct(
        F.concat_ws(":", "tx_id", "address", F.lit("velocity")), "velocity_spike", "medium",
        F.col("timestamp"), F.col("tx_id"), F.col("address"),
        F.struct(F.col("velocity_count").alias("events_in_window"),
                 F.lit(int(opts.velocity_window_ms)).cast("long").alias("window_ms")))


def _structuring(opts: LedgerOptions):
    return alert_struct(
        F.concat_ws(":", "tx_id", "address", F.lit("structuring")), "structuring", "high",
        F.col("timestamp"), F.col("tx_id"), F.col("address"),
        F.struct(F.col("structuring_count").alias("events_in_window"),
                 F.lit(int(opts.structuring_window_ms)).cast("long").alias("window_ms"),
                 F.lit(float(opts.structuring_ceiling)).alias("ceiling")))


def velocity_alerts(counts: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    return counts.filter(F.col("velocity_count") >= opts.velocity_count).select(_velocity(opts).alias("a")).select("a.*")


def structuring_alerts(counts: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    return (counts.filter(F.col("structuring_count") >= opts.structuring_count)
                  .select(_structuring(opts).alias("a")).select("a.*"))


def activity_alerts(counts: DataFrame, opts: LedgerOptions = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """A3 + A4 from one pass over the counts (no second pandas pass);
    ``keep``: columns of the update to have beside the alert."""
    both = F.array(F.when(F.col("velocity_count") >= opts.velocity_count, _velocity(opts)),
                   F.when(F.col("structuring_count") >= opts.structuring_count, _structuring(opts)))
    return counts.select(F.explode(F.filter(both, lambda a: a.isNotNull())).alias("a"), *keep).select("a.*", *keep)


def late_alerts(upd: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A5: every update of a transaction older than the watermark it met."""
    late = F.col("watermark_ms").isNotNull() & (F.col("timestamp") < F.col("watermark_ms"))
    a = alert_struct(
        F.concat_ws(":", "tx_id", "address", F.lit("late")), "late_event", "low",
        F.col("timestamp"), F.col("tx_id"), F.col("address"),
        F.struct(F.col("watermark_ms").alias("watermark"),
                 (F.col("watermark_ms") - F.col("timestamp")).alias("lateness_ms")))
    return upd.filter(late).select(a.alias("a"), *keep).select("a.*", *keep)


def state_alerts(led: DataFrame, opts: LedgerOptions = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    return activity_alerts(activity_counts(led, opts), opts, keep).unionByName(late_alerts(led, keep))


# Worker code travels by value with the task (no package install needed).
from utxoflow.session import pickle_by_value  # noqa: E402

pickle_by_value(__name__)
