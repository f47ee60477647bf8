"""Event time and watermarks.

Streaming (W1): Spark's own ``withWatermark`` -- global per query, advanced
per micro-batch.

Batch (W2): the reference stamps every transaction with the watermark current
when it passes (max event time seen so far minus the tolerance), through one
constant-keyed task.  Here the same value is a running max of event time in
arrival order, computed with a range-partitioned two-level scan so no task
sees more than its range.  Late rows are flagged, never dropped (W3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.operators.scan import global_prefix_max
from utxoflow.options import DEFAULT, LedgerOptions


def with_watermark(df: DataFrame, tolerance_ms: int, event_time: str = "event_time") -> DataFrame:
    """W1 (streaming): bounded out-of-orderness on a timestamp column."""
    return df.withWatermark(event_time, f"{int(tolerance_ms)} milliseconds")


def with_arrival_watermark(tx: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """W2 (batch): ``watermark_ms`` = max ``timestamp`` of the transactions that
    arrived before, minus the tolerance (null for the first one: nothing is
    late before any watermark exists)."""
    parts = opts.watermark_partitions or int(
        tx.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    out = global_prefix_max(tx, "timestamp", ["arrival_ms", "seq", "tx_id"], "_seen_max", parts, exclusive=True)
    return (out.withColumn("watermark_ms", (F.col("_seen_max") - F.lit(int(opts.late_tolerance_ms))).cast("long"))
               .drop("_seen_max"))
