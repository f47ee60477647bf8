"""One options object replaces the reference's environment variables."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class LedgerOptions:
    # Fixed default values of the reference job (thresholds, windows, tolerance).
    late_tolerance_ms: int = 30_000
    whale_threshold: float = 40.0
    fan_out_threshold: int = 8
    structuring_window_ms: int = 120_000
    structuring_count: int = 6
    structuring_ceiling: float = 1.0
    velocity_window_ms: int = 60_000
    velocity_count: int = 12

    # Scale knobs [ours].  An address with at least ``hot_key_rows`` updates is
    # split into pieces of its order of about ``rows_per_bucket`` rows so no
    # single task scans it whole.
    hot_key_rows: int = 2_000_000
    rows_per_bucket: int = 500_000
    # Range partitions used for the global arrival-order watermark scan.
    watermark_partitions: int = 0  # 0 -> spark.sql.shuffle.partitions
    # State / shuffle partitions of the streaming queries (the reference's
    # job parallelism); fixed in the checkpoint at the first start.
    stream_partitions: int = 0  # 0 -> spark.sql.shuffle.partitions, at most two per core
    # Slots of the two-stage streaming ledger: keys that an address's outpoints
    # are spread over (fixed in the checkpoint at the first start).
    outpoint_slots: int = 64
    # Keys that the addresses of a streaming ledger are spread over (fixed in the
    # checkpoint at the first start): a state step takes all rows of a slot
    # together, so its cost does not follow the number of addresses.
    address_slots: int = 256
    # Drop re-delivered transactions (same tx_id) in streams (the ledger
    # assumes each output is delivered once); late ones are kept.  The jobs set it.
    dedupe_stream: bool = False
    # Interval of the streaming triggers (the reference's checkpoint interval).
    trigger_ms: int = 10_000
    # Partition granularity of the written tables: "day" (event_date) or
    # "month" (event_month, for multi-year backfills replayed as a stream).
    table_partition: str = "day"

    @property
    def activity_window_ms(self) -> int:
        return max(self.structuring_window_ms, self.velocity_window_ms)

    def with_(self, **changes) -> "LedgerOptions":
        return replace(self, **changes)


DEFAULT = LedgerOptions()


# Worker code travels by value with the task (no package install needed).
from utxoflow.session import pickle_by_value  # noqa: E402

pickle_by_value(__name__)
