"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from utxoflow.schema import MONEY, MONEY_SUM


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Round half-even to 8 decimals and keep it exact (``decimal(18,8)``);
    null for what is no number or does not fit (never an error)."""
    return F.bround(_c(c).try_cast("decimal(38,18)"), 8).try_cast(MONEY)


def as_double(c: Column | str) -> Column:
    return _c(c).cast("double")


def array_sum(arr: Column | str, field: str = "value") -> Column:
    """Exact sum of ``arr[*].field`` (0 for an empty array)."""
    zero = F.lit(0).cast(MONEY_SUM)
    return F.aggregate(_c(arr), zero, lambda acc, x: (acc + x[field]).cast(MONEY_SUM))


def epoch_ms(ts: Column | str) -> Column:
    """Floor milliseconds since the epoch of a ``timestamp_ntz`` wall time read as UTC.

    The difference to the NTZ epoch does not depend on the session time zone.
    """
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts).cast("timestamp_ntz")).cast("long")


def ms_to_minute(ms: Column | str) -> Column:
    """Start of the minute as epoch ms (toStartOfMinute on epoch-ms data)."""
    ms = _c(ms)
    return (ms - F.pmod(ms, F.lit(60_000))).cast("long")


def first_or(arr: Column | str, field: str, default: str) -> Column:
    """``arr[0].field`` or a default for an empty array."""
    return F.coalesce(F.get(_c(arr), 0)[field], F.lit(default))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())
