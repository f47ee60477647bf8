"""Monitoring queries over the analytic tables.

The reference's panels use ``now64()``; every function here takes ``as_of_ms``
(default: the table's max ``timestamp_ms``, as a scalar subquery inside the
same plan) so results are reproducible.  Time buckets are epoch-ms bigints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.functions import ms_to_minute
from utxoflow.sinks.versions import read_live


def _as_of(table: DataFrame, as_of_ms: int | None) -> Column:
    if as_of_ms is not None:
        return F.lit(int(as_of_ms)).cast("long")
    return table.select(F.max("timestamp_ms")).scalar()


def read_table(spark: SparkSession, path: str, since_ms: int | None = None) -> DataFrame:
    """Scan an analytic table; a time bound also prunes ``event_date``
    partitions (derived predicate next to the ``timestamp_ms`` one)."""
    df = read_live(spark, path)
    if since_ms is not None:
        df = df.filter(F.col("timestamp_ms") >= F.lit(int(since_ms)))
        day = F.to_date(F.timestamp_millis(F.lit(int(since_ms))))
        if "event_date" in df.columns:
            df = df.filter(F.col("event_date") >= day)
        elif "event_month" in df.columns:  # month partitions start on the 1st
            df = df.filter(F.col("event_month") >= F.trunc(day, "month"))
    return df


def newest_ms(spark: SparkSession, path: str) -> int | None:
    """The largest ``timestamp_ms`` of a table partitioned by time, read from
    its newest partition only."""
    df = read_live(spark, path)
    part = "event_month" if "event_month" in df.columns else "event_date"
    newest = df.agg(F.max(part)).first()[0]  # partition values only, no column is read
    return None if newest is None else df.filter(F.col(part) == F.lit(newest)).agg(F.max("timestamp_ms")).first()[0]


def recent(spark: SparkSession, path: str, span_ms: int) -> tuple[DataFrame, int | None]:
    """The last ``span_ms`` of a table, partitions pruned, and the time it ends at."""
    as_of = newest_ms(spark, path)
    return read_table(spark, path, None if as_of is None else as_of - span_ms), as_of


def tps(tx: DataFrame, as_of_ms: int | None = None, span_ms: int = 60_000) -> DataFrame:
    """Transactions per second over the last ``span_ms``."""
    since = _as_of(tx, as_of_ms) - F.lit(int(span_ms))
    return (tx.filter(F.col("timestamp_ms") >= since)
              .agg((F.count(F.lit(1)) / F.lit(span_ms / 1000.0)).alias("tps")))


def alerts_in(alerts: DataFrame, as_of_ms: int | None = None, span_ms: int = 3_600_000) -> DataFrame:
    """Number of alerts in the last ``span_ms``."""
    since = _as_of(alerts, as_of_ms) - F.lit(int(span_ms))
    return alerts.filter(F.col("timestamp_ms") >= since).agg(F.count(F.lit(1)).alias("alerts_last_hour"))


def tx_volume(tx: DataFrame, as_of_ms: int | None = None, span_ms: int = 3_600_000) -> DataFrame:
    """D3: transactions per minute (tumbling), ordered."""
    since = _as_of(tx, as_of_ms) - F.lit(int(span_ms))
    return (tx.filter(F.col("timestamp_ms") >= since)
              .groupBy(ms_to_minute("timestamp_ms").alias("minute"))
              .agg(F.count(F.lit(1)).alias("txs"))
              .orderBy("minute"))


def _latest_by_time(bal: DataFrame) -> DataFrame:
    """argMax(balance, timestamp_ms) per address; ties broken by arrival."""
    order = F.struct(*[F.col(c) for c in ("timestamp_ms", "arrival_ms", "seq", "tx_id", "pos") if c in bal.columns])
    return bal.groupBy("address").agg(
        F.max_by("balance", order).alias("balance"), F.count(F.lit(1)).alias("updates"))


def top_addresses(bal: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest latest balances (TakeOrderedAndProject: a top-k
    per partition, then a merge of ``n`` rows per partition)."""
    return (_latest_by_time(bal).select("address", "balance")
            .orderBy(F.desc("balance"), F.asc("address")).limit(n))


def balance_distribution(bal: DataFrame, n: int = 30) -> DataFrame:
    """D5, as the panel's SQL is written: grouped by *address*, ``bucket`` =
    floor(latest balance), ``addresses`` = number of updates of the address."""
    return (_latest_by_time(bal)
            .select(F.floor("balance").alias("bucket"), F.col("updates").alias("addresses"), "address")
            .filter(F.col("bucket") >= 0)
            .orderBy("bucket", "address").limit(n)
            .select("bucket", "addresses"))


def balance_histogram(bal: DataFrame, n: int = 30) -> DataFrame:
    """D5b, as the panel is titled: number of addresses per floor(latest balance)."""
    return (_latest_by_time(bal)
            .groupBy(F.floor("balance").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("addresses"))
            .filter(F.col("bucket") >= 0)
            .orderBy("bucket").limit(n))


def alert_rates(alerts: DataFrame, as_of_ms: int | None = None, span_ms: int = 3_600_000) -> DataFrame:
    """Alerts per minute and type."""
    since = _as_of(alerts, as_of_ms) - F.lit(int(span_ms))
    return (alerts.filter(F.col("timestamp_ms") >= since)
                  .groupBy(ms_to_minute("timestamp_ms").alias("minute"), "alert_type")
                  .agg(F.count(F.lit(1)).alias("total"))
                  .orderBy("minute", "alert_type"))


def balance_updates_final(bal: DataFrame) -> DataFrame:
    """The ReplacingMergeTree collapse -- one row per (address,
    timestamp_ms), the last inserted (arrival order) wins.  A map-side
    combinable ``max_by`` instead of a window: no single-key sort."""
    order = F.struct(*[F.col(c) for c in ("arrival_ms", "seq", "tx_id", "pos") if c in bal.columns])
    keep = [c for c in bal.columns if c not in ("address", "timestamp_ms")]
    return (bal.groupBy("address", "timestamp_ms")
               .agg(F.max_by(F.struct(*[F.col(c) for c in keep]), order).alias("r"))
               .select("address", "timestamp_ms", *[F.col(f"r.{c}").alias(c) for c in keep]))

