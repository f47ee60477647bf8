"""Transaction alerts (A1 fan_out, A2 whale_transaction) and the alert
envelope shared with the stateful alerts (P8, P9).

Both rules are evaluated in one narrow pass: an array of at most two optional
alerts per transaction, filtered and exploded (no shuffle, no union of scans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utxoflow.functions import array_sum, as_double, first_or
from utxoflow.options import DEFAULT, LedgerOptions

def alert_struct(alert_id: Column, alert_type: str, severity: str, ts: Column, tx_id: Column,
                 address: Column, details: Column) -> Column:
    return F.struct(
        alert_id.alias("alert_id"), F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"), ts.cast("long").alias("timestamp_ms"),
        tx_id.alias("tx_id"), address.alias("address"), F.to_json(details).alias("details_json"),
    )


def _fan_out(opts: LedgerOptions, total_out: Column) -> Column:
    alert = alert_struct(
        F.concat(F.col("tx_id"), F.lit(":fanout")), "fan_out", "medium", F.col("timestamp"),
        F.col("tx_id"), first_or("inputs", "address", "coinbase"),
        F.struct(F.size("outputs").alias("output_count"), as_double(total_out).alias("total_output")),
    )
    return F.when(F.size("outputs") >= opts.fan_out_threshold, alert)


def _whale(opts: LedgerOptions, total_out: Column) -> Column:
    alert = alert_struct(
        F.concat(F.col("tx_id"), F.lit(":whale")), "whale_transaction", "high", F.col("timestamp"),
        F.col("tx_id"), first_or("outputs", "address", "unknown"),
        F.struct(as_double(total_out).alias("total_output")),
    )
    threshold = F.lit(str(opts.whale_threshold)).cast("decimal(38,8)")
    return F.when(total_out >= threshold, alert)


def tx_alerts(tx: DataFrame, opts: LedgerOptions = DEFAULT, rules=("fan_out", "whale"), keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``: columns of the transaction to have beside the alert."""
    total_out = array_sum("outputs")
    makers = {"fan_out": _fan_out, "whale": _whale}
    candidates = F.array(*[makers[r](opts, total_out) for r in rules])
    return (tx.select(F.explode(F.filter(candidates, lambda a: a.isNotNull())).alias("a"), *keep)
              .select("a.*", *keep))


def fan_out_alerts(tx: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    return tx_alerts(tx, opts, rules=("fan_out",))


def whale_alerts(tx: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    return tx_alerts(tx, opts, rules=("whale",))


def dedupe_alerts(alerts: DataFrame) -> DataFrame:
    """Extra [ours]: one row per alert_id (the reference keeps multiplicity)."""
    return alerts.dropDuplicates(["alert_id"])
