"""Batch form of the reference job: one canonical transaction frame in, the
four analytic tables, both alert streams and the latest-balance snapshot out.

Q-tx (stateless) and Q-addr (the ledger) share the watermarked transaction
frame.  When several outputs are written, the shared frames are written to the
cluster's shared folder as Parquet, so each is computed once and every output
reads only its columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.operators.activity import state_alerts
from utxoflow.operators.alerts import tx_alerts
from utxoflow.operators.ledger import OUTPOINT, balance_rows, latest_balances, ledger, with_outpoints
from utxoflow.operators.transactions import metric_rows, tx_metrics, tx_rows
from utxoflow.operators.updates import address_updates
from utxoflow.operators.watermark import with_arrival_watermark
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.session import staged


@dataclass
class BatchOutputs:
    transactions: DataFrame      # watermarked canonical frame
    metrics: DataFrame           # P3 records
    transaction_rows: DataFrame  # K4 table
    metric_rows: DataFrame       # K7 table
    updates: DataFrame           # P5
    ledger: DataFrame            # L3/L4/L6 per update
    balance_rows: DataFrame      # K6 table
    latest: DataFrame            # K9 snapshot
    alerts: DataFrame            # K5: tx alerts + state alerts
    alert_records: DataFrame     # K3: the same with the seq and pos they occurred at


def run_batch(tx: DataFrame, opts: LedgerOptions = DEFAULT, materialize: bool = False) -> BatchOutputs:
    wtx = with_arrival_watermark(tx, opts)
    if materialize:
        wtx = staged(wtx, "transactions")
    metrics = tx_metrics(wtx)
    upd = address_updates(wtx)
    led = ledger(upd, opts, once=True)
    if materialize:
        led = with_outpoints(staged(led.drop(*OUTPOINT), "ledger"))
    at = ("seq", "pos")
    of_tx = tx_alerts(wtx, opts, keep=("seq",)).withColumn("pos", F.lit(-1))
    alerts = of_tx.unionByName(state_alerts(led, opts, keep=at))
    return BatchOutputs(
        transactions=wtx, metrics=metrics, transaction_rows=tx_rows(wtx),
        metric_rows=metric_rows(metrics), updates=upd, ledger=led,
        balance_rows=balance_rows(led), latest=latest_balances(led), alerts=alerts.drop(*at),
        alert_records=alerts,
    )
