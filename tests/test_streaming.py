"""Streaming ledger vs batch ledger; micro-batch lateness; replay idempotency."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from conftest import SF001
from utxoflow.operators.ledger import balance_records, ledger
from utxoflow.operators.updates import address_updates
from utxoflow.plans.fixtures import FXB_OPTIONS, fx_b
from utxoflow.plans.stream_queries import stream_fixture
from utxoflow.session import checkpoint_dir
from utxoflow.sinks import read_latest
from utxoflow.streaming.stream import (drain, read_transaction_files, start_addr_query,
                                         start_tx_query)

TRIGGER = {"processingTime": "200 milliseconds"}


def _run(spark, batches=3):
    run = stream_fixture(spark, SF001, batches)
    q = start_addr_query(read_transaction_files(spark, f"{run}/input"), f"{run}/out", f"{run}/ckpt",
                         FXB_OPTIONS, trigger=TRIGGER)
    drain(q)
    return run


def test_stream_equals_batch_and_late_flags_are_batch_granular(spark):
    run = _run(spark)
    cols = ["address", "tx_id", "kind", "balance", "utxo_count", "timestamp_ms"]
    got = spark.read.parquet(f"{run}/out/balance_updates").select(*cols)
    want = balance_records(ledger(address_updates(fx_b(spark, SF001, None, FXB_OPTIONS)), FXB_OPTIONS)).select(*cols)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

    # Late alerts: Spark's watermark is per micro-batch = max event time of
    # earlier batches minus the tolerance.  Check every alert against it.
    bal = spark.read.parquet(f"{run}/out/balance_updates")
    per_batch = {r.batch_id: r.m for r in bal.groupBy("batch_id").agg(F.max("timestamp_ms").alias("m")).collect()}
    late = spark.read.parquet(f"{run}/out/alerts").filter(F.col("alert_type") == "late_event").collect()
    for a in late:
        d = json.loads(a.details_json)
        assert a.timestamp_ms < d["watermark"] and d["lateness_ms"] == d["watermark"] - a.timestamp_ms
        assert d["watermark"] <= max(per_batch[b] for b in per_batch if b < a.batch_id) - FXB_OPTIONS.late_tolerance_ms


def test_latest_change_log_matches_last_arrival(spark):
    run = _run(spark, batches=2)
    got = {r.address: (r.balance, r.utxo_count) for r in read_latest(spark, f"{run}/out/latest_changes").collect()}
    led = ledger(address_updates(fx_b(spark, SF001, None, FXB_OPTIONS)), FXB_OPTIONS)
    want = {r.address: (float(r.b.balance), r.b.utxo_count) for r in led.groupBy("address").agg(
        F.max_by(F.struct("balance", "utxo_count"), F.struct("arrival_ms", "seq", "pos")).alias("b")).collect()}
    assert got == want


def test_tx_query_tables_and_replay_idempotency(spark):
    run = stream_fixture(spark, SF001, 2)
    src = read_transaction_files(spark, f"{run}/input")
    drain(start_tx_query(src, f"{run}/out", f"{run}/ckpt", FXB_OPTIONS, trigger=TRIGGER))
    n1 = spark.read.parquet(f"{run}/out/transactions").count()
    assert n1 == spark.read.parquet(f"{SF001}/events.parquet").count()
    # Replaying a batch id rewrites exactly its partitions (K8).
    from utxoflow.sinks import write_table
    batch0 = spark.read.parquet(f"{run}/out/transactions").filter("batch_id = 0").drop("batch_id", "event_date")
    write_table(batch0, f"{run}/out/transactions", batch_id=0)
    assert spark.read.parquet(f"{run}/out/transactions").count() == n1


def test_checkpoint_dir_is_taken_from_session(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d
    df = spark.range(10).withColumn("u", F.lit(str(uuid.uuid4())))
    from utxoflow.session import cut_lineage
    assert cut_lineage(df).count() == 10


def test_stream_random_adversarial_ledger_matches_model(spark):
    """Double spends, orphans, spends before outputs, ties, future timestamps
    through the stateful processor (bulk and point state access), over three
    micro-batches, against the sequential model."""
    from decimal import Decimal

    from model import run_model
    from test_random_ledger import _scenario
    from utxoflow.options import DEFAULT
    from utxoflow.schema import TRANSACTION

    o = DEFAULT.with_(velocity_window_ms=300, velocity_count=3, structuring_window_ms=600,
                      structuring_count=2, structuring_ceiling=15.0, stream_partitions=4)
    tx = spark.createDataFrame(_scenario(7, n_tx=240), TRANSACTION)
    run = stream_fixture(spark, SF001, 3, tx=tx)
    q = start_addr_query(read_transaction_files(spark, f"{run}/input"), f"{run}/out", f"{run}/ckpt", o,
                         trigger=TRIGGER)
    drain(q)
    rows = [dict(r.asDict(), order=(r.arrival_ms, r.seq, r.pos)) for r in address_updates(tx).collect()]
    model, _ = run_model(rows, 300, 3, 600, 2, Decimal("15"))
    got = {(r.arrival_ms, r.seq, r.pos): (Decimal(str(r.balance)), r.utxo_count)
           for r in spark.read.parquet(f"{run}/out/balance_updates").collect()}
    assert got == {k: (v[0], v[1]) for k, v in model.items()}
    al = spark.read.parquet(f"{run}/out/alerts").filter("alert_type = 'velocity_spike'").count()
    assert al == sum(1 for v in model.values() if v[2] >= 3)


def test_batch_backfill_then_stream_equals_batch_over_all(spark):
    """Batch over the first half of the arrivals -> ``ledger_state`` seeds the
    stream, which processes the second half: every second-half balance and
    activity alert equals the batch ledger over everything (double spends
    and pending spends cross the seam)."""
    from utxoflow.operators.activity import activity_alerts, activity_counts
    from utxoflow.operators.ledger import ledger_state

    o = FXB_OPTIONS.with_(stream_partitions=4)
    tx = fx_b(spark, SF001, "double", o).cache()
    split = tx.approxQuantile("arrival_ms", [0.5], 0.0)[0]
    first, rest = tx.filter(F.col("arrival_ms") < split), tx.filter(F.col("arrival_ms") >= split)
    init = ledger_state(address_updates(first), o)
    run = stream_fixture(spark, SF001, 2, tx=rest)
    q = start_addr_query(read_transaction_files(spark, f"{run}/input"), f"{run}/out", f"{run}/ckpt", o,
                         trigger=TRIGGER, initial=init)
    drain(q)

    full = ledger(address_updates(tx), o)
    want = (full.filter(F.col("arrival_ms") >= split)
                .select("arrival_ms", "seq", "pos", F.col("balance").cast("double").alias("balance"), "utxo_count"))
    got = spark.read.parquet(f"{run}/out/balance_updates").select("arrival_ms", "seq", "pos", "balance", "utxo_count")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

    counts = activity_counts(full, o).filter(F.col("arrival_ms") >= split)
    want_al = activity_alerts(counts, o).select("alert_id", "details_json")
    got_al = (spark.read.parquet(f"{run}/out/alerts").filter(F.col("alert_type") != "late_event")
                   .select("alert_id", "details_json"))
    assert got_al.count() == want_al.count() and got_al.exceptAll(want_al).count() == 0
    tx.unpersist()


def test_stream_dedupe_drops_redelivered_transactions(spark):
    """Every transaction delivered twice (second copy one batch later): with
    ``dedupe_stream`` the balances equal the single delivery."""
    o = FXB_OPTIONS.with_(stream_partitions=4, dedupe_stream=True)
    tx = fx_b(spark, SF001, None, o)
    twice = tx.unionByName(tx.withColumn("arrival_ms", F.col("arrival_ms") + 1))
    run = stream_fixture(spark, SF001, 2, tx=twice)
    q = start_addr_query(read_transaction_files(spark, f"{run}/input"), f"{run}/out", f"{run}/ckpt", o,
                         trigger=TRIGGER)
    drain(q)
    cols = ["address", "tx_id", "kind", "balance", "utxo_count"]
    got = spark.read.parquet(f"{run}/out/balance_updates").select(*cols)
    want = balance_records(ledger(address_updates(tx), o)).select(*cols)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stream_job_entry_point(spark):
    """``jobs.stream_job`` (what ``python -m utxoflow stream`` runs): Q-tx and
    Q-addr on one parquet file stream, seeded from a batch backfill."""
    from utxoflow.jobs import batch_job, stream_job
    from utxoflow.sources import read_transactions

    o = FXB_OPTIONS.with_(stream_partitions=4)
    tx = fx_b(spark, SF001, None, o).cache()
    split = tx.approxQuantile("arrival_ms", [0.5], 0.0)[0]
    base = f"{checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    paths = batch_job(tx.filter(F.col("arrival_ms") < split), f"{base}/batch", o)
    run = stream_fixture(spark, SF001, 2, tx=tx.filter(F.col("arrival_ms") >= split))
    src = read_transactions(spark, "parquet", path=f"{run}/input", streaming=True)
    q_tx, q_addr = stream_job(spark, src, f"{base}/stream", f"{base}/ckpt", o, trigger_ms=200,
                              initial_state=paths["ledger_state"])
    drain(q_tx, 300)
    drain(q_addr, 300)
    rest = tx.filter(F.col("arrival_ms") >= split)
    assert spark.read.parquet(f"{base}/stream/transactions").count() == rest.count()
    want = (ledger(address_updates(tx), o).filter(F.col("arrival_ms") >= split)
            .select("arrival_ms", "seq", "pos", F.col("balance").cast("double").alias("balance")))
    got = spark.read.parquet(f"{base}/stream/balance_updates").select("arrival_ms", "seq", "pos", "balance")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    tx.unpersist()
