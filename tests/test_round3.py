"""What moves and how often: tables of JSON text, the ledger by address, the batch
job's shared frames, the files of a delivery batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tests.conftest import SF001
from utxoflow import jobs
from utxoflow.operators.activity import activity_counts, structuring_alerts
from utxoflow.operators.ledger import ledger, ledger_state
from utxoflow.operators.transactions import metric_rows, tx_metrics, tx_rows
from utxoflow.operators.updates import address_updates
from utxoflow.options import DEFAULT
from utxoflow.plans.fixtures import FXA_OPTIONS
from utxoflow.plans.stream_queries import TRIGGER, delivery_files, stream_batches, stream_fixture, transaction_batches
from utxoflow.session import checkpoint_dir, staged
from utxoflow.sinks import dealt, write_table
from utxoflow.streaming.stream import drain, start_tx_query

OPTS = DEFAULT.with_(structuring_window_ms=40, velocity_window_ms=20, structuring_count=2, velocity_count=3, structuring_ceiling=5.0)


def transactions(spark, n=60):
    """A chain of payments between three addresses, every second one spent, one
    address null, some times late."""
    address = F.when(F.col("id") % 17 == 5, F.lit(None)).otherwise(F.concat(F.lit("a"), (F.col("id") % 3).cast("string")))
    money = (F.col("id") % 9 + 1).cast("decimal(18,8)")
    inputs = F.when((F.col("id") >= 3) & (F.col("id") % 2 == 1), F.array(F.struct(
        address.alias("address"), money.alias("value"), (F.col("id") - 3).cast("string").alias("prev_tx_id"),
        F.lit(0).alias("prev_output_index")))).otherwise(F.array().cast(
            "array<struct<address:string,value:decimal(18,8),prev_tx_id:string,prev_output_index:int>>"))
    return spark.range(n).select(
        F.col("id").cast("string").alias("tx_id"), (F.col("id") * 10 - F.when(F.col("id") % 7 == 0, 25).otherwise(0)).alias("timestamp"),
        inputs.alias("inputs"),
        F.array(F.struct(address.alias("address"), money.alias("value"), F.lit(0).alias("output_index"))).alias("outputs"),
        F.lit("t").alias("source"), (F.col("id") * 10).alias("ingest_time"), (F.col("id") * 10).alias("arrival_ms"), F.col("id").alias("seq"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_json_text_is_made_after_rows_are_dealt_and_sorted(spark):
    tx = staged(transactions(spark), "t")
    for frame, make in ((tx, tx_rows), (tx_metrics(tx), metric_rows)):
        out, part = dealt(frame, "timestamp", ("timestamp", "tx_id"), "day", make)
        text = plan(out)
        assert text.rindex("_json") < text.index("Sort [") < text.index("Exchange")
        path = f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"
        write_table(frame, path, time_col="timestamp", sort_cols=("timestamp", "tx_id"), rows=make)
        assert rows(spark.read.parquet(path).drop(part).select(*make(frame).columns)) == rows(make(frame))


def test_ledger_without_hot_address_moves_once(spark):
    upd = address_updates(staged(transactions(spark), "t"))
    led = ledger(upd, OPTS, once=True)
    assert plan(structuring_alerts(activity_counts(led, OPTS), OPTS)).count("Exchange") == 1
    hot = ledger(upd, OPTS.with_(hot_key_rows=10, rows_per_bucket=4), once=True)
    names = [c for c in upd.columns] + ["balance", "utxo_count", "max_ts"]
    assert rows(led.select(*names)) == rows(hot.select(*names)) == rows(ledger(upd, OPTS).select(*names))
    assert rows(led.select(*upd.columns)) == rows(upd)  # the outpoints are the update's
    found = rows(activity_counts(led, OPTS))
    assert found == rows(activity_counts(staged(led, "led"), OPTS)) == rows(activity_counts(hot, OPTS)) and found


def test_final_state_reads_written_summaries(spark):
    upd = address_updates(staged(transactions(spark), "t"))
    led = staged(ledger(upd, OPTS), "led")
    state = ledger_state(upd, OPTS, led)
    assert "Generate" not in plan(state)  # the updates are summarised once, not once per part
    assert {r["part"] for r in state.select("part").distinct().collect()} == {"totals", "utxo", "pending", "recent"}


def test_batch_job_dedupes_once(spark, monkeypatch):
    given = []
    run = jobs.run_batch
    monkeypatch.setattr(jobs, "run_batch", lambda tx, *a, **k: given.append(tx) or run(tx, *a, **k))
    tx = transactions(spark)
    twice = tx.unionByName(tx.filter("seq % 4 = 0").withColumn("arrival_ms", F.col("arrival_ms") + 1))
    jobs.batch_job(twice, f"{checkpoint_dir(spark)}/job-{uuid.uuid4().hex}", OPTS)
    assert "Aggregate" not in plan(given[0]) and rows(given[0]) == rows(tx)


def test_files_of_a_batch_follow_the_tasks(spark):
    tx = stream_batches(transactions(spark), 2)
    assert delivery_files(spark) >= spark.sparkContext.defaultParallelism
    run = stream_fixture(spark, SF001, 2, tx=tx, files=6)
    drain(start_tx_query(transaction_batches(spark, run), f"{run}/out", f"{run}/ckpt", FXA_OPTIONS, trigger=TRIGGER))
    got = spark.read.parquet(f"{run}/out/transactions")
    assert got.select("batch_id").distinct().count() == 2 and got.count() == 60
    assert rows(got.select("batch_id", "tx_id")) == rows(tx.select(F.col("_b").alias("batch_id"), "tx_id"))
