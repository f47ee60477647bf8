"""Nothing is lost: late re-deliveries, quarantine, archives, large amounts, ties."""

from __future__ import annotations

import json
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from utxoflow.jobs import batch_job, file_topics, publish_job, stream_job
from utxoflow.operators.ledger import balance_records, ledger
from utxoflow.operators.transactions import dedupe_transactions, tx_metrics
from utxoflow.operators.updates import address_updates
from utxoflow.options import DEFAULT
from utxoflow.plans.fixtures import FXB_OPTIONS, fx_b
from utxoflow.schema import TRANSACTION
from utxoflow.session import checkpoint_dir
from utxoflow.sinks import archive_blocks, compact_latest, read_archive, read_latest, write_archive, write_latest_changes
from utxoflow.sources import parse_transactions, read_with_quarantine
from utxoflow.streaming.stream import drain, read_transaction_files, start_addr_query, start_archive_query, start_tx_query

NOW = {"availableNow": True}


def _dir(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _tx(tx_id, ts, arrival, seq, inputs=(), outputs=()):
    return (tx_id, ts, [(a, Decimal(str(v)), p, i) for a, v, p, i in inputs],
            [(a, Decimal(str(v)), i) for a, v, i in outputs], "s", arrival, arrival, seq)


def _stream(spark, batches, path):
    for rows in batches:
        spark.createDataFrame(rows, TRANSACTION).coalesce(1).write.mode("append").parquet(path)
    return read_transaction_files(spark, path)


def test_stream_dedupe_keeps_late_transactions(spark):
    run = _dir(spark, "dedupe")
    day = 86_400_000
    rows = [_tx(f"t{i}", 10 * day if i != 4 else day, i, i, outputs=[("a", 1, 0)]) for i in range(6)]
    src = _stream(spark, [rows[:3], rows[3:] + rows[:2]], f"{run}/in")
    o = DEFAULT.with_(dedupe_stream=True, stream_partitions=2)
    for start in (start_tx_query, start_addr_query):
        drain(start(src, f"{run}/out", f"{run}/ck", o, trigger=NOW))
    tx = spark.read.parquet(f"{run}/out/transactions")
    assert tx.count() == 6 and {r.tx_id for r in tx.filter("is_late = 1").collect()} == {"t4"}
    assert spark.read.parquet(f"{run}/out/balance_updates").count() == 6
    assert {r.alert_id for r in spark.read.parquet(f"{run}/out/alerts").collect()} == {"t4:a:late"}


def test_bad_records_are_quarantined_not_fatal(spark):
    good = {"tx_id": "g", "timestamp": "12", "inputs": [], "outputs": [{"address": "a", "value": 1.5, "output_index": 0}], "source": "s"}

    def bad(**change):
        return json.dumps({**good, **change})

    def out(**change):
        return bad(outputs=[{**good["outputs"][0], **change}])

    lines = [json.dumps(good), "{", "[]", "", bad(tx_id=None), bad(timestamp="x"), json.dumps({k: v for k, v in good.items() if k != "inputs"}),
             out(value="abc"), out(value=1e30), out(output_index=3_000_000_000), out(value=None), bad(outputs=None), bad(timestamp=None)]
    run = _dir(spark, "bad")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{run}/in")
    tx, rejected = read_with_quarantine(spark, "json", path=f"{run}/in")
    out_paths = batch_job(tx, f"{run}/out", DEFAULT, rejected)
    assert spark.read.parquet(out_paths["transactions"]).count() == 1
    reasons = {r.reason: r["count"] for r in spark.read.parquet(out_paths["quarantine"]).groupBy("reason").count().collect()}
    assert reasons == {"malformed_json": 4, "bad_timestamp": 2, "missing_field": 2, "bad_value": 4}


def test_stream_job_writes_quarantine_and_topics(spark):
    run = _dir(spark, "sjob")
    spark.createDataFrame([('{"tx_id": "a", "timestamp": 5, "inputs": [], "outputs": []}',), ("{nope",)], "value string").write.text(f"{run}/in")
    tx, rejected = read_with_quarantine(spark, "json", path=f"{run}/in", streaming=True)
    o = DEFAULT.with_(trigger_ms=200, stream_partitions=2)
    for q in stream_job(spark, tx, f"{run}/out", f"{run}/ck", o, rejected=rejected, topics=file_topics(f"{run}/topics")):
        drain(q)
    assert [r.reason for r in spark.read.parquet(f"{run}/out/quarantine").collect()] == ["malformed_json"]
    assert spark.read.json(f"{run}/topics/metrics").count() == 1


def test_archive_second_write_keeps_other_heights(spark):
    path = _dir(spark, "archive")

    def blocks(*items):
        return spark.createDataFrame([(json.dumps({"height": h, "v": v}), o) for o, (h, v) in enumerate(items)], "value string, offset long")

    write_archive(archive_blocks(blocks((5, 1), (6, 1), ("genesis", 0)))[0], path)
    write_archive(archive_blocks(blocks((7, 2), (6, 2)))[0], path)
    got = {r.height: json.loads(r.raw)["v"] for r in read_archive(spark, path).collect()}
    assert got == {"5": 1, "6": 2, "7": 2, "genesis": 0}


def test_archive_stream(spark):
    run = _dir(spark, "archives")
    for k, rows in enumerate([[(1, "a"), (2, "a")], [(2, "b"), (None, "x")]]):
        spark.createDataFrame([(json.dumps({"height": h, "v": v}), 10 * k + i) for i, (h, v) in enumerate(rows)],
                              "value string, offset long").coalesce(1).write.mode("append").parquet(f"{run}/in")
    src = spark.readStream.schema("value string, offset long").option("maxFilesPerTrigger", 1).parquet(f"{run}/in")
    drain(start_archive_query(src, run, f"{run}/ck", trigger=NOW))
    assert {r.height: json.loads(r.raw)["v"] for r in read_archive(spark, f"{run}/archive").collect()} == {"1": "a", "2": "b"}
    assert [r.reason for r in spark.read.parquet(f"{run}/archive_rejected").collect()] == ["missing_height"]


def test_balances_beyond_eighteen_digits(spark):
    rows = [_tx(f"t{i}", 1, i, i, outputs=[("a", "9000000000", 0), ("a", "9000000000", 1)]) for i in range(12)]
    tx = spark.createDataFrame(rows, TRANSACTION)
    want = [9e9 * (k + 1) for k in range(24)]
    assert sorted(r.balance for r in balance_records(ledger(address_updates(tx))).collect()) == want
    assert {r.total_output for r in tx_metrics(tx).collect()} == {1.8e10}
    run = _dir(spark, "large")
    drain(start_addr_query(_stream(spark, [rows[:5], rows[5:]], f"{run}/in"), f"{run}/out", f"{run}/ck",
                           DEFAULT.with_(stream_partitions=2), trigger=NOW))
    assert sorted(r.balance for r in spark.read.parquet(f"{run}/out/balance_updates").collect()) == want


def test_equal_arrivals_spend_once(spark):
    rows = [_tx("a", 1, 1, 1, outputs=[("x", 10, 0)]), _tx("b", 1, 2, 7, inputs=[("x", 10, "a", 0)]),
            _tx("c", 1, 2, 7, inputs=[("x", 10, "a", 0)])]
    got = {r.tx_id: (r.balance, r.utxo_count) for r in balance_records(ledger(address_updates(spark.createDataFrame(rows, TRANSACTION)))).collect()}
    assert got == {"a": (10.0, 1), "b": (0.0, 0), "c": (0.0, 0)}


def test_partition_completes_the_order(spark):
    text = json.dumps({"tx_id": "t", "timestamp": 1, "inputs": [], "outputs": []})
    raw = spark.createDataFrame([(text, 5, 9, p) for p in (2, 0, 1)], "value string, arrival_ms long, offset long, partition int")
    assert len({r.seq for r in parse_transactions(raw)[0].collect()}) == 3


def test_batch_dedupe_counts_a_delivery_once(spark):
    row = _tx("a", 1, 1, 1, outputs=[("x", 10, 0)])
    again = _tx("a", 1, 2, 2, outputs=[("x", 10, 0)])
    run = _dir(spark, "twice")
    paths = batch_job(spark.createDataFrame([row, again], TRANSACTION), run)
    latest = spark.read.parquet(paths["latest_balances"]).first()
    assert (latest.balance, latest.utxo_count) == (10.0, 1)
    assert dedupe_transactions(spark.createDataFrame([row, again], TRANSACTION)).count() == 1


def test_idle_stream_leaves_no_folders(spark):
    run = _dir(spark, "idle")
    src = _stream(spark, [[_tx("a", 1, 1, 1, outputs=[("x", 10, 0)])]], f"{run}/in")
    q = start_addr_query(src, f"{run}/out", f"{run}/ck", DEFAULT.with_(stream_partitions=2), trigger={"processingTime": "100 milliseconds"})
    q.processAllAvailable()
    q.awaitTermination(3)
    drain(q)
    assert [r.batch_id for r in spark.read.parquet(f"{run}/out/balance_updates").select("batch_id").distinct().collect()] == [0]


def test_failed_stream_is_an_error(spark):
    run = _dir(spark, "dead")
    src = _stream(spark, [[_tx("a", 1, 1, 1, outputs=[("x", 10, 0)])]], f"{run}/in")

    def fail(batch, batch_id):
        raise RuntimeError("no")

    with pytest.raises(Exception):
        drain(src.writeStream.foreachBatch(fail).option("checkpointLocation", f"{run}/ck").start())


def test_compacted_log_reads_the_same(spark):
    path, target = _dir(spark, "log"), _dir(spark, "log")
    for b in range(3):
        rows = [(f"a{i}", float(b), 1, b, "s", b, b, "t", 0) for i in range(b + 1)]
        write_latest_changes(spark.createDataFrame(rows, "address string, balance double, utxo_count long, timestamp_ms long, source string, "
                                                         "arrival_ms long, seq long, tx_id string, pos int"), path, b)
    compact_latest(spark, path, target)
    assert sorted(read_latest(spark, path).collect()) == sorted(read_latest(spark, target).collect())
    assert spark.read.parquet(target).count() == 3


def test_publish_job_normalizes_and_keys(spark):
    got = []
    events = fx_b(spark, SF001, None, FXB_OPTIONS).withColumn("attributes", F.create_map(F.lit("k"), F.lit("v")))
    publish_job(events, lambda frame: got.extend(frame.limit(5).collect()))
    for r in got:
        body = json.loads(r["value"])
        assert body["tx_id"] == r["key"] and "attributes" not in body and {"inputs", "outputs", "ingest_time"} <= set(body)
