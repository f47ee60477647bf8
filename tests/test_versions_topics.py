"""Versioned tables, reruns and compaction; topics read exactly once; exact coin
selection; rows without an id."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from utxoflow.jobs import batch_job, compact_job
from utxoflow.operators.ledger import ledger
from utxoflow.operators.reaimed import select_coins
from utxoflow.operators.transactions import dedupe_transactions
from utxoflow.operators.updates import address_updates
from utxoflow.options import DEFAULT
from utxoflow.plans.fixtures import FXB_HOT_OPTIONS, FXB_OPTIONS, fx_b
from utxoflow.schema import TRANSACTION
from utxoflow.session import checkpoint_dir
from utxoflow.sinks import compact_table, merge_latest, read_latest, replace_table, write_latest_changes, write_table
from utxoflow.sinks.topics import TopicLog, first_occurrences
from utxoflow.sinks.versions import Part, VersionedTable, VersionTaken, read_live, write_once
from utxoflow.sources import read_with_quarantine


def folder(spark):
    return f"{checkpoint_dir(spark)}/versions-{uuid.uuid4().hex}"


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select("id", (F.col("id") * 3_600_000).alias("timestamp_ms"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_a_name_is_taken_once(spark):
    path = f"{folder(spark)}/1.json"
    write_once(spark, path, "a")
    with pytest.raises(VersionTaken):
        write_once(spark, path, "b")


def test_rerun_replaces_and_failed_run_leaves_the_old(spark):
    path = folder(spark)
    replace_table(numbers(spark, 0, 30), path)
    old = read_live(spark, path)
    replace_table(numbers(spark, 10, 60), path)
    assert ids(read_live(spark, path)) == list(range(10, 60))
    assert ids(old) == list(range(30))  # a reader of the version before goes on
    broken = numbers(spark, 0, 5).withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception):
        replace_table(broken, path)
    assert ids(read_live(spark, path)) == list(range(10, 60))
    replace_table(numbers(spark, 0, 0), path)
    assert ids(read_live(spark, path)) == [] and "event_date" in read_live(spark, path).columns


def test_two_writers_keep_both_changes(spark):
    table = VersionedTable(spark, folder(spark))

    def late(parts):
        if len(table.versions()) == 0:  # another writer commits between the read and the rename
            table.commit(lambda p: p + [Part("batch_id=0", 0, 0)])
        return parts + [Part("batch_id=1", 1, 1)]

    table.commit(late)
    assert [p.first for p in table.parts()] == [0, 1]


def test_batches_are_merged_by_size_and_replays_replace(spark):
    path = folder(spark)
    for n in range(11):
        write_table(numbers(spark, 10 * n, 10 * n + 10), path, batch_id=n)
    write_table(numbers(spark, 100, 110), path, batch_id=10)  # replay of the newest
    before = read_live(spark, path)
    assert compact_table(spark, path, fanout=3, keep=50) > 0
    table = VersionedTable(spark, path)
    assert sorted((p.first, p.last) for p in table.parts()) == [(0, 0), (1, 9), (10, 10)]
    after = read_live(spark, path)
    assert ids(before) == ids(after) == list(range(110)) and set(after.columns) == {"id", "timestamp_ms", "batch_id", "event_date"}
    assert sorted(r.batch_id for r in after.collect()) == [n for n in range(11) for _ in range(10)]
    with pytest.raises(ValueError):  # batch 4 has been merged
        write_table(numbers(spark, 40, 50), path, batch_id=4)
    assert ids(read_live(spark, path, table.version_of_batch(3))) == list(range(40))
    assert table.vacuum(1) == 12 and ids(read_live(spark, path)) == list(range(110))
    with pytest.raises(FileNotFoundError):
        table.version_of_batch(3)


def test_parts_stay_few(spark):
    table = VersionedTable(spark, folder(spark))

    def merge(rows, target):
        rows.drop("event_date").write.parquet(target)

    for n in range(40):
        spark.range(1).write.mode("overwrite").parquet(f"{table.path}/batch_id={n}")
        table.add_batch(n, spark.range(1).schema)
        table.compact(merge, fanout=2)
    assert len(table.parts()) <= 8 and table.read().count() == 40


def test_folders_of_earlier_releases_are_adopted(spark):
    path = folder(spark)
    for n in range(2):
        numbers(spark, n, n + 1).write.parquet(f"{path}/batch_id={n}")
    assert ids(read_live(spark, path)) == [0, 1]
    write_table(numbers(spark, 2, 3), path, batch_id=2)
    assert [p.first for p in VersionedTable(spark, path).parts()] == [0, 1, 2]


def test_latest_log_merges_where_it_lies(spark):
    path = folder(spark)
    ddl = "address string, balance double, utxo_count long, timestamp_ms long, source string, arrival_ms long, seq long, tx_id string, pos int"
    for n in range(9):
        rows = [(f"a{i}", float(10 * n + i), 1, n, "s", n, i, "t", 0) for i in range(n % 4 + 1)]
        write_latest_changes(spark.createDataFrame(rows, ddl), path, n)
    want = sorted(read_latest(spark, path).collect())
    at_five = sorted(read_latest(spark, path, as_of_batch=5).collect())
    assert merge_latest(spark, path, fanout=2, keep=100) > 0
    assert sorted(read_latest(spark, path).collect()) == want and sorted(read_latest(spark, path, as_of_batch=5).collect()) == at_five
    assert {(r.address, r.balance) for r in read_latest(spark, path, as_of_batch=5).collect()} == {("a0", 50.0), ("a1", 51.0), ("a2", 32.0), ("a3", 33.0)}


def test_batch_job_twice_and_compact_job(spark):
    out = folder(spark)
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    for _ in range(2):
        batch_job(tx, out, FXB_OPTIONS)
    n = tx.count()
    assert read_live(spark, f"{out}/transactions").count() == n
    assert read_live(spark, f"{out}/balance_updates").count() == address_updates(tx).count()
    assert compact_job(spark, out, fanout=2) == {"transactions": 0, "metrics": 0, "alerts": 0, "balance_updates": 0}


# ---- topics ----

def test_topic_log_counts_one_delivery(spark):
    path = folder(spark)
    log = TopicLog(spark, f"{path}/log")
    fail = [True]

    def publish(topic, records, batch_id):
        records.write.mode("append").json(f"{path}/{topic}")
        if fail and fail.pop():
            raise RuntimeError("died")

    def records(batch):
        return spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"),
                                     F.concat(F.lit(f"{batch}:"), F.col("id").cast("string")).alias("occurrence"))

    deliver = log.exactly_once("q", publish)
    with pytest.raises(RuntimeError):
        deliver("alerts", records(0), 0)
    deliver("alerts", records(0), 0)
    deliver("alerts", records(0), 0)  # logged: not published again
    deliver("alerts", records(1), 1)
    seen = spark.read.schema("key string, value string, occurrence string, origin struct<query: string, batch_id: bigint, delivery: string>").json(f"{path}/alerts")
    assert seen.count() == 15
    assert sorted(r.occurrence for r in log.committed("alerts", seen).collect()) == [f"{b}:{i}" for b in range(2) for i in range(5)]
    assert first_occurrences(seen).count() == 10


# ---- exact amounts, ids ----

def test_coins_stop_at_a_target_met_exactly(spark):
    coins = spark.createDataFrame([("a", "t1", 0, 0.2), ("a", "t2", 0, 0.1), ("b", "t3", 0, 0.1), ("b", "t4", 0, 0.2), ("b", "t5", 0, 0.3),
                                   ("c", "t6", 0, 0.1)], "address string, tx_id string, output_index int, value double")
    targets = spark.createDataFrame([("a", 0.2), ("b", 0.6), ("c", 0.2)], "address string, target double")
    got = {(r.address, r.tx_id, r.running) for r in select_coins(coins, targets, DEFAULT).collect()}
    assert got == {("a", "t1", 0.2), ("b", "t5", 0.3), ("b", "t4", 0.5), ("b", "t3", 0.6)}
    hot = select_coins(coins, targets, DEFAULT.with_(hot_key_rows=2, rows_per_bucket=1))
    assert {(r.address, r.tx_id, r.running) for r in hot.collect()} == got


def test_rows_without_an_id(spark):
    rows = [(None, 1, [], [], "s", 1, 1, 1), (None, 1, [], [], "s", 1, 1, 1), ("x", 1, [], [], "s", 1, 1, 1), ("x", 1, [], [], "s", 1, 2, 2)]
    schema = TRANSACTION.fromJson({**TRANSACTION.jsonValue(), "fields": [{**f, "nullable": True} for f in TRANSACTION.jsonValue()["fields"]]})
    tx = spark.createDataFrame(rows, schema)
    assert sorted((r.tx_id or "", r.arrival_ms) for r in dedupe_transactions(tx).collect()) == [("", 1), ("", 1), ("x", 1)]
    path = folder(spark)
    tx.write.parquet(path)
    good, bad = read_with_quarantine(spark, "parquet", path=path)
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["missing_id"] * 2


def test_hot_ledger_takes_its_window_once(spark):
    plan = ledger(address_updates(fx_b(spark, SF001, "hot", FXB_HOT_OPTIONS)), FXB_HOT_OPTIONS.with_(hot_key_rows=100))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ref_tx" not in "".join(x for x in text.splitlines() if "Window" in x)
