"""Address tables without exchanges, packed archives, the block source, the volume
stream's bounded state, the job's own deduplication."""

from __future__ import annotations

import json
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from utxoflow.jobs import stream_job
from utxoflow.operators.ledger import balance_records, ledger
from utxoflow.operators.updates import address_updates
from utxoflow.plans.fixtures import FXB_OPTIONS, fx_b
from utxoflow.plans.stream_queries import FILES, block_archive, stream_batches, stream_fixture, transaction_batches
from utxoflow.session import checkpoint_dir
from utxoflow.sinks import archive_blocks, merge_packed, read_packed_archive, write_packed_archive
from utxoflow.sinks.versions import VersionedTable, read_live
from utxoflow.sources import parse_transactions, read_with_quarantine, register_source
from utxoflow.sources.blocks import ends, read_blocks
from utxoflow.streaming.stream import drain, read_volume, start_volume_query
from utxoflow.streaming.volume import MINUTE, counted, open_windows

TRIGGER = {"availableNow": True}


def folder(spark):
    return f"{checkpoint_dir(spark)}/storage-{uuid.uuid4().hex}"


@pytest.mark.parametrize("name", ["top_addresses", "balance_distribution", "balance_updates_final"])
def test_address_panels_read_without_an_exchange(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(address" not in plan and "Bucketed: true" in plan


# ---- packed archives ----

def blocks(spark, heights, offset, text="v"):
    rows = [(json.dumps({"height": h, "v": f"{text}{h}"}), offset + i) for i, h in enumerate(heights)]
    return archive_blocks(spark.createDataFrame(rows, "value string, offset bigint"))[0]


def test_packed_archive(spark):
    path = folder(spark)
    write_packed_archive(blocks(spark, range(5000), 0), path)
    write_packed_archive(blocks(spark, [7, 5001, 4999], 10_000, "w"), path)
    write_packed_archive(blocks(spark, [8], 1, "old"), path)  # an earlier record that arrives late
    for _ in range(2):
        got = {r.height: json.loads(r.raw)["v"] for r in read_packed_archive(spark, path).collect()}
        assert len(got) == 5001 and got["7"] == "w7" and got["4999"] == "w4999" and got["8"] == "v8" and got["5001"] == "w5001"
        some = {int(r.height) for r in read_packed_archive(spark, path, 6, 9).collect()}
        assert some == {6, 7, 8, 9}
        merge_packed(spark, path, fanout=3)
    assert len(VersionedTable(spark, path).parts()) == 1
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    live = VersionedTable(spark, path).parts()[0].folder
    assert files.load(f"{path}/{live}").count() <= 8
    plan = read_packed_archive(spark, path, 6, 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(height_number,6)" in plan and "LessThanOrEqual(height_number,9)" in plan


# ---- the block source ----

def test_block_source_batch_and_stream(spark):
    path, out = folder(spark), folder(spark)
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    archive = block_archive(tx).cache()
    middle = archive.agg(F.max("offset")).first()[0] // 2
    seen = []
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        write_packed_archive(archive.filter(part), path)
        query = read_blocks(spark, path, True, stretch=3).writeStream.format("parquet").option("path", out)
        drain(query.option("checkpointLocation", f"{out}-ckpt").trigger(**TRIGGER).start())
        seen.append(spark.read.parquet(out).count())
    assert seen == [middle + 1, archive.count()]
    batch = sorted(map(tuple, read_blocks(spark, path, stretch=4).collect()))
    assert batch == sorted(map(tuple, spark.read.parquet(out).collect()))
    assert batch == sorted((int(r.height), r.raw) for r in archive.collect())
    assert [r.height for r in read_blocks(spark, path, lo=3, hi=5).orderBy("height").collect()] == [3, 4, 5]
    assert ends(path) == (0, archive.count() - 1)
    good, bad = read_with_quarantine(spark, "blocks", path=path)
    assert good.count() == tx.count() and bad.count() == 0
    archive.unpersist()


def test_block_source_without_blocks(spark):
    assert read_blocks(spark, folder(spark)).collect() == [] and ends(folder(spark)) is None


def test_registered_sources_reach_the_registry(spark):
    text = json.dumps({"tx_id": "a", "timestamp": 1, "inputs": [], "outputs": []})
    register_source("Lines", lambda spark, streaming, lines: parse_transactions(spark.createDataFrame([(x,) for x in lines], "value string")))
    good, bad = read_with_quarantine(spark, "lines", lines=[text, "{"])
    assert [r.tx_id for r in good.collect()] == ["a"] and [r.reason for r in bad.collect()] == ["malformed_json"]
    with pytest.raises(ValueError):
        read_with_quarantine(spark, "none such")


# ---- volume ----

def test_counts_of_late_rows_are_not_behind_the_mark():
    rng = np.random.default_rng(1)
    ts = rng.integers(0, 50 * MINUTE, 500)
    for mark in (0, 1, 20 * MINUTE, 20 * MINUTE + 1, 60 * MINUTE):
        at, minute, n = counted(ts, mark)
        assert (at >= mark).all() and n.sum() == 500 and ((at == minute) | (at == mark)).all()
        assert dict(zip(*np.unique(ts - ts % MINUTE, return_counts=True))) == {m: n[minute == m].sum() for m in set(minute.tolist())}


def test_volume_keeps_late_rows_and_open_windows_only(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    run = stream_fixture(spark, SF001, 6, tx=tx, files=FILES)
    drain(start_volume_query(transaction_batches(spark, run), f"{run}/out", f"{run}/ckpt", trigger=TRIGGER, opts=FXB_OPTIONS))
    want = {r.m: r.n for r in tx.groupBy((F.col("timestamp") - F.col("timestamp") % MINUTE).alias("m")).agg(F.count("*").alias("n")).collect()}
    assert {r.minute: r.txs for r in read_volume(spark, f"{run}/out", f"{run}/ckpt").collect()} == want
    newest = tx.agg(F.max("timestamp")).first()[0]
    held = [r.minute for r in open_windows(spark, f"{run}/ckpt/q_volume").collect()]
    open_ = [m for m in want if m + MINUTE > newest - FXB_OPTIONS.late_tolerance_ms]
    last = stream_batches(tx, 6).filter(F.col("_b") == 5).count()  # corrections of the last batch wait for its window
    assert len(held) <= len(open_) + last < len(want) / 2


# ---- jobs ----

def test_stream_job_counts_a_delivery_once_by_default(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    twice = tx.unionByName(tx.withColumn("arrival_ms", F.col("arrival_ms") + 1))
    run = stream_fixture(spark, SF001, 2, tx=twice, files=FILES)
    src, bad = read_with_quarantine(spark, "parquet", path=f"{run}/input", streaming=True, options={"maxFilesPerTrigger": FILES})
    queries = stream_job(spark, src, f"{run}/out", f"{run}/ckpt", FXB_OPTIONS.with_(outpoint_slots=4), trigger_ms=200, rejected=bad, split=True)
    for q in queries:
        drain(q)
    cols = ["address", "tx_id", "kind", "balance", "utxo_count"]
    got = read_live(spark, f"{run}/out/balance_updates").select(*cols)
    want = balance_records(ledger(address_updates(tx), FXB_OPTIONS)).select(*cols)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert read_live(spark, f"{run}/out/transactions").count() == tx.count()
