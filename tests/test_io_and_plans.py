"""Sources, sinks and physical-plan properties."""

from __future__ import annotations

import json
import uuid

import pytest

from pyspark.sql import functions as F

from conftest import SF001, SF01
from utxoflow.operators.transactions import dedupe_transactions, tx_metrics
from utxoflow.plans import dashboard
from utxoflow.plans.fixtures import FXB_OPTIONS, fx_b
from utxoflow.session import checkpoint_dir
from utxoflow.sinks import encode_kafka, write_table
from utxoflow.sinks.versions import read_live
from utxoflow.sources import parse_transactions, read_transactions


def _plan(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_kafka_encoding_round_trips_through_parse(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    enc = encode_kafka(tx.drop("arrival_ms", "seq"), key="tx_id")
    assert enc.columns == ["key", "value"]
    raw = enc.select("value", F.lit(1).cast("long").alias("arrival_ms"), F.lit(0).cast("long").alias("offset"))
    back, bad = parse_transactions(raw)
    assert bad.count() == 0
    a = tx_metrics(back).drop("is_late")
    b = tx_metrics(tx).drop("is_late")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_read_transactions_registry_json_batch_and_stream(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    path = f"{checkpoint_dir(spark)}/json-{uuid.uuid4().hex}"
    encode_kafka(tx).select("value").write.text(path)
    batch = read_transactions(spark, "json", path=path)
    assert batch.count() == tx.count()
    stream = read_transactions(spark, "json", path=path, streaming=True)
    assert stream.isStreaming
    try:
        read_transactions(spark, "nope")
    except ValueError as e:
        assert "nope" in str(e)
    else:
        raise AssertionError("unknown source kind must raise")


def test_dedupe_keeps_first_arrival(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    dup = tx.withColumn("arrival_ms", F.col("arrival_ms") + 1)
    out = dedupe_transactions(tx.unionByName(dup))
    assert out.count() == tx.count()
    assert out.exceptAll(tx).count() == 0


def test_table_write_partitions_and_pruned_scan(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    path = f"{checkpoint_dir(spark)}/tx-{uuid.uuid4().hex}"
    write_table(tx_metrics(tx).withColumnRenamed("timestamp", "timestamp_ms"), path)
    since = tx.agg(F.max("timestamp")).first()[0] - 86_400_000
    scan = dashboard.read_table(spark, path, since_ms=since).select("tx_id")
    plan = _plan(scan)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp_ms), GreaterThanOrEqual(timestamp_ms" in plan
    assert "ReadSchema: struct<tx_id:string,timestamp_ms:bigint>" in plan


def test_flagship_plan_is_two_shuffles_and_jvm_only(spark):
    """balance_updates: one shuffle for the key-level window, one for the
    per-address running sums; no single-partition step, no Python UDF; the
    unused watermark scan is pruned by Catalyst."""
    import __spark_entry__ as entry

    plan = _plan(entry.queries()["balance_updates"](spark, SF01))
    tree = "\n".join(l for l in plan.splitlines() if l.strip().startswith(("+-", ":")))
    assert tree.count("Exchange") == 2 and "BroadcastExchange" not in tree
    assert "SinglePartition" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_hot_rows_are_cut_once_and_windows_use_their_pieces(spark):
    from utxoflow.operators.ledger import balance_records, ledger
    from utxoflow.operators.updates import address_updates

    o = FXB_OPTIONS.with_(hot_key_rows=95, rows_per_bucket=20)
    plan = _plan(balance_records(ledger(address_updates(fx_b(spark, SF001, None, o)), o)))
    assert "utxoflow-hot-rows" in plan and "utxoflow-hot-keys" in plan  # written tables, not recomputed
    assert "hashpartitioning(address" in plan and "_bkt" in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["tps_last_minute", "alerts_last_hour", "tx_volume_last_day", "alert_rates"])
def test_registered_panels_prune_partitions(spark, name):
    import __spark_entry__ as entry

    plan = _plan(entry.queries()[name](spark, SF001))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(timestamp_ms" in plan


def test_events_scan_prunes_columns(spark):
    import __spark_entry__ as entry

    plan = _plan(entry.queries()["pattern_mix"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_archive_written_as_json_objects_by_height_bucket(spark):
    from utxoflow.sinks import archive_blocks, write_archive

    raw = spark.createDataFrame([('{"height": 5, "v": 1}', 1), ('{"height": 1500, "v": 2}', 2),
                                 ('{"height": 5, "v": 3}', 3)], "value string, offset long")
    arch, _ = archive_blocks(raw)
    path = f"{checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
    write_archive(arch, path)
    back = {r.object_key: (r.height_bucket, json.loads(r.raw)["v"]) for r in spark.read.json(path).collect()}
    assert back == {"5.json": (0, 3), "1500.json": (1, 2)}


def test_dashboard_sql_panels_equal_dataframe_functions(spark):
    from utxoflow.plans import sql
    from utxoflow.plans.tables import analytic_tables

    paths = analytic_tables(spark, SF001)
    sql.register_tables(spark, paths)
    bal = spark.read.parquet(paths["balance_updates"])
    tx = spark.read.parquet(paths["transactions"])
    al = spark.read.parquet(paths["alerts"])
    pairs = {
        "tps": dashboard.tps(tx),
        "alerts_last_hour": dashboard.alerts_in(al),
        "transaction_volume": dashboard.tx_volume(tx),
        "top_addresses": dashboard.top_addresses(bal),
        "balance_distribution": dashboard.balance_distribution(bal),
        "alert_rates": dashboard.alert_rates(al),
    }
    for name, want in pairs.items():
        got = sql.panel(spark, name)
        assert got.collect() == want.collect(), name
    assert sql.panel(spark, "tps", as_of_ms=10**15).first().tps == 0.0


def test_batch_job_cli_on_json_files(spark):
    from utxoflow.__main__ import main
    from utxoflow.operators.ledger import ledger
    from utxoflow.operators.updates import address_updates

    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    src = f"{checkpoint_dir(spark)}/cli-src-{uuid.uuid4().hex}"
    encode_kafka(tx).select("value").write.text(src)
    out = f"{checkpoint_dir(spark)}/cli-out-{uuid.uuid4().hex}"
    main(["batch", "--source", "json", "--path", src, "--out", out, "--late-tolerance-ms", "86400000"])
    bal = read_live(spark, f"{out}/balance_updates")
    assert bal.count() == address_updates(tx).count()
    # JSON carries no transport order: arrival = ingest_time (= FX-B arrival), ties by id hash.
    want = ledger(address_updates(tx), FXB_OPTIONS).select("address", "balance").groupBy("address").count()
    assert bal.groupBy("address").count().exceptAll(want).count() == 0
    assert read_live(spark, f"{out}/latest_balances").count() == bal.select("address").distinct().count()


def test_metrics_and_alerts_topics(spark):
    from utxoflow.operators.ledger import balance_records, ledger
    from utxoflow.operators.updates import address_updates
    from utxoflow.sinks import alerts_topic, metrics_topic
    from utxoflow.plans.batch import run_batch

    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    out = run_batch(tx, FXB_OPTIONS)
    topic = metrics_topic(out.metrics, balance_records(ledger(address_updates(tx), FXB_OPTIONS)))
    kinds = {r.k: r.n for r in topic.groupBy(F.get_json_object("value", "$.metric_type").alias("k"))
             .count().withColumnRenamed("count", "n").collect()}
    assert kinds == {"transaction": tx.count(), "balance_update": address_updates(tx).count()}
    al = alerts_topic(out.alerts)
    assert al.filter(F.col("key") != F.get_json_object("value", "$.alert_id")).count() == 0


def test_month_partitioned_table_prunes_without_losing_rows(spark):
    tx = fx_b(spark, SF001, None, FXB_OPTIONS)
    path = f"{checkpoint_dir(spark)}/txm-{uuid.uuid4().hex}"
    rows = tx_metrics(tx).withColumnRenamed("timestamp", "timestamp_ms")
    write_table(rows, path, granularity="month")
    since = tx.agg(F.max("timestamp")).first()[0] - 10 * 86_400_000  # mid-month cut
    scan = dashboard.read_table(spark, path, since_ms=since)
    assert "PartitionFilters: [isnotnull(event_month" in _plan(scan.select("tx_id"))
    assert scan.count() == rows.filter(F.col("timestamp_ms") >= since).count()
