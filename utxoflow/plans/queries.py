"""
the driver's tables at ``sf_dir`` (fixtures FX-A / FX-B derived by Spark)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from utxoflow.jobs import batch_job
from utxoflow.operators import activity, alerts, ledger, reaimed, transactions, updates
from utxoflow.operators.watermark import with_arrival_watermark
from utxoflow.plans import dashboard
from utxoflow.plans.fixtures import FXA_OPTIONS, FXB_HOT_OPTIONS, FXB_OPTIONS, fx_b_labeled, table
from utxoflow.plans.tables import analytic_tables, balances_by_address, fx_a_table, fx_b_table
from utxoflow.plans.batch import run_batch
from utxoflow.schema import MONEY
from utxoflow.session import checkpoint_dir
from utxoflow.sinks import (archive_blocks, merge_packed, read_archive, read_packed_archive, write_archive, write_packed_archive,
                            write_quarantine)
from utxoflow.sinks.versions import read_live
from utxoflow.sources import parse_transactions, read_with_quarantine

# Extra selective patterns for R3 on the test corpus (the reference's eight
# match nothing there): hex tokens and mail addresses.  For "does the text
# match", one class character before "@" is equivalent to "+" and avoids
# backtracking over long runs of letters.
EXTRA_PATTERNS = [r'token\s*=\s*"[0-9a-f]{16,}"', r"[a-z0-9.]@mail[0-9]+\.example\.com"]
COIN_TARGET = 500.0
DUST_TARGET = 4.0


# ----------------------------------------------------------- shared pieces

def _wtx_b(spark, sf, variant=None):
    return with_arrival_watermark(fx_b_table(spark, sf, variant), FXB_OPTIONS)


def _upd_b(spark, sf, variant=None):
    """Updates stamped with the arrival-order watermark (for lateness)."""
    return updates.address_updates(_wtx_b(spark, sf, variant))


def _upd_plain(spark, sf, variant=None):
    """Updates without the watermark: the ledger does not depend on it, so
    ledger-only queries skip the arrival-order scan altogether."""
    return updates.address_updates(fx_b_table(spark, sf, variant))


def _led_b(spark, sf, variant=None, once=False):
    return ledger.ledger(_upd_plain(spark, sf, variant), FXB_OPTIONS, once)


def _panel(spark, sf, panel, name, span_ms):
    """A panel over the last ``span_ms`` of a table: partitions before it are
    pruned by literal bounds."""
    rows, as_of = dashboard.recent(spark, analytic_tables(spark, sf)[name], span_ms)
    return panel(rows, as_of, span_ms)


def _alerts_b(spark, sf):
    """Three alert branches share the watermarked transactions and the ledger:
    both are written once."""
    return run_batch(fx_b_table(spark, sf), FXB_OPTIONS, materialize=True).alerts


# ----------------------------------------------------------- stateless

def normalize_transactions(spark, sf):
    """P1 on FX-A given as raw events (float money, attributes map)."""
    tx = fx_a_table(spark, sf)
    raw = tx.select(
        "tx_id", "timestamp", "source", "arrival_ms", "seq",
        F.transform("inputs", lambda x: F.struct(
            x["address"].alias("address"), x["value"].cast("double").alias("value"),
            x["prev_tx_id"].alias("prev_tx_id"), x["prev_output_index"].alias("prev_output_index"))).alias("inputs"),
        F.transform("outputs", lambda y: F.struct(
            y["address"].alias("address"), y["value"].cast("double").alias("value"),
            y["output_index"].alias("output_index"))).alias("outputs"),
        F.create_map(F.lit("origin"), F.lit("orders")).alias("attributes"))
    return transactions.exploded_values(transactions.normalize(raw, ingest_time=F.col("timestamp")))


def tx_metrics(spark, sf):
    return transactions.tx_metrics(_wtx_b(spark, sf))


def tx_rows(spark, sf):
    return transactions.tx_rows(with_arrival_watermark(fx_a_table(spark, sf), FXA_OPTIONS))


def address_updates(spark, sf):
    return updates.update_rows(_upd_b(spark, sf))


def alerts_fan_out(spark, sf):
    return alerts.fan_out_alerts(fx_a_table(spark, sf), FXA_OPTIONS)


def alerts_whale(spark, sf):
    return alerts.whale_alerts(fx_a_table(spark, sf), FXA_OPTIONS)


def metrics_table(spark, sf):
    return transactions.metric_rows(transactions.tx_metrics(_wtx_b(spark, sf)))


# ----------------------------------------------------------- ledger

def utxo_snapshot(spark, sf):
    return ledger.utxo_snapshot(_upd_plain(spark, sf))


def pending_spends(spark, sf):
    return ledger.pending_spends(_upd_plain(spark, sf, "orphan"))


def pending_spends_double(spark, sf):
    return ledger.pending_spends(_upd_plain(spark, sf, "double"))


def balance_updates(spark, sf):
    return ledger.balance_records(_led_b(spark, sf))


def balance_updates_double(spark, sf):
    return ledger.balance_records(_led_b(spark, sf, "double"))


def _led_hot(spark, sf):
    return ledger.ledger(_upd_plain(spark, sf, "hot"), FXB_HOT_OPTIONS)


def balance_updates_hot(spark, sf):
    """L3/L4/L6 on FX-B-hot: one address holds a third of the rows and is
    split into arrival buckets (two-level running sums)."""
    return ledger.balance_records(_led_hot(spark, sf))


def balance_updates_large(spark, sf):
    """Balances beyond 10^11: no sum is cast down."""
    return ledger.balance_records(_led_b(spark, sf, "large"))


def balance_updates_ties(spark, sf):
    """Equal arrivals and offsets (two partitions) with double spends: the
    transaction id completes the order."""
    return ledger.balance_records(_led_b(spark, sf, "ties"))


def balance_updates_burst(spark, sf):
    """A hot address whose rows share a few arrival times, split by its whole
    order."""
    return ledger.balance_records(ledger.ledger(_upd_plain(spark, sf, "burst"), FXB_HOT_OPTIONS))


def alerts_activity_hot(spark, sf):
    """A3/A4 on FX-B-hot: the hot address is cut into time chunks."""
    counts = activity.activity_counts(_led_hot(spark, sf), FXB_HOT_OPTIONS)
    return activity.activity_alerts(counts, FXB_HOT_OPTIONS)


def latest_balance(spark, sf):
    return ledger.latest_balances(_led_b(spark, sf))


def alerts_velocity(spark, sf):
    return activity.velocity_alerts(activity.activity_counts(_led_b(spark, sf, once=True), FXB_OPTIONS), FXB_OPTIONS)


def alerts_structuring(spark, sf):
    return activity.structuring_alerts(activity.activity_counts(_led_b(spark, sf, once=True), FXB_OPTIONS), FXB_OPTIONS)


def alerts_late(spark, sf):
    return activity.late_alerts(_upd_b(spark, sf))


def alerts_all(spark, sf):
    return _alerts_b(spark, sf)


# ----------------------------------------------------------- dashboard

def tps_last_minute(spark, sf):
    return _panel(spark, sf, dashboard.tps, "transactions", 60_000)


def tps_last_day(spark, sf):
    return _panel(spark, sf, dashboard.tps, "transactions", 86_400_000)


def alerts_last_hour(spark, sf):
    return _panel(spark, sf, dashboard.alerts_in, "alerts", 3_600_000)


def tx_volume_per_minute(spark, sf):
    return _panel(spark, sf, dashboard.tx_volume, "transactions", 3_600_000)


def tx_volume_last_day(spark, sf):
    return _panel(spark, sf, dashboard.tx_volume, "transactions", 86_400_000)


def top_addresses(spark, sf):
    return dashboard.top_addresses(balances_by_address(spark, sf), 10)


def balance_distribution(spark, sf):
    return dashboard.balance_distribution(balances_by_address(spark, sf), 30)


def balance_histogram(spark, sf):
    return dashboard.balance_histogram(balances_by_address(spark, sf), 30)


def alert_rates(spark, sf):
    return _panel(spark, sf, dashboard.alert_rates, "alerts", 3_600_000)


def alert_rates_last_day(spark, sf):
    return _panel(spark, sf, dashboard.alert_rates, "alerts", 86_400_000)


def balance_updates_final(spark, sf):
    return dashboard.balance_updates_final(balances_by_address(spark, sf)).select(
        "address", "timestamp_ms", "source", "balance", "utxo_count")


# ----------------------------------------------------------- re-aimed

def coin_selection(spark, sf):
    snap = ledger.utxo_snapshot(_upd_plain(spark, sf))
    targets = (table(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("address"))
               .distinct().withColumn("target", F.lit(COIN_TARGET)))
    return reaimed.select_coins(snap, targets, FXB_OPTIONS)


def coin_selection_dust(spark, sf):
    """R1 on amounts below one unit, the hot address split."""
    snap = ledger.utxo_snapshot(_upd_plain(spark, sf, "hot"))
    snap = snap.withColumn("value", (F.col("value").cast(MONEY) * F.lit("0.001").cast("decimal(4,3)")).cast("double"))
    targets = snap.select("address").distinct().withColumn("target", F.lit(DUST_TARGET))
    return reaimed.select_coins(snap, targets, FXB_HOT_OPTIONS)


def coin_selection_exact(spark, sf):
    """R1 with targets that the two largest coins of an address meet exactly."""
    snap = ledger.utxo_snapshot(_upd_plain(spark, sf))
    snap = snap.withColumn("value", (F.col("value").cast(MONEY) * F.lit("0.1").cast("decimal(2,1)")).cast("double"))
    largest = Window.partitionBy("address").orderBy(F.col("value").desc(), "tx_id", "output_index")
    two = snap.withColumn("r", F.row_number().over(largest)).filter("r <= 2")
    targets = two.groupBy("address").agg(F.sum(F.col("value").cast(MONEY)).cast("double").alias("target"))
    return reaimed.select_coins(snap, targets, FXB_OPTIONS)


def pattern_mix(spark, sf):
    return reaimed.pattern_mix(fx_b_labeled(spark, sf, FXB_OPTIONS))


def pattern_scan(spark, sf):
    docs = table(spark, sf, "documents")
    return reaimed.pattern_scan(docs, "doc_id", "text", reaimed.SUSPICIOUS_PATTERNS + EXTRA_PATTERNS)


def pattern_scan_pages(spark, sf):
    pages = table(spark, sf, "pages")
    return reaimed.pattern_scan(pages, "page_id", "html", reaimed.SUSPICIOUS_PATTERNS + EXTRA_PATTERNS)


def _blocks(spark, sf) -> DataFrame:
    """Pages as a block topic: height = page_id % 100 (missing when
    page_id % 7 = 3), every 11th record (page_id % 11 = 5) cut short."""
    pages = table(spark, sf, "pages")
    height = F.when(F.pmod("page_id", F.lit(7)) != 3, F.pmod("page_id", F.lit(100)))
    doc = F.to_json(F.struct(height.alias("height"), F.col("page_id"), F.col("url"), F.col("html")))
    raw = F.when(F.pmod("page_id", F.lit(11)) == 5, F.substring(doc, 1, 40)).otherwise(doc)
    return pages.select(raw.alias("value"), F.col("page_id").alias("offset"))


def archive(spark, sf):
    arch, _rej = archive_blocks(_blocks(spark, sf))
    return arch.select("height", "object_key", "offset", F.length("raw").alias("n_chars"))


def archive_rejected(spark, sf):
    _arch, rej = archive_blocks(_blocks(spark, sf))
    return rej


def _raw_json_b(spark, sf) -> DataFrame:
    """FX-B as JSON text: every 97th record cut short, every 101st timestamp
    written as a string."""
    tx = fx_b_table(spark, sf)

    def body(ts):
        return F.to_json(F.struct(
            "tx_id", ts.alias("timestamp"),
            F.transform("inputs", lambda x: F.struct(
                x["address"].alias("address"), x["value"].cast("double").alias("value"),
                x["prev_tx_id"].alias("prev_tx_id"), x["prev_output_index"].alias("prev_output_index"))).alias("inputs"),
            F.transform("outputs", lambda y: F.struct(
                y["address"].alias("address"), y["value"].cast("double").alias("value"),
                y["output_index"].alias("output_index"))).alias("outputs"),
            "source", "ingest_time"))

    text = F.when(F.pmod("seq", F.lit(101)) == 0, body(F.col("timestamp").cast("string"))) \
        .otherwise(body(F.col("timestamp")))
    value = F.when(F.pmod("seq", F.lit(97)) == 0, F.substring(text, 1, 25)).otherwise(text)
    return tx.select(value.alias("value"), "arrival_ms", F.col("seq").alias("offset"))


def archive_incremental(spark, sf):
    """K10 in two writes, split by height and record: the second keeps the
    heights it does not have and replaces those it has."""
    blocks = _blocks(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/archive-{uuid.uuid4().hex}"
    half = blocks.agg(F.max("offset")).first()[0] // 2
    for part in (blocks.filter(F.col("offset") <= half), blocks.filter(F.col("offset") > half)):
        write_archive(archive_blocks(part)[0], path)
    return read_archive(spark, path).select("height", "object_key", "offset", F.length("raw").alias("n_chars"))


def table_rerun(spark, sf):
    """K4-K8: a batch run over part of the input, then one over all of it, into the
    same folder: every table holds the second run's rows, once."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/rerun-{uuid.uuid4().hex}"
    tx = fx_b_table(spark, sf)
    for part in (tx.filter(F.pmod("seq", F.lit(3)) != 0), tx):
        batch_job(part, out, FXB_OPTIONS)

    def rows(name, key, amount):
        return read_live(spark, f"{out}/{name}").select(F.lit(name).alias("name"), F.col(key).alias("key"), F.col(amount).cast("double").alias("amount"))

    return (rows("transactions", "tx_id", "total_output").unionByName(rows("alerts", "alert_id", "timestamp_ms"))
            .unionByName(rows("balance_updates", "address", "balance")).unionByName(rows("latest_balances", "address", "balance"))
            .unionByName(rows("metrics", "tx_id", "timestamp_ms")))


def archive_packed(spark, sf):
    """K10 packed: three writes by record, the parts merged, then a range of
    heights read."""
    blocks = _blocks(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/packed-{uuid.uuid4().hex}"
    third = max(1, -(-blocks.agg(F.max("offset")).first()[0] // 3))
    for k in range(3):
        part = blocks.filter((F.col("offset") > k * third - (k == 0)) & (F.col("offset") <= (k + 1) * third))
        write_packed_archive(archive_blocks(part)[0], path)
    merge_packed(spark, path, fanout=2)
    return read_packed_archive(spark, path, 10, 89).select("height", "object_key", "offset", F.length("raw").alias("n_chars"))


def parse_transactions_q(spark, sf):
    tx, _bad = parse_transactions(_raw_json_b(spark, sf))
    return transactions.tx_metrics(tx)


def quarantine(spark, sf):
    _tx, bad = parse_transactions(_raw_json_b(spark, sf))
    return bad.select("offset", "reason")


def _bad_json(spark, sf) -> DataFrame:
    """FX-B as JSON text; of every 13 records, five are wrong in a way of their own."""
    way = F.pmod("seq", F.lit(13))
    amount = F.when(way == 1, "abc").when(way == 2, "1e30")
    outputs = F.transform("outputs", lambda y: F.struct(
        y["address"].alias("address"), F.coalesce(amount, y["value"].cast("string")).alias("value"),
        F.when(way == 3, "3000000000").otherwise(y["output_index"].cast("string")).alias("output_index")))
    inputs = F.transform("inputs", lambda x: F.struct(
        x["address"].alias("address"), x["value"].cast("string").alias("value"), x["prev_tx_id"].alias("prev_tx_id"),
        x["prev_output_index"].alias("prev_output_index")))
    body = F.to_json(F.struct(
        "tx_id", F.when(way == 5, "soon").otherwise(F.col("timestamp").cast("string")).alias("timestamp"), inputs.alias("inputs"),
        F.when(way != 4, outputs).alias("outputs"), "source", "ingest_time"))
    return fx_b_table(spark, sf).select(body.alias("value"), "arrival_ms", F.col("seq").alias("offset"))


def quarantine_values(spark, sf):
    """Records with a wrong amount, index, time or without outputs."""
    return parse_transactions(_bad_json(spark, sf))[1].select("offset", "reason")


def job_quarantine(spark, sf):
    """S2/S3 as the jobs use it: JSON files -> accepted records and the written
    quarantine table, counted by reason (every record is in one of them)."""
    run = f"{checkpoint_dir(spark).rstrip('/')}/quarantine-{uuid.uuid4().hex}"
    _bad_json(spark, sf).select("value").write.text(f"{run}/in")
    tx, rejected = read_with_quarantine(spark, "json", path=f"{run}/in")
    write_quarantine(rejected, f"{run}/quarantine")
    found = spark.read.parquet(f"{run}/quarantine").select("reason").unionByName(tx.select(F.lit("accepted").alias("reason")))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_transactions": normalize_transactions,
    "tx_metrics": tx_metrics,
    "tx_rows": tx_rows,
    "address_updates": address_updates,
    "alerts_fan_out": alerts_fan_out,
    "alerts_whale": alerts_whale,
    "metrics_table": metrics_table,
    "utxo_snapshot": utxo_snapshot,
    "pending_spends": pending_spends,
    "pending_spends_double": pending_spends_double,
    "balance_updates": balance_updates,
    "balance_updates_double": balance_updates_double,
    "latest_balance": latest_balance,
    "balance_updates_hot": balance_updates_hot,
    "alerts_activity_hot": alerts_activity_hot,
    "alerts_velocity": alerts_velocity,
    "alerts_structuring": alerts_structuring,
    "alerts_late": alerts_late,
    "alerts_all": alerts_all,
    "tps_last_minute": tps_last_minute,
    "tps_last_day": tps_last_day,
    "alerts_last_hour": alerts_last_hour,
    "tx_volume_per_minute": tx_volume_per_minute,
    "tx_volume_last_day": tx_volume_last_day,
    "top_addresses": top_addresses,
    "balance_distribution": balance_distribution,
    "balance_histogram": balance_histogram,
    "alert_rates": alert_rates,
    "alert_rates_last_day": alert_rates_last_day,
    "balance_updates_final": balance_updates_final,
    "coin_selection": coin_selection,
    "coin_selection_dust": coin_selection_dust,
    "coin_selection_exact": coin_selection_exact,
    "balance_updates_large": balance_updates_large,
    "balance_updates_ties": balance_updates_ties,
    "balance_updates_burst": balance_updates_burst,
    "pattern_mix": pattern_mix,
    "pattern_scan": pattern_scan,
    "pattern_scan_pages": pattern_scan_pages,
    "archive_blocks": archive,
    "archive_rejected": archive_rejected,
    "parse_transactions": parse_transactions_q,
    "quarantine": quarantine,
    "quarantine_values": quarantine_values,
    "job_quarantine": job_quarantine,
    "archive_incremental": archive_incremental,
    "table_rerun": table_rerun,
    "archive_packed": archive_packed,
}


def _register_streams() -> None:
    from utxoflow.plans.stream_queries import STREAM_QUERIES

    QUERIES.update(STREAM_QUERIES)


_register_streams()

