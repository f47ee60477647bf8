"""Streaming forms of the ledger and the volume panel, run to completion over
FX-B delivered in batches of files (arrival order, a batch of ``delivery_files`` per
trigger).

Each query writes its fixture files, checkpoints and output tables under the
session's shared checkpoint folder and returns the written table as a batch
DataFrame, so it can be compared with the batch oracle.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.operators.transactions import tx_metrics
from utxoflow.plans.fixtures import FXA_OPTIONS, FXB_HOT_OPTIONS, FXB_OPTIONS
from utxoflow.plans.tables import fx_a_table, fx_b_table, materialized
from utxoflow.session import checkpoint_dir, staged
from utxoflow.sinks import compact_table, merge_latest, read_latest, write_packed_archive
from utxoflow.sinks.topics import TopicLog
from utxoflow.sinks.versions import file_names, hadoop_path, read_live
from utxoflow.sources import read_with_quarantine
from utxoflow.streaming.stream import (drain, read_alert_rates, read_state_pending, read_state_utxos,
                                         read_transaction_files, read_volume,
                                         start_activity_query, start_addr_query, start_split_query, start_tx_query,
                                         start_volume_query)
from utxoflow.streaming.two_stage import read_entries

STREAM_BATCHES = 4
#: Files of a delivery batch at least; as many tasks write and read it.
FILES = 4
# State partitions are the session's shuffle partitions.
FXB_STREAM = FXB_OPTIONS
# FX-A replays seven years of orders as a stream: monthly table partitions.
FXA_STREAM = FXA_OPTIONS.with_(table_partition="month")
TRIGGER = {"availableNow": True}
ALERT = ["alert_id", "alert_type", "severity", "timestamp_ms", "tx_id", "address", "details_json"]


def stream_batches(tx: DataFrame, batches: int = STREAM_BATCHES) -> DataFrame:
    """``tx`` with its delivery batch ``_b``: equal time ranges of the arrival,
    at least ``batches`` of them and one per million rows."""
    lo, hi, n = tx.agg(F.min("arrival_ms"), F.max("arrival_ms"), F.count(F.lit(1))).first()
    k = max(batches, -(-n // 1_000_000))
    width = max(1, -(-((hi or 0) - (lo or 0) + 1) // k))
    return tx.withColumn("_b", F.floor((F.col("arrival_ms") - F.lit(lo or 0)) / F.lit(width)).cast("int"))


def delivery_files(spark: SparkSession) -> int:
    """Files of a delivery batch: one per task that the cluster runs at a time."""
    return max(FILES, spark.sparkContext.defaultParallelism)


def stream_fixture(spark: SparkSession, sf_dir: str, batches: int = STREAM_BATCHES,
                   tx: DataFrame | None = None, files: int = 1) -> str:
    """Write canonical transactions (FX-B by default, or rows with their ``_b``)
    as ``files`` files per delivery batch, all in one job; return the run folder.
    A file source takes files by their time, so the files of a batch get the
    batch's number as time, and a batch with fewer files gets empty ones."""
    run = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    tx = fx_b_table(spark, sf_dir) if tx is None else tx
    rows = tx if "_b" in tx.columns else stream_batches(tx, batches)
    dealt = rows.withColumn("_f", F.pmod(F.xxhash64("tx_id"), F.lit(files)).cast("int")).repartition("_b", "_f")
    dealt.write.option("maxRecordsPerFile", 0).partitionBy("_b", "_f").parquet(f"{run}/input")
    there = {tuple(r) for r in spark.read.parquet(f"{run}/input").select("_b", "_f").distinct().collect()}  # batches x files
    for b in sorted({b for b, _ in there}):
        for f in range(files):
            folder = f"{run}/input/_b={b}/_f={f}"
            if (b, f) not in there:
                spark.createDataFrame([], rows.drop("_b").schema).coalesce(1).write.parquet(folder)
            fs, path = hadoop_path(spark, folder)
            for x in fs.listStatus(path):
                if x.getPath().getName().endswith(".parquet"):
                    fs.setTimes(x.getPath(), 1_600_000_000_000 + 1000 * (b * files + f), -1)
    return run


def transaction_batches(spark: SparkSession, run: str) -> DataFrame:
    """The fixture as a stream, one delivery batch per trigger."""
    of_batch = next(n for n in file_names(spark, f"{run}/input") if n.startswith("_b="))
    files = sum(n.startswith("_f=") for n in file_names(spark, f"{run}/input/{of_batch}"))
    return read_transaction_files(spark, f"{run}/input", files)


def _run_addr(spark: SparkSession, sf_dir: str, variant: str | None = None) -> str:
    """Q-addr over FX-B, run once per application and variant."""
    def build(folder: str) -> None:
        run = stream_fixture(spark, sf_dir, tx=fx_b_table(spark, sf_dir, variant), files=delivery_files(spark))
        drain(start_addr_query(transaction_batches(spark, run), f"{folder}/out", f"{folder}/ckpt", FXB_STREAM,
                               trigger=TRIGGER))

    return materialized(spark, ("stream-addr", sf_dir, variant or "base"), build)


def _balances(table: DataFrame) -> DataFrame:
    return table.select(F.lit("balance_update").alias("metric_type"), "address", "tx_id", "kind",
                        "balance", "utxo_count", "timestamp_ms", "source")


def stream_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run_addr(spark, sf_dir)
    return _balances(read_live(spark, f"{run}/out/balance_updates"))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All state alerts of the stream; late ones meet the watermark of their
    micro-batch."""
    run = _run_addr(spark, sf_dir)
    return read_live(spark, f"{run}/out/alerts").select(*ALERT)


def stream_late_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 in streaming form."""
    return stream_alerts(spark, sf_dir).filter(F.col("alert_type") == "late_event")


def stream_dedupe_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-addr with every seventh transaction delivered again one batch later
    and re-deliveries dropped: balances as if each came once, late ones too."""
    def build(folder: str) -> None:
        tx = stream_batches(fx_b_table(spark, sf_dir))
        again = tx.filter(F.pmod("seq", F.lit(7)) == 0).withColumn("_b", F.col("_b") + 1)
        run = stream_fixture(spark, sf_dir, tx=tx.unionByName(again), files=delivery_files(spark))
        drain(start_addr_query(transaction_batches(spark, run), f"{folder}/out", f"{folder}/ckpt",
                               FXB_STREAM.with_(dedupe_stream=True), trigger=TRIGGER))

    run = materialized(spark, ("stream-dedupe", sf_dir), build)
    return _balances(spark.read.parquet(f"{run}/out/balance_updates"))


def stream_tx_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = stream_fixture(spark, sf_dir, files=delivery_files(spark))
    q = start_volume_query(transaction_batches(spark, run), f"{run}/out", f"{run}/ckpt",
                           trigger=TRIGGER, opts=FXB_STREAM)
    drain(q)
    return read_volume(spark, f"{run}/out", f"{run}/ckpt")


def stream_tx_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-tx over FX-B: the transactions table with the lateness each row had in
    its micro-batch."""
    run = stream_fixture(spark, sf_dir, files=delivery_files(spark))
    drain(start_tx_query(transaction_batches(spark, run), f"{run}/out", f"{run}/ckpt", FXB_STREAM, trigger=TRIGGER))
    return spark.read.parquet(f"{run}/out/transactions").select(
        "tx_id", "timestamp_ms", "ingest_time_ms", "source", "input_count", "output_count", "total_input", "total_output", "is_late")


def stream_tx_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-tx over FX-A delivered as files: the fan-out and whale alerts it
    writes (stateless, so identical to the batch rules)."""
    run = stream_fixture(spark, sf_dir, tx=fx_a_table(spark, sf_dir), files=delivery_files(spark))
    q = start_tx_query(transaction_batches(spark, run), f"{run}/out", f"{run}/ckpt",
                       FXA_STREAM, trigger=TRIGGER)
    drain(q)
    return spark.read.parquet(f"{run}/out/alerts_tx").select(*ALERT)


def stream_alert_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 from the stream's per-batch partial counts."""
    return read_alert_rates(spark, f"{_run_addr(spark, sf_dir)}/out")


def stream_utxo_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 in streaming form: the unspent set read from the query's state."""
    return read_state_utxos(spark, f"{_run_addr(spark, sf_dir)}/ckpt")


def stream_pending_spends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 in streaming form over FX-B-double (double spends), from the state."""
    return read_state_pending(spark, f"{_run_addr(spark, sf_dir, 'double')}/ckpt")


def stream_latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 in streaming form: the latest-balance change log read back."""
    return read_latest(spark, f"{_run_addr(spark, sf_dir)}/out/latest_changes")


# ------------------------------------------------ two stages, hot address

def _run_split(spark: SparkSession, sf_dir: str, variant: str) -> str:
    """The two-stage ledger over an FX-B variant, once per application."""
    def build(folder: str) -> None:
        run = stream_fixture(spark, sf_dir, tx=fx_b_table(spark, sf_dir, variant), files=delivery_files(spark))
        drain(start_split_query(transaction_batches(spark, run), f"{folder}/out", f"{folder}/ckpt", FXB_HOT_OPTIONS, trigger=TRIGGER))

    return materialized(spark, ("stream-split", sf_dir, variant), build)


def stream_balances_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4, L1-L6 on FX-B-hot: one address holds a third of the rows; its outpoints
    are spread over slots, its sums taken in pieces."""
    return _balances(read_live(spark, f"{_run_split(spark, sf_dir, 'hot')}/out/balance_updates"))


def stream_balances_split_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-stage ledger with double spends."""
    return _balances(read_live(spark, f"{_run_split(spark, sf_dir, 'double')}/out/balance_updates"))


def stream_pending_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L8 from the two-stage ledger's state."""
    entries = read_entries(spark, f"{_run_split(spark, sf_dir, 'double')}/ckpt/q_split")
    return entries.filter("pending").select("address", F.col("tx_id").alias("prev_tx_id"), F.col("output_index").alias("prev_output_index"))


def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engine's watermark that every update met in the stateful step."""
    return read_live(spark, f"{_run_split(spark, sf_dir, 'hot')}/out/balance_updates").select("address", "tx_id", "kind", "watermark_ms")


def stream_activity_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/A4 as a stream of their own, on FX-B-hot."""
    def build(folder: str) -> None:
        run = stream_fixture(spark, sf_dir, tx=fx_b_table(spark, sf_dir, "hot"), files=delivery_files(spark))
        drain(start_activity_query(transaction_batches(spark, run), f"{folder}/out", f"{folder}/ckpt", FXB_HOT_OPTIONS, trigger=TRIGGER))

    run = materialized(spark, ("stream-activity", sf_dir), build)
    return read_live(spark, f"{run}/out/alerts_activity").select(*ALERT)


# ------------------------------------------------ topics, versions

def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K3: two deliveries die after they published a batch and are replayed;
    what the log's reader sees equals a single delivery."""
    def build(folder: str) -> None:
        run = stream_fixture(spark, sf_dir, files=delivery_files(spark))
        log = TopicLog(spark, f"{folder}/log")
        deaths = {(1, "metrics"), (2, "alerts")}

        def publish(topic: str, records: DataFrame, batch_id: int) -> None:
            records.write.mode("append").json(f"{folder}/topics/{topic}")
            if (batch_id, topic) in deaths:
                deaths.remove((batch_id, topic))
                raise RuntimeError("killed after publishing")

        for _ in range(3):
            try:
                drain(start_addr_query(transaction_batches(spark, run), f"{folder}/out", f"{folder}/ckpt", FXB_STREAM, trigger=TRIGGER,
                                       topics=log.exactly_once("q_addr", publish)))
            except StreamingQueryException as e:
                if "killed after publishing" not in str(e):
                    raise

    folder = materialized(spark, ("topic-replay", sf_dir), build)
    log = TopicLog(spark, f"{folder}/log")

    def records(topic: str, fields: str) -> DataFrame:
        schema = "key string, value string, occurrence string, origin struct<query: string, batch_id: bigint, delivery: string>"
        seen = spark.read.schema(schema).json(f"{folder}/topics/{topic}")
        return log.committed(topic, seen).select(F.lit(topic).alias("topic"), F.col("key").alias("record_key"), F.from_json("value", fields).alias("v"))

    balances = records("metrics", "tx_id string, kind string, balance double")
    alerts = records("alerts", "tx_id string, alert_type string, timestamp_ms bigint")
    return balances.select("topic", "record_key", "v.tx_id", F.col("v.kind").alias("what"), F.col("v.balance").alias("amount")).unionByName(
        alerts.select("topic", "record_key", "v.tx_id", F.col("v.alert_type").alias("what"), F.col("v.timestamp_ms").cast("double").alias("amount")))


def table_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/K8: the balance table of a stream after its micro-batch folders were
    merged."""
    path = f"{_run_addr(spark, sf_dir)}/out/balance_updates"
    compact_table(spark, path, fanout=2)
    return _balances(read_live(spark, path))


def latest_balance_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: the balances as they were after micro-batch 1, though the change log
    has been merged since."""
    path = f"{_run_addr(spark, sf_dir)}/out/latest_changes"
    merge_latest(spark, path, fanout=2, keep=1000)
    return read_latest(spark, path, as_of_batch=1)


def block_archive(tx: DataFrame, size: int = 50) -> DataFrame:
    """Transactions as blocks of ``size`` offsets: height, key, offset, raw JSON."""
    body = F.to_json(F.struct(
        "tx_id", "timestamp",
        F.transform("inputs", lambda x: x.withField("value", x["value"].cast("string"))).alias("inputs"),
        F.transform("outputs", lambda y: y.withField("value", y["value"].cast("string"))).alias("outputs"), "source", "ingest_time"))
    height = F.floor(F.col("seq") / size).cast("long")
    packed = tx.groupBy(height.alias("h")).agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", body.alias("body")))),
                                                           lambda x: x["body"]).alias("transactions"))  # at most ``size`` a block
    raw = F.to_json(F.struct(F.col("h").alias("height"), "transactions"))
    return packed.select(F.col("h").cast("string").alias("height"), F.concat(F.col("h").cast("string"), F.lit(".json")).alias("object_key"),
                         F.col("h").alias("offset"), raw.alias("raw"))


def source_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block archive as a stream source.  Half of the blocks, a run; the
    other half, a run that goes on from the offset of the first."""
    def build(folder: str) -> None:
        archive = staged(block_archive(fx_b_table(spark, sf_dir)), "blocks")
        middle = (archive.agg(F.max("offset")).first()[0] or 0) // 2
        for part in (F.col("offset") <= middle, F.col("offset") > middle):
            write_packed_archive(archive.filter(part), f"{folder}/archive")
            tx, _ = read_with_quarantine(spark, "blocks", streaming=True, path=f"{folder}/archive")
            query = tx.writeStream.format("parquet").option("path", f"{folder}/tx").option("checkpointLocation", f"{folder}/ckpt")
            drain(query.trigger(**TRIGGER).start())

    return tx_metrics(spark.read.parquet(f"{materialized(spark, ('source-blocks', sf_dir), build)}/tx"))


STREAM_QUERIES = {
    "source_blocks": source_blocks,
    "stream_balances_hot": stream_balances_hot,
    "stream_balances_split_double": stream_balances_split_double,
    "stream_pending_split": stream_pending_split,
    "stream_watermark": stream_watermark,
    "stream_activity_hot": stream_activity_hot,
    "topic_replay": topic_replay,
    "table_compacted": table_compacted,
    "latest_balance_as_of": latest_balance_as_of,
    "stream_latest_balance": stream_latest_balance,
    "stream_tx_alerts": stream_tx_alerts,
    "stream_alert_rates": stream_alert_rates,
    "stream_utxo_snapshot": stream_utxo_snapshot,
    "stream_pending_spends": stream_pending_spends,
    "stream_balances": stream_balances,
    "stream_alerts": stream_alerts,
    "stream_tx_volume": stream_tx_volume,
    "stream_tx_rows": stream_tx_rows,
    "stream_late_alerts": stream_late_alerts,
    "stream_dedupe_late": stream_dedupe_late,
}
