"""Structured Streaming jobs.

* **Q-tx** (stateless): per micro-batch, the ``transactions`` and ``metrics``
  tables and the fan-out / whale alerts, written idempotently (K8).
* **Q-addr** (stateful): explode -> ``groupBy(slot of the address)`` ->
  ``transformWithStateInPandas(LedgerProcessor)`` -> ``foreachBatch`` that
  splits balance records and alerts (P10) into their tables and raises the
  late alerts of the micro-batch.
* **Q-volume**: transactions per minute as a windowed aggregation whose state holds
  the open windows only; late rows are still counted (``volume``).

Sources are any streaming canonical frame (Kafka via ``read_transactions``,
or files).  Checkpoints live in the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from utxoflow.functions import ms_to_minute
from utxoflow.operators.activity import late_alerts
from utxoflow.operators.alerts import tx_alerts
from utxoflow.operators.transactions import metric_rows, tx_metrics, tx_rows
from utxoflow.operators.updates import address_updates
from utxoflow.operators.watermark import with_watermark
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.schema import TRANSACTION
from utxoflow.session import scratch
from utxoflow.sinks import (PLACE, alerts_topic, archive_blocks, balance_topic, tx_records, write_archive, write_latest_changes,
                            write_quarantine, write_table)
from utxoflow.sinks.versions import VersionedTable, read_live
from utxoflow.streaming.paged import unpack_entries
from utxoflow.streaming.processor import OUTPUT_SCHEMA, ActivityProcessor, LedgerProcessor
from utxoflow.streaming.two_stage import address_slot, balances_of, change_stream, entry_rows
from utxoflow.streaming.volume import open_windows, volume_stream

UPDATE_INPUT = ["address", "tx_id", "timestamp", "kind", "pos", "ref_tx", "ref_idx", "source", "arrival_ms", "seq"]
UNITS = 100_000_000  # money in exact integer units of 1e-8 inside the processor


def to_units(col):
    return (col * F.lit(UNITS)).cast("long")


def from_units(col):
    """Exact: decimal(28,8) / 10^8 has an exact decimal(38,18) result."""
    return (col.cast("decimal(28,8)") / F.lit(UNITS)).cast("decimal(28,8)")


def read_transaction_files(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Canonical transactions from Parquet files arriving in ``path``."""
    return (spark.readStream.schema(TRANSACTION)
                 .option("maxFilesPerTrigger", max_files)
                 .parquet(path))


def with_event_watermark(tx: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """``event_time`` from the epoch-ms timestamp + Spark's watermark."""
    return with_watermark(tx.withColumn("event_time", F.timestamp_millis("timestamp")), opts.late_tolerance_ms)


def first_deliveries(tx: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """With ``dedupe_stream``, the first delivery of every ``tx_id``.  No
    watermark is set before it, so late transactions are kept (W3); its state
    holds one key per id, in RocksDB."""
    return tx.dropDuplicates(["tx_id"]) if opts.dedupe_stream else tx


def ledger_stream(tx: DataFrame, opts: LedgerOptions = DEFAULT, initial: DataFrame | None = None,
                  processor: LedgerProcessor | None = None) -> DataFrame:
    """L1-L6 + A3-A5 on a (watermarked) stream of canonical transactions;
    ``initial`` (``ledger.ledger_state`` of a batch backfill) seeds the state."""
    small = (F.col("kind") == "output") & (F.col("value") <= F.lit(str(opts.structuring_ceiling)).cast("decimal(38,8)"))
    slot = address_slot("address", opts.address_slots).alias("slot")
    upd = address_updates(tx).select(slot, *UPDATE_INPUT, to_units(F.col("value")).alias("units"), small.alias("small"))
    init = initial.withColumn("slot", slot).groupBy("slot") if initial is not None else None
    return (upd.groupBy("slot")
               .transformWithStateInPandas(statefulProcessor=processor or LedgerProcessor(opts),
                                           outputStructType=OUTPUT_SCHEMA,
                                           outputMode="Append", timeMode="None",
                                           initialState=init))


def split_output(out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P10: route the processor's tagged output into balances and alerts."""
    balances = out.filter(F.col("kind") == "balance").select(
        "address", "timestamp_ms", "source", from_units(F.col("balance_units")).cast("double").alias("balance"),
        "utxo_count", "tx_id",
        F.col("update_kind").alias("kind"), "arrival_ms", "seq", "pos")
    alerts = out.filter(F.col("kind") == "alert").select(
        "alert_id", "alert_type", "severity", "timestamp_ms", "tx_id", "address", "details_json", "seq", "pos")
    return balances, alerts


def _entries(spark: SparkSession, path: str):
    """(file system, Hadoop path, batch ids of the ``batch_id=N`` folders)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
    return fs, root, sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def batch_watermark(batch: DataFrame, batch_id: int, path: str, opts: LedgerOptions, column: str) -> int | None:
    """The watermark a micro-batch meets: max event time of all batches before
    it minus the tolerance (W2 at the granularity of a stream).  The running
    max is kept per batch below ``path``; a replayed batch finds the same one.
    The last few entries stay, older ones are removed."""
    spark = batch.sparkSession
    fs, root, ids = _entries(spark, path)
    earlier = [i for i in ids if i < batch_id]
    before = spark.read.parquet(f"{path}/batch_id={earlier[-1]}").first()[0] if earlier else None
    own = batch.agg(F.max(column).alias("max_ts")).first()[0]
    now = max((x for x in (before, own) if x is not None), default=None)
    if now is not None:
        spark.createDataFrame([(now,)], "max_ts bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    for old in earlier[:-8]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"batch_id={old}"), True)
    return None if before is None else before - int(opts.late_tolerance_ms)


def _publish(topics, name: str, frame: DataFrame, batch_id: int) -> None:
    if topics is not None:
        topics(name, frame, batch_id)


def _addr_writer(out_path: str, opts: LedgerOptions, topics=None):
    gran = opts.table_partition

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():  # nothing arrived: leave no folders
                return
            balances, alerts = split_output(batch)
            mark = batch_watermark(balances, batch_id, f"{out_path}/watermark_addr", opts, "timestamp_ms")
            late = late_alerts(balances.withColumnRenamed("timestamp_ms", "timestamp")
                               .withColumn("watermark_ms", F.lit(mark).cast("long")), keep=("seq", "pos"))
            records = alerts.unionByName(late)
            alerts = records.drop("seq", "pos")
            write_table(balances, f"{out_path}/balance_updates", batch_id=batch_id, granularity=gran)
            write_table(alerts, f"{out_path}/alerts", batch_id=batch_id, granularity=gran)
            write_latest_changes(balances, f"{out_path}/latest_changes", batch_id)
            write_alert_counts(alerts, f"{out_path}/alert_counts", batch_id)
            _publish(topics, "metrics", balance_topic(balance_values(balances)), batch_id)
            _publish(topics, "alerts", alerts_topic(records), batch_id)
        finally:
            batch.unpersist()
    return write


def _split_writer(out_path: str, opts: LedgerOptions, topics=None):
    gran = opts.table_partition

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            path = f"{out_path}/balance_updates"
            with scratch(batch.sparkSession):  # the pieces of hot addresses
                rows = balances_of(batch, opts)
                write_table(rows, path, batch_id=batch_id, granularity=gran)
            balances = batch.sparkSession.read.schema(rows.schema).parquet(f"{path}/batch_id={int(batch_id)}")
            late = late_alerts(balances.withColumnRenamed("timestamp_ms", "timestamp"), keep=PLACE)
            write_table(late.drop(*PLACE), f"{out_path}/alerts", batch_id=batch_id, granularity=gran)
            write_latest_changes(balances, f"{out_path}/latest_changes", batch_id)
            _publish(topics, "metrics", balance_topic(balance_values(balances)), batch_id)
            _publish(topics, "alerts", alerts_topic(late), batch_id)
        finally:
            batch.unpersist()
    return write


def _activity_writer(out_path: str, opts: LedgerOptions, topics=None):
    gran = opts.table_partition

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            records = split_output(batch)[1]
            write_table(records.drop(*PLACE), f"{out_path}/alerts_activity", batch_id=batch_id, granularity=gran)
            _publish(topics, "alerts", alerts_topic(records), batch_id)
        finally:
            batch.unpersist()
    return write


def balance_values(balances: DataFrame) -> DataFrame:
    """Balance records as the metrics topic carries them."""
    return balances.select(F.lit("balance_update").alias("metric_type"), "address", "tx_id", "kind", "balance", "utxo_count",
                           F.col("timestamp_ms").alias("timestamp"), "source", "seq", "pos")


def _tx_writer(out_path: str, opts: LedgerOptions, topics=None):
    gran = opts.table_partition

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            mark = batch_watermark(batch, batch_id, f"{out_path}/watermark_tx", opts, "timestamp")
            stamped = batch.withColumn("watermark_ms", F.lit(mark).cast("long"))
            metrics, alerts = tx_metrics(stamped), tx_alerts(stamped, opts)
            write_table(stamped, f"{out_path}/transactions", batch_id=batch_id, time_col="timestamp", granularity=gran, rows=tx_rows)
            write_table(metrics, f"{out_path}/metrics", batch_id=batch_id, time_col="timestamp", granularity=gran, rows=metric_rows)
            write_table(alerts, f"{out_path}/alerts_tx", batch_id=batch_id, granularity=gran)
            _publish(topics, "metrics", tx_records(tx_metrics(stamped, keep=("seq",))), batch_id)
            _publish(topics, "alerts", alerts_topic(tx_alerts(stamped, opts, keep=("seq",))), batch_id)
        finally:
            batch.unpersist()
    return write


def _volume_writer(out_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy("minute").agg(F.sum("txs").alias("txs"))
        rows.write.mode("overwrite").parquet(f"{out_path}/tx_volume/batch_id={int(batch_id)}")
        VersionedTable(batch.sparkSession, f"{out_path}/tx_volume").add_batch(batch_id, rows.schema)
    return write


def write_alert_counts(alerts: DataFrame, path: str, batch_id: int) -> None:
    """D6 in streaming form: this batch's alerts per (minute, type), written
    as partition ``batch_id`` (a replay rewrites it); ``read_alert_rates``
    adds the partial counts up.  Work per batch is proportional to the batch."""
    counts = alerts.groupBy(ms_to_minute("timestamp_ms").alias("minute"), "alert_type").agg(F.count(F.lit(1)).alias("total"))
    counts.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    VersionedTable(alerts.sparkSession, path).add_batch(batch_id, counts.schema)


def read_alert_rates(spark: SparkSession, out_path: str) -> DataFrame:
    return (read_live(spark, f"{out_path}/alert_counts")
                 .groupBy("minute", "alert_type").agg(F.sum("total").alias("total")))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_partitions(spark: SparkSession, opts: LedgerOptions) -> int:
    """State partitions of a ledger query that is started: ``stream_partitions``, or the
    session's shuffle partitions, but no more than two per core.  Each one is a store
    that every micro-batch opens and commits, and a file per day and table, however
    few rows it has; a session's shuffle partitions follow the whole input, a
    micro-batch does not."""
    return opts.stream_partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


@contextmanager
def _partitions(spark: SparkSession, n: int):
    """Start a streaming query with ``n`` shuffle/state partitions: the query
    copies the session conf when it starts, so the session is restored after."""
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(int(n)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def use_rocksdb(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store (state on local
    disk, checkpointed incrementally); set it unless the session already does."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def start_addr_query(tx: DataFrame, out_path: str, checkpoint: str,
                     opts: LedgerOptions = DEFAULT, trigger: dict | None = None,
                     initial: DataFrame | None = None, topics=None) -> StreamingQuery:
    """``topics(name, frame, batch_id)`` gets the key/value records of the
    ``metrics`` and ``alerts`` topics of every micro-batch (K2, K3)."""
    use_rocksdb(tx.sparkSession)
    stream = ledger_stream(first_deliveries(tx, opts), opts, initial)
    w = stream.writeStream.foreachBatch(_addr_writer(out_path, opts, topics)).trigger(**(trigger or default_trigger(opts)))
    with _partitions(tx.sparkSession, state_partitions(tx.sparkSession, opts)):
        return w.option("checkpointLocation", f"{checkpoint}/q_addr").start()


def start_split_query(tx: DataFrame, out_path: str, checkpoint: str, opts: LedgerOptions = DEFAULT, trigger: dict | None = None,
                      initial: DataFrame | None = None, topics=None) -> StreamingQuery:
    """The ledger in two stages (``two_stage``): balances, latest changes and late
    alerts, no task holding an address.  The activity alerts are
    ``start_activity_query``'s."""
    use_rocksdb(tx.sparkSession)
    stream = change_stream(first_deliveries(tx, opts), opts, initial)
    w = stream.writeStream.foreachBatch(_split_writer(out_path, opts, topics)).trigger(**(trigger or default_trigger(opts)))
    with _partitions(tx.sparkSession, state_partitions(tx.sparkSession, opts)):
        return w.option("checkpointLocation", f"{checkpoint}/q_split").start()


def start_activity_query(tx: DataFrame, out_path: str, checkpoint: str, opts: LedgerOptions = DEFAULT, trigger: dict | None = None,
                         initial: DataFrame | None = None, topics=None) -> StreamingQuery:
    """A3 and A4 by themselves: per address only its rows inside the window."""
    use_rocksdb(tx.sparkSession)
    stream = ledger_stream(first_deliveries(tx, opts), opts, initial, ActivityProcessor(opts))
    w = stream.writeStream.foreachBatch(_activity_writer(out_path, opts, topics)).trigger(**(trigger or default_trigger(opts)))
    with _partitions(tx.sparkSession, state_partitions(tx.sparkSession, opts)):
        return w.option("checkpointLocation", f"{checkpoint}/q_activity").start()


def start_tx_query(tx: DataFrame, out_path: str, checkpoint: str,
                   opts: LedgerOptions = DEFAULT, trigger: dict | None = None, topics=None) -> StreamingQuery:
    if opts.dedupe_stream:
        use_rocksdb(tx.sparkSession)
    stream = with_event_watermark(first_deliveries(tx, opts), opts)
    w = stream.writeStream.foreachBatch(_tx_writer(out_path, opts, topics)).trigger(**(trigger or default_trigger(opts)))
    with _partitions(tx.sparkSession, opts.stream_partitions):
        return w.option("checkpointLocation", f"{checkpoint}/q_tx").start()


def start_quarantine_query(rejected: DataFrame, out_path: str, checkpoint: str, opts: LedgerOptions = DEFAULT,
                           trigger: dict | None = None) -> StreamingQuery:
    """Records of the source that could not be decoded, with their reason."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_quarantine(batch, f"{out_path}/quarantine", batch_id)

    w = rejected.writeStream.foreachBatch(write).trigger(**(trigger or default_trigger(opts)))
    return w.option("checkpointLocation", f"{checkpoint}/q_quarantine").start()


def start_archive_query(raw: DataFrame, out_path: str, checkpoint: str, opts: LedgerOptions = DEFAULT,
                        trigger: dict | None = None) -> StreamingQuery:
    """K10 in streaming form: every micro-batch replaces the heights it has."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                archive, rejected = archive_blocks(batch)
                write_archive(archive, f"{out_path}/archive")
                write_quarantine(rejected, f"{out_path}/archive_rejected", batch_id)
        finally:
            batch.unpersist()

    w = raw.writeStream.foreachBatch(write).trigger(**(trigger or default_trigger(opts)))
    return w.option("checkpointLocation", f"{checkpoint}/q_archive").start()


def default_trigger(opts: LedgerOptions) -> dict:
    return {"processingTime": f"{int(opts.trigger_ms)} milliseconds"}


def start_volume_query(tx: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None, partitions: int = 0,
                       opts: LedgerOptions = DEFAULT) -> StreamingQuery:
    """D3 in streaming form."""
    use_rocksdb(tx.sparkSession)
    w = volume_stream(tx, opts).writeStream.outputMode("append").foreachBatch(_volume_writer(out_path))
    w = w.trigger(**(trigger or default_trigger(opts)))
    with _partitions(tx.sparkSession, partitions):
        return w.option("checkpointLocation", f"{checkpoint}/q_volume").start()


def read_volume(spark: SparkSession, out_path: str, checkpoint: str) -> DataFrame:
    """Transactions per minute: closed windows and corrections from the table, open
    windows from the query's state.  For a query that runs, the state is that of
    its last commit."""
    closed = read_live(spark, f"{out_path}/tx_volume").select("minute", "txs")
    rows = closed.unionByName(open_windows(spark, f"{checkpoint}/q_volume"))
    return rows.groupBy("minute").agg(F.sum("txs").alias("txs"))


def _state_entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Entries of the checkpoint: the pages of the accounts, packed in ``accounts``."""
    st = spark.read.format("statestore").option("stateVarName", "accounts").load(f"{checkpoint}/q_addr")
    packed = st.filter("user_map_key.bucket >= 0").select(F.col("user_map_value.packed").alias("packed"))
    return entry_rows(packed.mapInPandas(unpack_entries, "address string, entries string"), "tx_id")


def read_state_utxos(spark: SparkSession, checkpoint: str) -> DataFrame:
    """L7 (streaming): the unspent set straight from the stateful query's
    checkpoint (state data source)."""
    return _state_entries(spark, checkpoint).filter(~F.col("pending")).select(
        "address", "tx_id", "output_index", from_units(F.col("value_units")).cast("double").alias("value"), "timestamp")


def read_state_pending(spark: SparkSession, checkpoint: str) -> DataFrame:
    """L8 (streaming): pending spends from the checkpointed state."""
    return _state_entries(spark, checkpoint).filter("pending").select(
        "address", F.col("tx_id").alias("prev_tx_id"), F.col("output_index").alias("prev_output_index"))


def drain(query: StreamingQuery, idle_s: float | None = None) -> None:
    """Wait until everything the source has is committed, then stop.

    The end is reached between batches and no commit is interrupted; with
    ``availableNow`` the query has ended by itself then.  An error of the query
    is raised, never read as its end.  There is no limit to a run that goes on;
    with ``idle_s``, one that has committed no batch for so long is an error."""
    failed: list[BaseException] = []

    def wait() -> None:
        try:
            query.processAllAvailable()
        except BaseException as e:  # noqa: BLE001 - raised below, in the caller's thread
            failed.append(e)

    waiter = threading.Thread(target=wait, daemon=True)
    try:
        waiter.start()
        seen = None
        while waiter.is_alive():
            waiter.join(idle_s)
            progress = query.lastProgress
            now = progress and (progress["runId"], progress["batchId"])
            if waiter.is_alive() and now == seen:
                raise TimeoutError(f"stream {query.name or query.id} committed no batch in {idle_s} s")
            seen = now
        if failed or query.exception() is not None:
            raise failed[0] if failed else query.exception()
    finally:
        query.stop()
