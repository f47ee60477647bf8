"""Job entry points: the reference's streaming job, and its batch twin, on
Spark.  ``python -m utxoflow batch|stream ...`` (see ``__main__.py``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from utxoflow.operators.ledger import balance_records, balance_rows, ledger_state
from utxoflow.operators.transactions import dedupe_transactions, metric_rows, normalize, tx_metrics, tx_rows
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.plans.batch import run_batch
from utxoflow.session import staged
from utxoflow.sinks import alerts_topic, compact_table, encode_kafka, merge_latest, metrics_topic, replace_table
from utxoflow.sinks.topics import TopicLog, kafka_record
from utxoflow.sinks.versions import file_names, read_live
from utxoflow.streaming.stream import (start_activity_query, start_addr_query, start_quarantine_query, start_split_query,
                                       start_tx_query)


def batch_job(tx: DataFrame, out: str, opts: LedgerOptions = DEFAULT, rejected: DataFrame | None = None,
              dedupe: bool = True, topics=None) -> dict[str, str]:
    """Canonical transactions -> the four analytic tables + latest balances, and
    the quarantine table of records that could not be decoded.  Re-delivered
    transactions count once (``dedupe``); ``topics(name, frame, None)`` gets
    the records of the ``metrics`` and ``alerts`` topics.

    Every table of ``out`` is replaced by this run's rows (``replace_table``), so
    a rerun leaves one run's rows; read them with ``read_live(spark, out + "/" +
    name)``.  Returns the folders this run wrote."""
    # Read three times for the watermark (sampled, dealt, joined): deduplicated once.
    res = run_batch(staged(dedupe_transactions(tx), "deduped") if dedupe else tx, opts, materialize=True)
    gran = opts.table_partition

    def table(name: str, frame: DataFrame, *sort_cols: str, time_col: str = "timestamp_ms", rows=None) -> None:
        paths[name] = replace_table(frame, f"{out}/{name}", time_col=time_col if sort_cols else None, sort_cols=sort_cols,
                                    granularity=gran, rows=rows)

    paths: dict[str, str] = {}
    table("transactions", res.transactions, "timestamp", "tx_id", time_col="timestamp", rows=tx_rows)
    table("metrics", res.metrics, "timestamp", "metric_type", "tx_id", time_col="timestamp", rows=metric_rows)
    table("alerts", res.alerts, "timestamp_ms", "alert_id")
    table("balance_updates", balance_rows(res.ledger), "address", "timestamp_ms")
    table("latest_balances", res.latest)
    # The final ledger state, from which a stream can continue (stream_job).
    table("ledger_state", ledger_state(res.updates, opts, res.ledger))
    if rejected is not None:
        table("quarantine", rejected)
    if topics is not None:
        metrics = tx_metrics(res.transactions, keep=("seq",))
        topics("metrics", metrics_topic(metrics, balance_records(res.ledger, keep=("seq", "pos"))), None)
        topics("alerts", alerts_topic(res.alert_records), None)
    return paths


def kafka_topics(servers: str, names: dict[str, str]):
    """Topic callback that publishes to Kafka (``names``: metrics, alerts)."""
    def publish(name: str, frame: DataFrame, batch_id: int | None) -> None:
        (kafka_record(frame).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", names[name])
         .option("includeHeaders", "true").save())
    return publish


def file_topics(path: str):
    """Topic callback that writes JSON lines below ``path/name`` (for tests and
    replays; a micro-batch owns a folder)."""
    def publish(name: str, frame: DataFrame, batch_id: int | None) -> None:
        frame.write.mode("overwrite").json(f"{path}/{name}/batch_id={-1 if batch_id is None else int(batch_id)}")
    return publish


def publish_job(events: DataFrame, write) -> None:
    """K1: raw events -> normalize -> (key ``tx_id``, JSON value) records, given
    to ``write(frame)``; ``encode_kafka`` makes the records."""
    tx = normalize(events)
    write(encode_kafka(tx.select("tx_id", "timestamp", "inputs", "outputs", "source", "ingest_time"), "tx_id"))


def stream_job(spark: SparkSession, tx: DataFrame, out: str, checkpoint: str,
               opts: LedgerOptions = DEFAULT, trigger_ms: int | None = None,
               initial_state: str | None = None, rejected: DataFrame | None = None, topics=None, topic_log: str | None = None,
               split: bool = False, dedupe: bool = True):
    """Q-tx and Q-addr on one streaming source, and the quarantine query when
    the source has ``rejected`` records; returns the queries.
    ``initial_state``: the ``ledger_state`` table of a ``batch_job``
    (used on the first start; later starts resume from the checkpoint).
    ``topic_log``: a folder that names the deliveries that count, for consumers
    that read every record exactly once (``sinks.topics``).  ``split``: the ledger
    in two stages, for addresses too hot for one task.  Re-delivered transactions
    count once (``dedupe``), as in ``batch_job``."""
    opts = opts.with_(dedupe_stream=dedupe)
    trigger = {"processingTime": f"{int(trigger_ms)} milliseconds"} if trigger_ms else None
    init = read_live(spark, initial_state) if initial_state else None
    of_tx = of_addr = topics
    if topics is not None and topic_log is not None:
        log = TopicLog(spark, topic_log)
        of_tx, of_addr = log.exactly_once("q_tx", topics), log.exactly_once("q_addr", topics)
    queries = (start_tx_query(tx, out, checkpoint, opts, trigger=trigger, topics=of_tx),)
    if split:
        of_activity = log.exactly_once("q_activity", topics) if topics is not None and topic_log is not None else topics
        queries += (start_split_query(tx, out, checkpoint, opts, trigger=trigger, initial=init, topics=of_addr),
                    start_activity_query(tx, out, checkpoint, opts, trigger=trigger, initial=init, topics=of_activity))
    else:
        queries += (start_addr_query(tx, out, checkpoint, opts, trigger=trigger, initial=init, topics=of_addr),)
    if rejected is not None:
        queries += (start_quarantine_query(rejected, out, checkpoint, opts, trigger=trigger),)
    return queries


def compact_job(spark: SparkSession, out: str, fanout: int = 8, keep: int = 2) -> dict[str, int]:
    """Merge the micro-batch folders of every table that a ``stream_job`` writes
    below ``out``, while it runs or not; returns the merges by table."""
    there = set(file_names(spark, out))
    merges = {n: compact_table(spark, f"{out}/{n}", fanout=fanout, keep=keep)
              for n in ("transactions", "metrics", "alerts", "alerts_tx", "balance_updates") if n in there}
    if "latest_changes" in there:
        merges["latest_changes"] = merge_latest(spark, f"{out}/latest_changes", fanout, keep)
    return merges
