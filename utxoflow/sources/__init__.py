"""Sources (S1-S5): Kafka text, files, tables, JSON decode with quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.functions import money
from utxoflow.operators.transactions import normalize
from utxoflow.schema import RAW_TRANSACTION, TRANSACTION
from utxoflow.sources.blocks import block_transactions, read_blocks


def read_kafka_text(spark: SparkSession, servers: str, topic: str, streaming: bool = True,
                    starting_offsets: str = "earliest", **options: str) -> DataFrame:
    """Value-only UTF-8 text of a topic, with the record's arrival
    coordinates (``arrival_ms`` = Kafka timestamp, ``offset``, ``partition``).

    Needs the spark-sql-kafka package on the cluster (not in this image)."""
    reader = spark.readStream if streaming else spark.read
    df = (reader.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic)
                .option("startingOffsets", starting_offsets)
                .options(**options)
                .load())
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.unix_millis(F.col("timestamp")).alias("arrival_ms"),
        F.col("offset"), F.col("partition"),
    )


#: An offset's bits in ``seq``; the partition stands above them, so records of
#: one timestamp are ordered by (partition, offset), which is total.
OFFSET_BITS = 48


def _digits(name: str):
    """Epoch milliseconds from a number or a digit string."""
    return F.coalesce(F.expr(f"try_cast({name} AS BIGINT)"), F.expr(f"try_cast(try_cast({name} AS DOUBLE) AS BIGINT)"))


def parse_transactions(raw: DataFrame, value_col: str = "value",
                       ingest_time=None) -> tuple[DataFrame, DataFrame]:
    """S2 + P2: decode JSON text into the canonical transaction.

    Returns ``(transactions, quarantined)``; every record is in exactly one.
    Quarantined with the raw text and a reason, instead of failing the job:
    ``malformed_json`` (no JSON object, or no ``tx_id``), ``bad_timestamp``,
    ``missing_field`` (no ``inputs`` or ``outputs``), ``bad_value`` (an amount or
    output index that is missing, no number or out of range).  String digit
    timestamps are accepted.  ``arrival_ms``/``offset``/``partition`` columns of
    ``raw`` become the arrival order; without offsets, equal arrivals are
    ordered by ``tx_id`` (the last key of the ledger's order)."""
    cols = raw.columns
    j = F.from_json(F.col(value_col), RAW_TRANSACTION, {"mode": "PERMISSIVE"})
    stamped = F.expr("try_cast(j.ingest_time AS BIGINT)")
    arrival = F.coalesce(stamped, F.col("file_ms")) if "file_ms" in cols else stamped
    arrival = F.col("arrival_ms") if "arrival_ms" in cols else arrival
    seq = F.col("offset").cast("long") if "offset" in cols else F.lit(0).cast("long")
    if "offset" in cols and "partition" in cols:
        seq = F.shiftleft(F.coalesce(F.col("partition"), F.lit(0)).cast("long"), OFFSET_BITS).bitwiseOR(seq)
    keep = [c for c in ("arrival_ms", "offset", "partition", "file_ms") if c in cols]
    parsed = raw.select(F.col(value_col).alias("_raw"), j.alias("j"), *keep)
    offset = F.col("offset") if "offset" in cols else F.lit(None).cast("long")

    def item(x, index):
        return money(x["value"]).isNull() | x[index].try_cast("int").isNull()

    def judge(j):
        bad_item = (F.exists(j["inputs"], lambda x: item(x, "prev_output_index"))
                    | F.exists(j["outputs"], lambda x: item(x, "output_index")))
        return (F.when(j.isNull() | j["_corrupt_record"].isNotNull() | j["tx_id"].isNull(), "malformed_json")
                .when(_digits("j.timestamp").isNull(), "bad_timestamp")
                .when(j["inputs"].isNull() | j["outputs"].isNull(), "missing_field")
                .when(F.coalesce(bad_item, F.lit(True)), "bad_value"))

    parsed = parsed.select("_raw", "j", arrival.alias("arrival_ms"), seq.alias("seq"), offset.alias("_offset"),
                           judge(F.col("j")).alias("reason"))
    good = parsed.filter(F.col("reason").isNull()).select(
        F.col("j.tx_id").alias("tx_id"), _digits("j.timestamp").alias("timestamp"), F.col("j.inputs").alias("inputs"),
        F.col("j.outputs").alias("outputs"), F.col("j.source").alias("source"),
        F.expr("try_cast(j.ingest_time AS BIGINT)").alias("_ingest"), "arrival_ms", "seq")
    stamp = F.coalesce(F.col("_ingest"), ingest_time if ingest_time is not None else F.unix_millis(F.current_timestamp()))
    tx = normalize(good, ingest_time=stamp)
    bad = parsed.filter(F.col("reason").isNotNull()).select(
        F.col("_raw").alias("raw"), "arrival_ms", F.col("_offset").alias("offset"), "reason")
    return tx, bad


def split_canonical(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Canonical rows, and those without a ``tx_id`` (reason ``missing_id``: no rule
    of the ledger could tell them apart) or without a time (``bad_timestamp``)."""
    whole = F.to_json(F.struct(*[F.col(c) for c in tx.columns]))
    arrival = F.col("arrival_ms") if "arrival_ms" in tx.columns else F.lit(None).cast("long")
    reason = F.when(F.col("tx_id").isNull(), "missing_id").when(F.col("timestamp").isNull(), "bad_timestamp")
    bad = tx.filter(reason.isNotNull()).select(whole.alias("raw"), arrival.alias("arrival_ms"),
                                               F.lit(None).cast("long").alias("offset"), reason.alias("reason"))
    return tx.filter(reason.isNull()), bad


#: Sources of other kinds: ``make(spark, streaming, **options)`` returns the canonical frame and the rejected records.
REGISTERED: dict[str, Callable[..., tuple[DataFrame, DataFrame]]] = {}


def register_source(kind: str, make: Callable[..., tuple[DataFrame, DataFrame]]) -> None:
    """Add a kind of source; the jobs and ``read_with_quarantine`` take it like the
    built-in ones."""
    REGISTERED[kind.strip().lower()] = make


def read_with_quarantine(spark: SparkSession, kind: str, **opts) -> tuple[DataFrame, DataFrame]:
    """S3: source registry returning the canonical frame and the records that
    could not be taken, with their reason.

    kinds: ``parquet`` / ``table`` (canonical already), ``json`` (files of raw
    JSON lines, batch or ``streaming=True``), ``kafka``, ``blocks`` (a packed block
    archive), and what ``register_source`` added.  Unknown kinds raise."""
    kind = kind.strip().lower()
    streaming = bool(opts.pop("streaming", False))
    if kind in REGISTERED:
        return REGISTERED[kind](spark, streaming, **opts)
    if kind == "table":
        return split_canonical(spark.table(opts["name"]))
    if kind in ("parquet", "json"):
        reader = spark.readStream if streaming else spark.read
        for k, v in opts.get("options", {}).items():
            reader = reader.option(k, v)
        if kind == "parquet":
            return split_canonical((reader.schema(TRANSACTION) if streaming else reader).parquet(opts["path"]))
        text = reader.text(opts["path"])
        return parse_transactions(text.select("value", F.unix_millis("_metadata.file_modification_time").alias("file_ms")))
    if kind == "kafka":
        return parse_transactions(read_kafka_text(spark, opts["servers"], opts["topic"], streaming))
    raise ValueError(f"Unsupported source kind={kind}")


def _blocks(spark: SparkSession, streaming: bool, path: str, **options) -> tuple[DataFrame, DataFrame]:
    return parse_transactions(block_transactions(read_blocks(spark, path, streaming, **options)))


register_source("blocks", _blocks)


def read_transactions(spark: SparkSession, kind: str, **opts) -> DataFrame:
    """The canonical frame of ``read_with_quarantine`` alone (callers that write
    tables use both, so that nothing is lost)."""
    return read_with_quarantine(spark, kind, **opts)[0]
