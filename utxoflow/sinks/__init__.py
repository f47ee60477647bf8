"""Sinks (K1-K10): Kafka encoding, idempotent table writes, latest-balance
upsert, block archive.  All are Spark writers; nothing passes through the
driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxoflow.sinks.topics import occurrence
from utxoflow.sinks.versions import Part, VersionedTable, read_live

# ---------------------------------------------------------------- Kafka (K1-K3)


#: Columns that tell where a record occurred; they are in its occurrence id, not in its value.
PLACE = ("seq", "pos")


def encode_kafka(df: DataFrame, key: str | None = "tx_id", once: tuple[str, ...] = ()) -> DataFrame:
    """K1-K3: ``(key, value)`` records -- value = JSON of the row, key UTF-8.
    With ``once`` (columns that make a record one of a kind) also the
    ``occurrence`` id (``topics``)."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns if not (once and c in PLACE)]))
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), value.alias("value"), *([occurrence(*once)] if once else []))


def _where(df: DataFrame, *parts: str) -> tuple[str, ...]:
    """``parts`` and the place, when the frame has it."""
    return (*parts, *(c for c in PLACE if c in df.columns)) if "seq" in df.columns else ()


def tx_records(metrics: DataFrame) -> DataFrame:
    """K2: transaction metrics, keyed by tx_id."""
    return encode_kafka(metrics, "tx_id", _where(metrics, "tx_id"))


def balance_topic(balances: DataFrame) -> DataFrame:
    """K2: balance records, keyed by address."""
    return encode_kafka(balances, "address", _where(balances, "address", "tx_id"))


def metrics_topic(metrics: DataFrame, balances: DataFrame) -> DataFrame:
    """K2: the metrics topic carries transaction metrics (keyed by tx_id) and
    balance records (keyed by address) side by side as JSON values."""
    return tx_records(metrics).unionByName(balance_topic(balances))


def alerts_topic(alerts: DataFrame) -> DataFrame:
    """K3: transaction and state alerts share the alerts topic (keyed by id)."""
    return encode_kafka(alerts, "alert_id", _where(alerts, "alert_id"))


def write_kafka(df: DataFrame, servers: str, topic: str, key: str | None = "tx_id",
                checkpoint: str | None = None):
    """Publish rows; batch or streaming.  Spark's Kafka sink is at-least-once:
    consumers dedupe on the deterministic ids (tx_id, alert_id + seq)."""
    enc = encode_kafka(df, key)
    if df.isStreaming:
        return (enc.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                   .option("topic", topic).option("checkpointLocation", checkpoint).start())
    enc.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None


# ------------------------------------------------------------- Tables (K4-K8)


def write_table(df: DataFrame, path: str, batch_id: int | None = None,
                time_col: str = "timestamp_ms", sort_cols: tuple[str, ...] = (),
                granularity: str = "day", rows: Callable | None = None) -> None:
    """K4-K8: Parquet table partitioned by ``event_date`` (or ``event_month``
    with ``granularity="month"``).

    With ``batch_id`` (streaming, K8) each micro-batch owns the folder
    ``batch_id=N`` and overwrites it as a whole: a replayed batch replaces
    exactly its own rows, and readers see ``batch_id`` as a partition column;
    the folder is then named live (``versions``).  Without it the rows are
    appended; ``replace_table`` is the form that replaces an earlier run's.

    ``rows(frame, keep)`` makes the table's rows of ``df``'s (``time_col`` and
    ``sort_cols`` are ``df``'s) after these were dealt and sorted, so that JSON
    text is written and neither moved nor sorted."""
    out, part = dealt(df, time_col, sort_cols, granularity, rows)
    writer = out.write.option("compression", "zstd").partitionBy(part)
    if batch_id is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
        VersionedTable(df.sparkSession, path).add_batch(batch_id, out.schema)


def dealt(df: DataFrame, time_col: str, sort_cols: tuple[str, ...], granularity: str, rows: Callable | None) -> tuple[DataFrame, str]:
    """The frame that ``write_table`` writes, and its partition column."""
    day = F.to_date(F.timestamp_millis(F.col(time_col)))
    part = "event_month" if granularity == "month" else "event_date"
    out = df.withColumn(part, F.trunc(day, "month") if granularity == "month" else day)
    # REBALANCE on the partition column: AQE gathers each day into a few
    # right-sized files (no tasks x days file explosion) and splits a skewed
    # day over several tasks instead of one writer.
    out = out.hint("rebalance", part).sortWithinPartitions(part, *sort_cols)
    return (out if rows is None else rows(out, (part,))), part


def replace_table(df: DataFrame, path: str, time_col: str | None = "timestamp_ms", sort_cols: tuple[str, ...] = (),
                  granularity: str = "day", rows: Callable | None = None) -> str:
    """Make ``df`` the whole table (a batch run's output): written beside the
    live version and put in its place at once, so a rerun, also one after a
    failed run, leaves one run's rows.  Tables without ``time_col`` are not
    partitioned.  Read with ``read_live``; returns the folder of this version."""
    table, written = VersionedTable(df.sparkSession, path), []

    def write(folder: str) -> None:
        written.append(folder)
        if time_col is None:
            df.write.parquet(folder)
        else:
            write_table(df, folder, time_col=time_col, sort_cols=sort_cols, granularity=granularity, rows=rows)

    part = "event_month" if granularity == "month" else "event_date"
    fields = (rows(df, ()) if rows is not None else df).schema.fields
    schema = df.schema if time_col is None else T.StructType([*fields, T.StructField(part, T.DateType())])
    table.replace(write, schema)
    table.vacuum()
    return written[0]


def compact_table(spark: SparkSession, path: str, time_col: str = "timestamp_ms", fanout: int = 8, keep: int = 2) -> int:
    """Merge the folders of many micro-batches of a table written with
    ``batch_id``; readers of ``read_live`` see the same rows before, meanwhile
    and after.  Returns the number of merges."""
    def merge(rows: DataFrame, folder: str) -> None:
        gran = "month" if "event_month" in rows.columns else "day"
        write_table(rows.drop("event_month", "event_date"), folder, time_col=time_col, sort_cols=(time_col,), granularity=gran)

    table = VersionedTable(spark, path)
    merges = table.compact(merge, fanout)
    table.vacuum(keep)
    return merges


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 10_000, partitions: int | None = None) -> None:
    """K4-K7 into a SQL store (the reference's column store) through JDBC:
    executors insert in parallel, ``batch_size`` rows per round trip.  Not
    idempotent by itself; pair it with ``batch_id``-keyed dedupe on the
    table side (as ReplacingMergeTree would)."""
    out = df.repartition(partitions) if partitions else df
    (out.write.mode("append").option("batchsize", batch_size)
        .jdbc(url, table, properties=properties or {}))


# ------------------------------------------------------ Latest balance (K9)


def write_latest_changes(balances: DataFrame, path: str, batch_id: int) -> None:
    """K9 (streaming): the last *arrived* balance of every address changed in
    a micro-batch, appended as folder ``batch_id=N`` (a replayed batch rewrites
    itself).  Work per batch is proportional to the
    batch, never to the number of addresses ever seen."""
    rec = F.struct("balance", "utxo_count", "timestamp_ms", "source")
    changes = (balances.groupBy("address")
                       .agg(F.max_by(rec, F.struct("arrival_ms", "seq", "tx_id", "pos")).alias("r"))
                       .select("address", "r.*"))
    changes.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    VersionedTable(balances.sparkSession, path).add_batch(batch_id, changes.schema)


def compact_latest(spark, path: str, target: str) -> None:
    """Rewrite the change log below ``target`` with one row per address (the
    latest change, under its own ``batch_id``, so later batches still win)."""
    rec = F.struct("balance", "utxo_count", "timestamp_ms", "source", "batch_id")
    (spark.read.parquet(path).groupBy("address").agg(F.max_by(rec, "batch_id").alias("r"))
          .select("address", "r.balance", "r.utxo_count", "r.timestamp_ms", "r.source", "r.batch_id")
          .hint("rebalance", "batch_id").write.mode("errorifexists").partitionBy("batch_id").parquet(target))


def _newest(changes: DataFrame) -> DataFrame:
    rec = F.struct("balance", "utxo_count", "timestamp_ms", "source", "batch_id")
    return changes.groupBy("address").agg(F.max_by(rec, "batch_id").alias("r")).select("address", "r.*")


def merge_latest(spark: SparkSession, path: str, fanout: int = 8, keep: int = 2) -> int:
    """Merge the change log where it lies: runs of about equal size become one
    run with a row per address, sorted by address, so a read opens at most
    ``fanout`` runs per power of ``fanout`` below the number of batches.  With
    ``keep`` versions, the balances as of that many commits ago can be read."""
    def merge(rows: DataFrame, folder: str) -> None:
        _newest(rows).hint("rebalance", "address").sortWithinPartitions("address").write.parquet(folder)

    table = VersionedTable(spark, path)
    merges = table.compact(merge, fanout)
    table.vacuum(keep)
    return merges


def read_latest(spark: SparkSession, path: str, as_of_batch: int | None = None) -> DataFrame:
    """K9 read side: latest change per address across batches (map-side
    combinable ``max_by``), or as it was after micro-batch ``as_of_batch``
    while a version that ends there is kept."""
    version = None if as_of_batch is None else VersionedTable(spark, path).version_of_batch(as_of_batch)
    return _newest(read_live(spark, path, version)).drop("batch_id")


# -------------------------------------------------------- Block archive


def archive_blocks(raw: DataFrame, value_col: str = "value", order_col: str = "offset") -> tuple[DataFrame, DataFrame]:
    """``(archive, rejected)``.  One object per ``height``; a later record
    of the same height overwrites (``max_by`` on the arrival order, map-side
    combinable).  Records without ``height`` or with bad JSON are rejected."""
    height = F.get_json_object(F.col(value_col), "$.height")
    valid = F.col(value_col).isNotNull() & F.get_json_object(F.col(value_col), "$").isNotNull()
    tagged = raw.select(F.col(value_col).alias("raw"), F.col(order_col).alias("offset"),
                        height.alias("height"), valid.alias("valid"))
    archive = (tagged.filter(F.col("valid") & F.col("height").isNotNull())
                     .groupBy("height")
                     .agg(F.max_by(F.struct("offset", "raw"), "offset").alias("w"))
                     .select("height", F.concat(F.col("height"), F.lit(".json")).alias("object_key"),
                             F.col("w.offset").alias("offset"), F.col("w.raw").alias("raw")))
    rejected = (tagged.filter(~F.col("valid") | F.col("height").isNull())
                      .select("offset", F.when(~F.col("valid"), F.lit("bad_json"))
                                         .otherwise(F.lit("missing_height")).alias("reason")))
    return archive, rejected


def write_archive(archive: DataFrame, path: str) -> None:
    """Write the archive as JSON text objects, one folder per height below a
    bucket of 1,000 heights.  A later write replaces the heights it has
    (last write wins, as for an object store key) and leaves all others."""
    bucket = F.coalesce(F.floor(F.col("height").try_cast("decimal(38,0)") / 1000).cast("string"), F.lit("other"))
    (archive.withColumn("height_bucket", bucket)
            .withColumn("at_height", F.col("height"))
            .select("height_bucket", "at_height", "height", "object_key", "offset", "raw")
            .hint("rebalance", "height_bucket", "at_height")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("height_bucket", "at_height").json(path))


def read_archive(spark, path: str) -> DataFrame:
    """height, object_key, offset and raw of every archived block."""
    return spark.read.schema("height string, object_key string, offset bigint, raw string, height_bucket string, at_height string") \
        .json(path).select("height", "object_key", "offset", "raw")


def write_packed_archive(archive: DataFrame, path: str) -> None:
    """K10 with many heights to a file: a write adds a part sorted by height, whose
    file and row-group statistics are the index from heights to places; it
    replaces no other file.  ``merge_packed`` keeps the parts few, so the number of
    files follows the bytes, not the heights or the writes."""
    table = VersionedTable(archive.sparkSession, path)
    number = F.col("height").try_cast("decimal(38,0)").cast("long")
    rows = archive.select("height", "object_key", "offset", "raw", number.alias("height_number"))
    folder = table.new_folder()
    rows.repartitionByRange("height_number", "height").sortWithinPartitions("height_number", "height").write.parquet(f"{table.path}/{folder}")
    step = max((p.last for p in table.parts() if p.last is not None), default=-1) + 1
    table.commit(lambda parts: parts + [Part(folder, step, step)], rows.schema)


def _last_write(rows: DataFrame) -> DataFrame:
    """The record with the largest offset of every height."""
    rest = [c for c in rows.columns if c != "height"]
    return (rows.groupBy("height").agg(F.max_by(F.struct(*rest), "offset").alias("w"))
                .select("height", *[F.col(f"w.{c}").alias(c) for c in rest]))


def merge_packed(spark: SparkSession, path: str, fanout: int = 8, keep: int = 2) -> int:
    """Merge parts of a packed archive by size; of a height the last write stays."""
    def merge(rows: DataFrame, folder: str) -> None:
        _last_write(rows).repartitionByRange("height_number", "height").sortWithinPartitions("height_number", "height").write.parquet(folder)

    table = VersionedTable(spark, path)
    merges = table.compact(merge, fanout, leave=0)
    table.vacuum(keep)
    return merges


def read_packed_archive(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """height, object_key, offset and raw of every archived block, or of those
    with ``lo <= height <= hi``: the bounds reach the scan, which opens the row
    groups that overlap them."""
    rows = read_live(spark, path)
    if lo is not None:
        rows = rows.filter(F.col("height_number") >= int(lo))
    if hi is not None:
        rows = rows.filter(F.col("height_number") <= int(hi))
    return _last_write(rows).select("height", "object_key", "offset", "raw")


# ------------------------------------------- Address tables


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, sort_cols: tuple[str, ...] = ("address",)) -> None:
    """A table bucketed by address and sorted inside the buckets, so that whatever
    groups by address reads it without an exchange (``spark.table(name)``)."""
    (df.repartition(int(buckets), "address").write.mode("overwrite").bucketBy(int(buckets), "address").sortBy(*sort_cols)
       .option("path", path).option("compression", "zstd").saveAsTable(name))


def write_quarantine(rejected: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Records that no table took, with their reason; per micro-batch a folder
    of its own, as in ``write_table``."""
    if batch_id is None:
        rejected.write.mode("append").parquet(path)
    else:
        rejected.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
