"""Per-transaction operators: normalize (P1), event time (P2), metrics (P3),
table rows (P4), metric envelope (P7), deduplication.

All of them are narrow (no shuffle) except ``dedupe_transactions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utxoflow.functions import array_sum, as_double, money, now_ms
from utxoflow.schema import MONEY_SUM


def normalize(raw: DataFrame, ingest_time: Column | int | None = None) -> DataFrame:
    """Round every input/output value to 8 dp, keep the utxo references,
    drop ``attributes`` and stamp ``ingest_time`` (wall clock unless given)."""
    if ingest_time is None:
        stamp = now_ms()
    elif isinstance(ingest_time, Column):
        stamp = ingest_time
    else:
        stamp = F.lit(int(ingest_time))
    inputs = F.transform(
        F.coalesce(F.col("inputs"), F.array()),
        lambda x: F.struct(
            x["address"].alias("address"),
            money(x["value"]).alias("value"),
            x["prev_tx_id"].alias("prev_tx_id"),
            x["prev_output_index"].try_cast("int").alias("prev_output_index"),
        ),
    )
    outputs = F.transform(
        F.coalesce(F.col("outputs"), F.array()),
        lambda y: F.struct(
            y["address"].alias("address"),
            money(y["value"]).alias("value"),
            y["output_index"].try_cast("int").alias("output_index"),
        ),
    )
    cols = raw.columns
    arrival = F.col("arrival_ms") if "arrival_ms" in cols else F.lit(None).cast("long")
    seq = F.col("seq") if "seq" in cols else F.lit(None).cast("long")
    return raw.select(
        F.col("tx_id").cast("string").alias("tx_id"),
        F.col("timestamp").cast("long").alias("timestamp"),
        inputs.alias("inputs"),
        outputs.alias("outputs"),
        F.col("source").cast("string").alias("source"),
        stamp.cast("long").alias("ingest_time"),
        arrival.alias("arrival_ms"),
        seq.alias("seq"),
    )


def exploded_values(tx: DataFrame) -> DataFrame:
    """Flat view of a nested canonical frame (one row per input/output)."""
    items = F.concat(
        F.transform("inputs", lambda x, i: F.struct(
            F.lit("input").alias("kind"), i.alias("pos"), x["address"].alias("address"),
            x["value"].alias("value"), x["prev_tx_id"].alias("prev_tx_id"),
            x["prev_output_index"].alias("prev_output_index"),
            F.lit(None).cast("int").alias("output_index"))),
        F.transform("outputs", lambda y, i: F.struct(
            F.lit("output").alias("kind"), (i + F.size("inputs")).alias("pos"),
            y["address"].alias("address"), y["value"].alias("value"),
            F.lit(None).cast("string").alias("prev_tx_id"),
            F.lit(None).cast("int").alias("prev_output_index"),
            y["output_index"].alias("output_index"))),
    )
    return (tx.select("tx_id", "timestamp", "source", "ingest_time", F.explode(items).alias("it"))
              .select("tx_id", "timestamp", "source", "ingest_time", "it.kind", "it.pos",
                      "it.address", as_double("it.value").alias("value"), "it.prev_tx_id",
                      "it.prev_output_index", "it.output_index"))


def with_event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Epoch-ms event time (digit strings accepted) plus a timestamp column
    ``event_time`` usable by ``withWatermark``/``window``."""
    ms = F.coalesce(F.expr(f"try_cast({col} AS BIGINT)"),
                    F.expr(f"try_cast(try_cast({col} AS DOUBLE) AS BIGINT)"))
    return df.withColumn(col, ms).withColumn("event_time", F.timestamp_millis(F.col(col)))


def _is_late(df: DataFrame) -> Column:
    if "watermark_ms" in df.columns:
        return F.coalesce(F.col("timestamp") < F.col("watermark_ms"), F.lit(False))
    return F.lit(False)


def tx_metrics(tx: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The transaction metric record (money rounded, fee clamped at 0);
    ``keep``: columns of the transaction to have beside it."""
    total_in, total_out = array_sum("inputs"), array_sum("outputs")
    return tx.select(
        F.lit("transaction").alias("metric_type"),
        "tx_id",
        "timestamp",
        F.coalesce(F.col("ingest_time"), now_ms()).alias("ingest_time"),
        "source",
        F.size("inputs").alias("input_count"),
        F.size("outputs").alias("output_count"),
        as_double(total_in).alias("total_input"),
        as_double(total_out).alias("total_output"),
        as_double(F.greatest(total_in - total_out, F.lit(0).cast(MONEY_SUM))).alias("fee_estimate"),
        _is_late(tx).alias("is_late"), *keep,
    )


def _json_items(arr: str, fields: list[str]) -> Column:
    return F.to_json(F.transform(arr, lambda x: F.struct(*[
        (as_double(x[f]) if f == "value" else x[f]).alias(f) for f in fields])))


def tx_rows(tx: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row of the ``transactions`` table (totals unrounded floats in
    the reference; exact decimals here, so rounded and unrounded coincide);
    ``keep``: columns of the transaction to have beside it."""
    return tx.select(
        "tx_id",
        F.col("timestamp").alias("timestamp_ms"),
        F.coalesce(F.col("ingest_time"), now_ms()).alias("ingest_time_ms"),
        "source",
        F.size("inputs").alias("input_count"),
        F.size("outputs").alias("output_count"),
        as_double(array_sum("inputs")).alias("total_input"),
        as_double(array_sum("outputs")).alias("total_output"),
        _json_items("inputs", ["address", "value", "prev_tx_id", "prev_output_index"]).alias("inputs_json"),
        _json_items("outputs", ["address", "value", "output_index"]).alias("outputs_json"),
        _is_late(tx).cast("int").alias("is_late"), *keep,
    )


def metric_rows(metrics: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope (metric_type, timestamp_ms, source, tx_id, address, payload_json);
    ``keep``: columns to have beside it, not in the payload."""
    cols = [c for c in metrics.columns if c not in keep]
    payload = F.to_json(F.struct(*[F.col(c) for c in cols]))
    return metrics.select(
        F.col("metric_type"),
        F.col("timestamp").alias("timestamp_ms"),
        F.coalesce(F.col("source"), F.lit("unknown")).alias("source"),
        F.coalesce(F.col("tx_id") if "tx_id" in cols else F.lit(None).cast("string"), F.lit("")).alias("tx_id"),
        F.coalesce(F.col("address") if "address" in cols else F.lit(None).cast("string"), F.lit("")).alias("address"),
        payload.alias("payload_json"), *keep,
    )


def dedupe_transactions(tx: DataFrame) -> DataFrame:
    """Keep the first arrival of each ``tx_id`` (precondition of the ledger).

    One shuffle on ``tx_id``, copies collapsed before it; a replayed id keeps its
    earliest (arrival, seq).  Rows without an id are no copies of each other."""
    own = F.when(F.col("tx_id").isNull(), F.monotonically_increasing_id())
    return (tx.groupBy("tx_id", own.alias("_own"))
              .agg(F.min_by(F.struct(*[F.col(c) for c in tx.columns]),
                            F.struct("arrival_ms", "seq")).alias("t"))
              .select("t.*"))
