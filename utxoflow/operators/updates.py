"""P5: explode a transaction into per-address updates in one pass.

All inputs come first, then all outputs, in array order (``pos`` is the index
in ``inputs ++ outputs``).  A transaction with neither yields nothing.  The
ledger key of an update is ``(ref_tx, ref_idx)``: the spent outpoint for an
input, the created outpoint for an output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def address_updates(tx: DataFrame) -> DataFrame:
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
    wm = F.col("watermark_ms") if "watermark_ms" in tx.columns else F.lit(None).cast("long")
    return (tx.select("tx_id", "timestamp", "source", "arrival_ms", "seq", wm.alias("watermark_ms"),
                      F.explode(items).alias("u"))
              .select(
                  F.col("u.address").alias("address"), "tx_id", "timestamp", "u.kind", "u.pos",
                  "u.value", "u.prev_tx_id", "u.prev_output_index", "u.output_index", "source",
                  "watermark_ms", "arrival_ms", "seq",
                  F.when(F.col("u.kind") == "input", F.col("u.prev_tx_id"))
                   .otherwise(F.col("tx_id")).alias("ref_tx"),
                  F.when(F.col("u.kind") == "input", F.col("u.prev_output_index"))
                   .otherwise(F.col("u.output_index")).alias("ref_idx"),
              ))


def update_rows(upd: DataFrame) -> DataFrame:
    """Output form of the updates (money as double, no helper columns)."""
    return upd.select(
        "address", "tx_id", "timestamp", "kind", "pos", F.col("value").cast("double").alias("value"),
        "prev_tx_id", "prev_output_index", "output_index", "source",
        F.coalesce(F.col("watermark_ms"), F.lit(-1).cast("long")).alias("watermark"),
    )
