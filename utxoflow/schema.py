"""Canonical schemas.

Money is ``decimal(18,8)`` inside the engine (exact, order independent sums)
and is cast to ``double`` only at the output boundary.  Times are epoch
milliseconds (``bigint``) everywhere, as in the reference's tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 8)
# Accumulator for money sums: 20 integer digits.  Not 38: adding two
# decimal(38,8) values needs 39 digits and Spark would drop a digit of scale.
MONEY_SUM = T.DecimalType(28, 8)

INPUT = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("value", MONEY),
    T.StructField("prev_tx_id", T.StringType()),
    T.StructField("prev_output_index", T.IntegerType()),
])

OUTPUT = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("value", MONEY),
    T.StructField("output_index", T.IntegerType()),
])

# Normalized transaction.  ``arrival_ms`` and ``seq`` carry the arrival order
# (Kafka timestamp/partition/offset in a stream, explicit columns in batch): the ledger
# is order dependent and a batch has no implicit order.
TRANSACTION = T.StructType([
    T.StructField("tx_id", T.StringType(), False),
    T.StructField("timestamp", T.LongType()),
    T.StructField("inputs", T.ArrayType(INPUT)),
    T.StructField("outputs", T.ArrayType(OUTPUT)),
    T.StructField("source", T.StringType()),
    T.StructField("ingest_time", T.LongType()),
    T.StructField("arrival_ms", T.LongType()),
    T.StructField("seq", T.LongType()),
])

# Raw JSON as it arrives on the wire.  Numbers are read as text and converted
# by ``try_cast``: digit strings are accepted, and what does not convert is told
# from what was not there (one goes to quarantine with its own reason).
RAW_INPUT = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("prev_tx_id", T.StringType()),
    T.StructField("prev_output_index", T.StringType()),
])
RAW_OUTPUT = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("output_index", T.StringType()),
])
RAW_TRANSACTION = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("inputs", T.ArrayType(RAW_INPUT)),
    T.StructField("outputs", T.ArrayType(RAW_OUTPUT)),
    T.StructField("source", T.StringType()),
    T.StructField("ingest_time", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])
