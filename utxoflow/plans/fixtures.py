"""Fixtures FX-A / FX-B: canonical transactions derived by Spark from the
driver's test tables (see FIXTURES.md).  Every query reads the given tables,
so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.functions import epoch_ms, money
from utxoflow.operators.scan import prefix_scan, with_buckets
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.schema import INPUT, MONEY, OUTPUT

FXA_OPTIONS = DEFAULT.with_(whale_threshold=400_000.0, fan_out_threshold=8)
FXB_OPTIONS = DEFAULT.with_(
    late_tolerance_ms=86_400_000,
    velocity_window_ms=172_800_000, velocity_count=10,
    structuring_window_ms=345_600_000, structuring_count=6, structuring_ceiling=20.0,
    whale_threshold=450.0,
)
# FX-B-hot at test scale: thresholds low enough that the hot address takes
# the split path (production defaults are in LedgerOptions).
FXB_HOT_OPTIONS = FXB_OPTIONS.with_(hot_key_rows=1_000, rows_per_bucket=400)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lag(df: DataFrame, by: str, order: list[str], value: str, name: str,
         opts: LedgerOptions) -> DataFrame:
    """Previous ``value`` per ``by`` in ``order`` (skew-safe: two-level scan)."""
    b, hot = with_buckets(df, by, order, opts)
    key = F.struct(*[F.col(c) for c in order], F.col(value).alias("_v"))
    out = prefix_scan(b, by, order, hot, maxes={"_prev": key}, exclusive=True)
    return out.withColumn(name, F.col("_prev._v")).drop("_prev", "_bkt", "_hot")


def fx_a(spark: SparkSession, sf_dir: str, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """FX-A: one transaction per order; outputs = its line items, one input =
    the customer's previous order (none for the first: coinbase)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", epoch_ms("o_orderdate").alias("ts"))
    orders = _lag(orders, "o_custkey", ["ts", "o_orderkey"], "o_orderkey", "prev_key", opts)
    items = (table(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
             .groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(
                 "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).alias("items")))
    outputs = F.transform(F.coalesce(F.col("items"), F.array().cast("array<struct<l_linenumber:int,"
                                     "l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>>")),
                          lambda x, i: F.struct(
                              F.concat(F.lit("s"), x["l_suppkey"].cast("string")).alias("address"),
                              money(x["l_extendedprice"]).alias("value"),
                              i.alias("output_index")))
    inputs = F.when(F.col("prev_key").isNull(), F.array().cast(f"array<{INPUT.simpleString()}>")).otherwise(
        F.array(F.struct(
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("address"),
            money("o_totalprice").alias("value"),
            F.concat(F.lit("o"), F.col("prev_key").cast("string")).alias("prev_tx_id"),
            F.lit(0).alias("prev_output_index"))))
    return (orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
                  .select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("tx_id"),
                          F.col("ts").alias("timestamp"),
                          inputs.cast(f"array<{INPUT.simpleString()}>").alias("inputs"),
                          outputs.cast(f"array<{OUTPUT.simpleString()}>").alias("outputs"),
                          F.lit("orders").alias("source"),
                          F.col("ts").alias("ingest_time"),
                          F.col("ts").alias("arrival_ms"),
                          F.col("o_orderkey").alias("seq")))


def _events(spark: SparkSession, sf_dir: str, opts: LedgerOptions, hot: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", epoch_ms("ts").alias("tms"))
    address = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    if hot:  # FX-B-hot: one address receives every third event (a third of all rows)
        address = F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("u0")).otherwise(address)
    ev = ev.withColumn("address", address)
    ev = _lag(ev, "address", ["tms", "event_id"], "event_id", "prev_id", opts)
    arr = (F.col("tms") + F.pmod(F.col("event_id") * 7919, F.lit(86_400_000))
           + F.when(F.pmod("event_id", F.lit(10)) == 0, F.lit(400_000_000)).otherwise(F.lit(0)))
    return ev.withColumn("arr", arr.cast("long"))


def _fxb_inputs() -> F.Column:
    spends = F.col("event_type").isin("purchase", "click") & F.col("prev_id").isNotNull()
    return F.when(spends, F.array(F.struct(
        F.col("address"), money("value").alias("value"),
        F.col("prev_id").cast("string").alias("prev_tx_id"),
        F.lit(0).alias("prev_output_index")))).otherwise(F.array().cast(f"array<{INPUT.simpleString()}>"))


def fx_b(spark: SparkSession, sf_dir: str, variant: str | None = None,
         opts: LedgerOptions = DEFAULT) -> DataFrame:
    """FX-B: the address ledger from ``events``; ``variant`` in
    {None, 'orphan', 'double', 'hot', 'large', 'ties', 'burst'}."""
    if variant is not None and variant not in HOT_VARIANTS and variant not in ROW_VARIANTS:
        raise ValueError(f"unknown FX-B variant {variant!r}")
    ev = _events(spark, sf_dir, opts, hot=variant in HOT_VARIANTS)
    outputs = F.array(F.struct(F.col("address"), money("value").alias("value"),
                               F.lit(0).alias("output_index")))
    base = ev.select(
        F.col("event_id").cast("string").alias("tx_id"),
        F.col("tms").alias("timestamp"),
        _fxb_inputs().cast(f"array<{INPUT.simpleString()}>").alias("inputs"),
        outputs.cast(f"array<{OUTPUT.simpleString()}>").alias("outputs"),
        F.lit("events").alias("source"),
        F.col("arr").alias("ingest_time"),
        F.col("arr").alias("arrival_ms"),
        F.col("event_id").alias("seq"),
    )
    return fx_b_variant(base, variant) if variant in ROW_VARIANTS else base


#: Variants in which one address receives a third of the rows, and variants
#: that are row-level edits of the base (``burst``: of the hot one).
HOT_VARIANTS = ("hot", "burst")
ROW_VARIANTS = ("orphan", "double", "large", "ties", "burst")
DAY_MS = 86_400_000


def fx_b_variant(base: DataFrame, variant: str) -> DataFrame:
    """Row-level variants of FX-B, derived from the base frame (or table):
    'orphan' drops the outputs of events with id % 50 = 7 (their spends stay
    pending); 'double' delivers the inputs of events with id % 40 = 3 again,
    one hour later, in their own transaction (double spends); 'large'
    multiplies amounts by 10^7 (balances beyond 10^11); 'ties' is 'double'
    with arrivals cut to the day and two transactions to a ``seq`` (as two
    partitions give), so the id decides; 'burst' cuts arrivals to 30 days."""
    empty = F.array().cast(f"array<{OUTPUT.simpleString()}>")
    if variant == "orphan":
        return base.withColumn("outputs", F.when(F.pmod("seq", F.lit(50)) == 7, empty).otherwise(F.col("outputs")))
    if variant == "double":
        again = (base.filter((F.pmod(F.col("seq"), F.lit(40)) == 3) & (F.size("inputs") > 0))
                     .withColumn("tx_id", F.concat(F.col("tx_id"), F.lit("r")))
                     .withColumn("outputs", empty)
                     .withColumn("arrival_ms", F.col("arrival_ms") + F.lit(3_600_000))
                     .withColumn("ingest_time", F.col("arrival_ms")))
        return base.unionByName(again)
    if variant == "large":
        def scaled(c):
            return F.transform(c, lambda x: x.withField("value", (x["value"] * F.lit(10_000_000)).cast(MONEY)))
        return base.withColumn("inputs", scaled("inputs")).withColumn("outputs", scaled("outputs"))
    if variant == "ties":
        return (fx_b_variant(base, "double").withColumn("arrival_ms", F.col("arrival_ms") - F.pmod("arrival_ms", F.lit(DAY_MS)))
                .withColumn("seq", F.floor(F.col("seq") / 2).cast("long")))
    if variant == "burst":
        return base.withColumn("arrival_ms", F.col("arrival_ms") - F.pmod("arrival_ms", F.lit(30 * DAY_MS)))
    raise ValueError(f"unknown FX-B variant {variant!r}")


def fx_b_labeled(spark: SparkSession, sf_dir: str, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """FX-B with ``tx_id`` prefixed by the event type (for R2)."""
    ev = _events(spark, sf_dir, opts)
    return ev.select(F.concat(F.col("event_type"), F.lit("-"), F.col("event_id").cast("string")).alias("tx_id"),
                     F.col("tms").alias("timestamp"))
