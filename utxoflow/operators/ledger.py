"""Batch form of the per-address ledger.

The reference keeps, per address and in arrival order, a set of unspent
outputs, a set of pending spends (an input seen before its output) and a
balance, and emits a balance record after every update.  Sequentially:

* output ``k``: if ``k`` is pending, cancel both; else add ``k`` (+value);
* input ``k``: if ``k`` is unspent, remove it (-stored value); else pending.

Set-based equivalent, per ``(address, key)`` with ``key = (ref_tx, ref_idx)``
and the order ``(arrival_ms, seq, tx_id, pos)``: the output adds iff no input of the
key precedes it; the *first* input spends iff the output precedes it; every
other update changes nothing.  So one window over ``(address, key)`` gives each
update its delta, and the balance / utxo count are running sums of the deltas
per address (a skew-safe two-level scan, see ``scan.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utxoflow.operators.scan import hot_keys, prefix_scan, with_buckets
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.schema import MONEY, MONEY_SUM
from utxoflow.session import staged

#: Total order of updates: ties of (arrival, seq) between transactions go by id.
ORDER = ["arrival_ms", "seq", "tx_id", "pos"]
KEY = ["address", "ref_tx", "ref_idx"]
#: Columns of an update that are its key again: the kind that has them, the key's column.
OUTPOINT = {"prev_tx_id": ("input", "ref_tx"), "prev_output_index": ("input", "ref_idx"), "output_index": ("output", "ref_idx")}


def _ord():
    return F.struct(*[F.col(c) for c in ORDER])


def with_deltas(upd: DataFrame, by: list[str] = KEY) -> DataFrame:
    """L1/L2: per update, its effect on the address's set and balance.  ``by``: the
    columns of ``KEY`` that deal the rows to tasks."""
    key = Window.partitionBy(*KEY)
    is_in = F.col("kind") == "input"
    # Explicit full-key partitioning: an input hash-partitioned by address
    # alone would otherwise be reused and put a hot address in one task.
    upd = upd.repartition(*by)
    first_in = F.min(F.when(is_in, _ord())).over(key)
    out_ord = F.min(F.when(~is_in, _ord())).over(key)
    out_val = F.max(F.when(~is_in, F.col("value"))).over(key)
    d = (upd.withColumn("_first_in", first_in)
            .withColumn("_out_ord", out_ord)
            .withColumn("_out_val", out_val))
    add = ~is_in & (F.col("_first_in").isNull() | (F.col("_first_in") > _ord()))
    spend = is_in & (_ord() == F.col("_first_in")) & F.col("_out_ord").isNotNull() & (F.col("_out_ord") < _ord())
    zero = F.lit(0).cast(MONEY)
    return (d.withColumn("d_count", F.when(add, 1).when(spend, -1).otherwise(0))
             .withColumn("d_balance", F.when(add, F.col("value")).when(spend, -F.col("_out_val"))
                         .otherwise(zero).cast(MONEY))
             .drop("_first_in", "_out_ord", "_out_val"))


def ledger(upd: DataFrame, opts: LedgerOptions = DEFAULT, once: bool = False) -> DataFrame:
    """Every update with the address's ``balance`` and ``utxo_count``
    after it, plus ``max_ts`` (running max event time, used by L5).  With ``once``
    and no hot address, one exchange by address serves both windows, and whatever
    groups the result by address."""
    # Hot-key statistics on the raw updates (a pruned scan), not after the window.
    keys = hot_keys(upd, "address", opts)
    # The outpoint columns are the key again: not moved, set anew at the end.
    again = [c for c in OUTPOINT if c in upd.columns]
    deltas = with_deltas(upd.drop(*again), ["address"] if once and keys is None else KEY)
    if keys is not None:  # read twice, for the hot and for all other addresses: computed once
        deltas = staged(deltas, "deltas")
    b, hot = with_buckets(deltas, "address", ORDER, opts, keys, known=True)
    out = prefix_scan(
        b, "address", ORDER, hot,
        sums={"balance": F.col("d_balance").cast(MONEY_SUM), "utxo_count": F.col("d_count").cast("long")},
        maxes={"max_ts": F.col("timestamp")},
    )
    return with_outpoints(out, again)


def with_outpoints(led: DataFrame, names: list[str] = list(OUTPOINT)) -> DataFrame:
    """The columns of an update that its kind and its key tell."""
    return led.withColumns({c: F.when(F.col("kind") == OUTPOINT[c][0], F.col(OUTPOINT[c][1])) for c in names})


def balance_records(led: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The balance record emitted after every update; ``keep``: columns of
    the update to have beside it."""
    return led.select(
        F.lit("balance_update").alias("metric_type"), "address", "tx_id", "kind",
        F.col("balance").cast("double").alias("balance"), "utxo_count",
        F.col("timestamp").alias("timestamp_ms"), "source", *keep,
    )


def balance_rows(led: DataFrame) -> DataFrame:
    """K6: a row of the ``balance_updates`` table (with the arrival order kept
    as ``arrival_ms``/``seq``/``tx_id``/``pos`` so later collapses are deterministic)."""
    return led.select(
        "address", F.col("timestamp").alias("timestamp_ms"), "source",
        F.col("balance").cast("double").alias("balance"), "utxo_count", *ORDER,
    )


def latest_balances(led: DataFrame) -> DataFrame:
    """K9 (batch): the last *arrived* balance per address (one shuffle with
    partial aggregation: ``max_by`` is map-side combinable)."""
    rec = F.struct(F.col("balance").cast("double").alias("balance"), "utxo_count",
                   F.col("timestamp").alias("timestamp_ms"), "source")
    return (led.groupBy("address").agg(F.max_by(rec, _ord()).alias("r"))
               .select("address", "r.balance", "r.utxo_count", "r.timestamp_ms", "r.source"))


def _key_summary(upd: DataFrame) -> DataFrame:
    is_in = F.col("kind") == "input"
    return upd.groupBy(*KEY).agg(
        F.count(F.when(is_in, 1)).alias("n_in"),
        F.min(F.when(is_in, _ord())).alias("first_in"),
        F.max(F.when(is_in, _ord())).alias("last_in"),
        F.min(F.when(~is_in, F.struct(_ord().alias("o"), F.col("value").alias("v"),
                                      F.col("timestamp").alias("t")))).alias("out"),
    )


def _unspent() -> Column:
    """Of a key summary: an output whose key never had an input."""
    return F.col("out").isNotNull() & (F.col("n_in") == 0)


def _pending() -> Column:
    """Of a key summary: a spend is pending in the end."""
    no_out = F.col("out").isNull() & (F.col("n_in") > 0)
    before = F.col("out").isNotNull() & (F.col("first_in") < F.col("out.o")) & (F.col("last_in") > F.col("out.o"))
    after = F.col("out").isNotNull() & (F.col("first_in") > F.col("out.o")) & (F.col("n_in") >= 2)
    return F.coalesce(no_out | before | after, F.lit(False))


def utxo_snapshot(upd: DataFrame) -> DataFrame:
    """The final unspent set = outputs whose key never had an input."""
    s = _key_summary(upd)
    return (s.filter(_unspent())
             .select("address", F.col("ref_tx").alias("tx_id"), F.col("ref_idx").alias("output_index"),
                     F.col("out.v").cast("double").alias("value"), F.col("out.t").alias("timestamp")))


def pending_spends(upd: DataFrame) -> DataFrame:
    """Final pending spends.  With ``b`` inputs before the output and
    ``a`` after: pending iff (no output and any input) or (b>=1 and a>=1) or
    (b=0 and a>=2) -- the set collapses repeated keys."""
    return (_key_summary(upd).filter(_pending())
            .select("address", F.col("ref_tx").alias("prev_tx_id"), F.col("ref_idx").alias("prev_output_index")))


def ledger_state(upd: DataFrame, opts: LedgerOptions = DEFAULT, led: DataFrame | None = None) -> DataFrame:
    """The ledger's final per-address state in the layout of the streaming
    processor's initial state: ``totals`` (balance, counts), ``utxo`` and
    ``pending`` entries, and the ``recent`` activity buffer (rows with
    ``max_ts >= final max_ts - W``).  Lets a stream continue a batch backfill.
    ``led``: the ledger of ``upd`` if it is there already."""
    led = ledger(upd, opts) if led is None else led
    # Read more than once: open keys and a row per address, computed once.
    s = staged(_key_summary(upd).select(*KEY, _unspent().alias("unspent"), _pending().alias("pending"), F.col("out.v").alias("value"),
                                        F.col("out.t").alias("timestamp")).filter("unspent or pending"), "open-keys")
    pending = s.filter("pending")
    n_pend = pending.groupBy("address").agg(F.count(F.lit(1)).alias("pending_count"))
    last = staged(led.groupBy("address").agg(
        F.max_by(F.struct("balance", "utxo_count"), _ord()).alias("t"), F.max("max_ts").alias("_m")), "last")
    nul = {c: F.lit(None).cast(t) for c, t in [
        ("balance_units", "string"), ("utxo_count", "long"), ("pending_count", "long"), ("tx_id", "string"),
        ("output_index", "int"), ("value_units", "long"), ("timestamp", "long"), ("small", "boolean"),
        ("arrival_ms", "long"), ("seq", "long"), ("pos", "int")]}
    units = F.lit(100_000_000)  # the processor keeps money as integer units of 1e-8

    def shape(df: DataFrame, part: str, **cols) -> DataFrame:
        return df.select("address", F.lit(part).alias("part"),
                         *[(cols[c] if c in cols else nul[c]).alias(c) for c in nul])

    totals = shape(last.join(n_pend, "address", "left"), "totals",
                   balance_units=(F.col("t.balance") * units).cast("decimal(38,0)").cast("string"), utxo_count=F.col("t.utxo_count"),
                   pending_count=F.coalesce(F.col("pending_count"), F.lit(0)).cast("long"))
    utxos = shape(s.filter("unspent"), "utxo",
                  tx_id=F.col("ref_tx"), output_index=F.col("ref_idx"), value_units=(F.col("value") * units).cast("long"),
                  timestamp=F.col("timestamp"))
    pend = shape(pending, "pending", tx_id=F.col("ref_tx"), output_index=F.col("ref_idx"))
    small = (F.col("kind") == "output") & (F.col("value") <= F.lit(str(opts.structuring_ceiling)).cast("decimal(38,8)"))
    recent = shape(led.join(last.select("address", "_m"), "address")
                      .filter(F.col("max_ts") >= F.col("_m") - F.lit(int(opts.activity_window_ms))),
                   "recent", timestamp=F.col("timestamp"), small=small, arrival_ms=F.col("arrival_ms"),
                   seq=F.col("seq"), pos=F.col("pos"))
    return totals.unionByName(utxos).unionByName(pend).unionByName(recent)
