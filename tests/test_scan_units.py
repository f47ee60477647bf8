"""Unit checks of the skew-safe building blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from utxoflow.operators.activity import _counter
from utxoflow.operators.scan import global_prefix_max
from utxoflow.options import DEFAULT


def _rows(n=400, seed=0):
    rnd = np.random.default_rng(seed)
    addr = np.sort(rnd.choice(["a", "b", "c"], n))
    ts = np.cumsum(rnd.integers(0, 40, n)) + rnd.choice([0, 0, 0, -300, 500], n)
    df = pd.DataFrame({"address": addr, "_chunk": 0, "tx_id": [f"t{i}" for i in range(n)],
                       "timestamp": ts, "arrival_ms": np.arange(n), "seq": np.arange(n), "pos": 0,
                       "small": rnd.random(n) < 0.5, "is_query": True})
    df["max_ts"] = df.groupby("address")["timestamp"].cummax()
    return df


def test_activity_batches_equal_one_pass():
    o = DEFAULT.with_(velocity_window_ms=100, velocity_count=2, structuring_window_ms=250,
                      structuring_count=2)
    df = _rows()
    whole = pd.concat(list(_counter(o)(iter([df]))), ignore_index=True)
    for size in (1, 7, 50):
        parts = [df.iloc[i:i + size].reset_index(drop=True) for i in range(0, len(df), size)]
        got = pd.concat(list(_counter(o)(iter(parts))), ignore_index=True)
        pd.testing.assert_frame_equal(got.reset_index(drop=True), whole.reset_index(drop=True),
                                      check_dtype=False)


def test_burst_on_one_arrival_value_is_split_and_exact(spark):
    # 60% of the rows share one arrival value; order is (arrival, seq).
    n = 2000
    rows = [(i, 1000 if i % 5 < 3 else i, (i * 7919) % 1000) for i in range(n)]
    df = spark.createDataFrame(rows, "seq long, arrival_ms long, timestamp long")
    out = global_prefix_max(df, "timestamp", ["arrival_ms", "seq"], "m", 8)
    got = {r.seq: r.m for r in out.collect()}
    want, best = {}, None
    for seq, arr, ts in sorted(rows, key=lambda r: (r[1], r[0])):
        want[seq] = best
        best = ts if best is None else max(best, ts)
    assert got == want


def test_many_hot_keys_and_a_null_key(spark):
    """Thousands of hot keys, a null one among them: no cap, exact sums."""
    from utxoflow.operators.scan import prefix_scan, with_buckets

    k = F.when(F.col("id") % 3000 != 7, F.col("id") % 3000)
    df = spark.range(0, 60000).select(k.alias("k"), F.col("id").alias("t"), F.lit(1).alias("v"))
    b, hot = with_buckets(df, "k", ["t"], DEFAULT.with_(hot_key_rows=10, rows_per_bucket=500))
    assert hot and b.filter("_hot").select("k").distinct().count() == 3000
    out = prefix_scan(b, "k", ["t"], hot, sums={"n": F.col("v").cast("long")})
    assert out.count() == 60000 and out.filter(F.col("n") != F.floor(F.col("t") / 3000) + 1).count() == 0


def test_hot_key_pieces_hold_equal_numbers_of_rows(spark):
    """Nearly all rows of the key in one burst, and dust amounts as the order:
    the largest piece stays under twice the average."""
    from utxoflow.operators.scan import prefix_scan, with_buckets

    burst = spark.range(0, 20_000).select(F.lit("a").alias("k"), F.when(F.col("id") < 10, F.col("id") * 10**9)
                                          .otherwise(5 * 10**8).alias("t"), F.col("id").alias("s"), F.lit(1).alias("v"))
    dust = spark.range(0, 20_000).select(F.lit("a").alias("k"), (-1 / (F.col("id") + 2)).alias("t"), F.col("id").alias("s"),
                                         F.lit(1).alias("v"))
    for df in (burst, dust):
        b, hot = with_buckets(df, "k", ["t", "s"], DEFAULT.with_(hot_key_rows=1000, rows_per_bucket=500))
        sizes = [r["count"] for r in b.groupBy("_bkt").count().collect()]
        assert sum(sizes) == 20_000 and len(sizes) >= 30 and max(sizes) < 2 * 500
        rows = prefix_scan(b, "k", ["t", "s"], hot, sums={"n": F.col("v").cast("long")}).orderBy("t", "s").select("n").collect()
        assert [r["n"] for r in rows] == list(range(1, 20_001))


def test_pieces_follow_the_partitions_not_the_rows(spark):
    """Small pieces wanted of many rows: their number stays a few per partition, sums exact."""
    from utxoflow.operators.scan import MIN_PIECES, prefix_scan, with_buckets

    df = spark.range(0, 5000).select(F.lit("a").alias("k"), F.col("id").alias("t"), F.lit(1).alias("v"))
    b, hot = with_buckets(df, "k", ["t"], DEFAULT.with_(hot_key_rows=1000, rows_per_bucket=5))
    assert hot and 30 <= b.select("_bkt").distinct().count() <= MIN_PIECES
    out = prefix_scan(b, "k", ["t"], hot, sums={"n": F.col("v").cast("long")})
    assert out.filter(F.col("n") == F.col("t") + 1).count() == 5000


def test_window_counts_brute_force():
    import utxoflow.operators.activity as act

    rnd = np.random.default_rng(5)
    n = 3000
    seg = np.sort(rnd.integers(0, 20, n))
    ts = np.cumsum(rnd.integers(0, 30, n)) + rnd.choice([0, 0, -500, 700], n)
    m = np.empty(n, np.int64)
    for g in np.unique(seg):
        sel = np.flatnonzero(seg == g)
        m[sel] = np.maximum.accumulate(ts[sel])
    small = rnd.random(n) < 0.4
    w, wv, ws = 900, 400, 900
    want_v, want_s = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        js = [j for j in range(i + 1) if seg[j] == seg[i] and m[j] >= m[i] - w]
        want_v[i] = sum(1 for j in js if ts[i] - ts[j] <= wv)
        want_s[i] = sum(1 for j in js if small[j] and ts[i] - ts[j] <= ws)
    v, s = act.window_counts(seg, ts, m, small, w, wv, ws)
    assert (v == want_v).all() and (s == want_s).all()
    v, s = act.window_counts(seg, ts, m, small, w, wv, ws, first=1234)
    assert (v == want_v[1234:]).all() and (s == want_s[1234:]).all()
    far = ts * 2**40  # no offsets of groups and times to overflow
    v, s = act.window_counts(seg, far, m * 2**40, small, w * 2**40, wv * 2**40, ws * 2**40)
    assert (v == want_v).all() and (s == want_s).all()


def test_hot_address_is_spread_over_tasks(spark):
    """FX-B-hot: one address holds a third of the updates.  In the running-sum
    stage no task holds that third once the address is split; without the
    split one task does."""
    from conftest import SF01
    from utxoflow.operators.ledger import ledger
    from utxoflow.operators.updates import address_updates
    from utxoflow.plans.fixtures import FXB_HOT_OPTIONS, FXB_OPTIONS, fx_b

    upd = address_updates(fx_b(spark, SF01, "hot", FXB_OPTIONS)).cache()
    n = upd.count()
    assert upd.filter(F.col("address") == "u0").count() > n / 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def max_share(opts):
            # Rows per partition of the final stage (the running-sum window).
            led = ledger(upd, opts).select("address", "balance", "utxo_count")
            sizes = led.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
            return max(sizes) / n
        split = max_share(FXB_HOT_OPTIONS)
        whole = max_share(FXB_OPTIONS.with_(hot_key_rows=10**9))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        upd.unpersist()
    assert whole > 1 / 3 and split < 0.25, (split, whole)
