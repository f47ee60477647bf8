"""Randomized adversarial ledgers vs the sequential model: out-of-order
arrival, double spends, orphan spends, spends before outputs, timestamp ties
and future timestamps, on both the ordinary and the hot-key path."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from model import run_model
from utxoflow.operators.activity import activity_counts
from utxoflow.operators.ledger import ledger, pending_spends, utxo_snapshot
from utxoflow.operators.updates import address_updates
from utxoflow.options import DEFAULT
from utxoflow.schema import TRANSACTION


def _scenario(seed: int, n_tx: int = 150, n_addr: int = 4):
    rnd = random.Random(seed)
    outs = []  # (address, tx_id, idx, value)
    rows = []
    t = 1_000_000
    for i in range(n_tx):
        t += rnd.choice([0, 0, 1, 5, 30, 200])          # ties are common
        ts = t + (rnd.choice([0, 0, 0, -400, 900]))     # late and future timestamps
        ins = []
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            r = rnd.random()
            if outs and r < 0.7:
                a, tx, k, v = rnd.choice(outs)           # may double spend
                ins.append((a, Decimal(v), tx, k))
            else:                                        # orphan or future output
                ins.append((f"a{rnd.randrange(n_addr)}", Decimal("1.5"), f"t{rnd.randrange(n_tx)}", 0))
        o = []
        for k in range(rnd.choice([0, 1, 1, 2, 3])):
            v = str(Decimal(rnd.randrange(1, 4000)) / 100)
            a = f"a{rnd.randrange(n_addr)}"
            o.append((a, Decimal(v), k))
            outs.append((a, f"t{i}", k, v))
        rows.append((f"t{i}", ts, ins, o, "r", ts, 0, i))
    order = list(range(n_tx))
    rnd.shuffle(order)                                   # arrival order != creation order
    return [r[:6] + (arr, r[7]) for arr, r in zip(sorted(rnd.sample(range(10**6), n_tx)), [rows[j] for j in order])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_ledgers_match_model(spark, seed):
    o = DEFAULT.with_(velocity_window_ms=300, velocity_count=3, structuring_window_ms=600,
                      structuring_count=2, structuring_ceiling=15.0)
    tx = spark.createDataFrame(_scenario(seed), TRANSACTION)
    upd = address_updates(tx).cache()
    rows = [dict(r.asDict(), order=(r.arrival_ms, r.seq, r.pos)) for r in upd.collect()]
    model, state = run_model(rows, o.velocity_window_ms, o.velocity_count, o.structuring_window_ms,
                             o.structuring_count, Decimal("15"))
    for opts in (o, o.with_(hot_key_rows=10, rows_per_bucket=3)):
        led = ledger(upd, opts)
        got = {(r.arrival_ms, r.seq, r.pos): (r.balance, r.utxo_count)
               for r in led.select("arrival_ms", "seq", "pos", "balance", "utxo_count").collect()}
        assert got == {k: (v[0], v[1]) for k, v in model.items()}
        counts = {(r.arrival_ms, r.seq, r.pos): (r.velocity_count, r.structuring_count)
                  for r in activity_counts(led, opts).collect()}
        assert counts == {k: (v[2], v[3]) for k, v in model.items()
                          if v[2] >= o.velocity_count or v[3] >= o.structuring_count}
    snap = {(r.address, r.tx_id, r.output_index) for r in utxo_snapshot(upd).collect()}
    assert snap == {(a, k[0], k[1]) for a, s in state.items() for k in s["utxos"]}
    pend = {(r.address, r.prev_tx_id, r.prev_output_index) for r in pending_spends(upd).collect()}
    assert pend == {(a, k[0], k[1]) for a, s in state.items() for k in s["pending"]}
    upd.unpersist()
