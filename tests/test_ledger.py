"""Batch ledger vs the sequential model; skew path vs default path."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from model import run_model
from utxoflow.operators.activity import activity_counts
from utxoflow.operators.ledger import ledger, pending_spends, utxo_snapshot
from utxoflow.operators.updates import address_updates
from utxoflow.plans.fixtures import FXB_OPTIONS, fx_b

O = FXB_OPTIONS


def _updates(spark, variant=None):
    return address_updates(fx_b(spark, SF01, variant, O))


def _model_input(upd):
    rows = upd.select("address", "kind", "tx_id", "timestamp", "value", "prev_tx_id", "prev_output_index",
                      "output_index", "arrival_ms", "seq", "pos").collect()
    return [dict(r.asDict(), order=(r.arrival_ms, r.seq, r.pos)) for r in rows]


@pytest.mark.parametrize("variant", [None, "orphan", "double"])
@pytest.mark.parametrize("hot", [False, True])
def test_ledger_matches_sequential_model(spark, variant, hot):
    opts = O.with_(hot_key_rows=20, rows_per_bucket=7) if hot else O
    upd = _updates(spark, variant)
    model, state = run_model(_model_input(upd), O.velocity_window_ms, O.velocity_count,
                             O.structuring_window_ms, O.structuring_count, Decimal("20"))
    led = ledger(upd, opts).select("arrival_ms", "seq", "pos", "balance", "utxo_count", "_hot").collect()
    assert len(led) == len(model)
    if hot:
        assert any(r._hot for r in led), "the skew path was not exercised"
    for r in led:
        bal, cnt, _v, _s = model[(r.arrival_ms, r.seq, r.pos)]
        assert (r.balance, r.utxo_count) == (bal, cnt)

    snap = {(r.address, r.tx_id, r.output_index) for r in utxo_snapshot(upd).collect()}
    assert snap == {(a, k[0], k[1]) for a, s in state.items() for k in s["utxos"]}
    pend = {(r.address, r.prev_tx_id, r.prev_output_index) for r in pending_spends(upd).collect()}
    assert pend == {(a, k[0], k[1]) for a, s in state.items() for k in s["pending"]}


@pytest.mark.parametrize("hot", [False, True])
def test_activity_counts_match_model(spark, hot):
    opts = O.with_(hot_key_rows=20, rows_per_bucket=7) if hot else O
    upd = _updates(spark, "double")
    model, _ = run_model(_model_input(upd), O.velocity_window_ms, O.velocity_count,
                         O.structuring_window_ms, O.structuring_count, Decimal("20"))
    got = {(r.arrival_ms, r.seq, r.pos): (r.velocity_count, r.structuring_count)
           for r in activity_counts(ledger(upd, opts), opts).collect()}
    want = {k: (v[2], v[3]) for k, v in model.items() if v[2] >= O.velocity_count or v[3] >= O.structuring_count}
    assert got == want


def test_final_state_invariant_under_arrival_permutation(spark):
    """Without double spends the final unspent set and balances do not depend
    on the arrival order."""
    upd = _updates(spark)
    shuffled = upd.withColumn("arrival_ms", F.xxhash64("tx_id"))
    a = {r.address: r.balance for r in ledger(upd, O).groupBy("address").agg(
        F.max_by("balance", F.struct("arrival_ms", "seq", "pos")).alias("balance")).collect()}
    b = {r.address: r.balance for r in ledger(shuffled, O).groupBy("address").agg(
        F.max_by("balance", F.struct("arrival_ms", "seq", "pos")).alias("balance")).collect()}
    assert a == b
    total = utxo_snapshot(upd).agg(F.sum(F.col("value").cast("decimal(38,8)"))).first()[0]
    assert total == sum(a.values())
