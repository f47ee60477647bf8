"""The two-stage streaming ledger against the sequential rules and the batch one."""

from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from model import run_model
from test_random_ledger import _scenario
from utxoflow.operators.activity import activity_alerts, activity_counts
from utxoflow.operators.ledger import ledger, ledger_state
from utxoflow.operators.updates import address_updates
from utxoflow.options import DEFAULT
from utxoflow.plans.fixtures import FXB_OPTIONS, fx_b
from utxoflow.plans.stream_queries import FILES, stream_batches, stream_fixture, transaction_batches
from utxoflow.schema import TRANSACTION
from utxoflow.session import checkpoint_dir
from utxoflow.sinks.versions import file_names, read_live
from utxoflow.streaming.stream import drain, start_activity_query, start_split_query
from utxoflow.streaming.two_stage import NONE, PENDING, UNSPENT, apply_updates, read_entries

TRIGGER = {"availableNow": True}


def plain(events, state, held):
    """The rules of one outpoint, one update after the other."""
    out = []
    for is_input, units in events:
        if is_input and state == UNSPENT:
            out.append((-held, -1))
            state = NONE
        elif is_input:
            out.append((0, 0))
            state = PENDING
        elif state == PENDING:
            out.append((0, 0))
            state = NONE
        else:
            out.append((units, 1 if state == NONE else 0))
            state, held = UNSPENT, units
    return out, state, held


def test_array_steps_against_plain_rules():
    rng = random.Random(1)
    for _ in range(300):
        groups = [[(rng.random() < 0.5, rng.randrange(1, 10**12)) for _ in range(rng.choice([1, 1, 2, 3, 9]))] for _ in range(rng.randint(1, 12))]
        before = [(rng.choice([NONE, UNSPENT, PENDING]), rng.randrange(1, 100)) for _ in groups]
        rows = [e for g in groups for e in g]
        first = np.cumsum([0] + [len(g) for g in groups[:-1]])
        state, held = np.array([s for s, _ in before]), np.array([h for _, h in before], np.int64)
        units, n = apply_updates(first, np.array([e[0] for e in rows]), np.array([e[1] for e in rows], np.int64), np.arange(len(rows)),
                                 state, held, np.zeros(len(groups), np.int64))
        want = [plain(g, *b) for g, b in zip(groups, before)]
        assert list(zip(units.tolist(), n.tolist())) == [x for w, _, _ in want for x in w]
        assert state.tolist() == [s for _, s, _ in want]
        assert all(h == w[2] for h, s, w in zip(held.tolist(), state.tolist(), want) if s == UNSPENT)


def run_split(spark, tx, o, batches=3, initial=None):
    run = stream_fixture(spark, SF001, batches, tx=tx, files=FILES)
    q = start_split_query(transaction_batches(spark, run), f"{run}/out", f"{run}/ckpt", o, trigger=TRIGGER, initial=initial)
    drain(q)
    return run


def test_adversarial_updates_match_the_model(spark):
    """Double spends, orphans, spends before outputs, ties, future times; hot
    addresses cut into pieces; few slots, so that many outpoints share one."""
    o = DEFAULT.with_(outpoint_slots=5, hot_key_rows=20, rows_per_bucket=7)
    tx = spark.createDataFrame(_scenario(7, n_tx=240), TRANSACTION)
    run = run_split(spark, tx, o)
    rows = [dict(r.asDict(), order=(r.arrival_ms, r.seq, r.pos)) for r in address_updates(tx).collect()]
    model, _ = run_model(rows, 300, 3, 600, 2, Decimal("15"))
    got = {(r.arrival_ms, r.seq, r.pos): (Decimal(str(r.balance)), r.utxo_count)
           for r in read_live(spark, f"{run}/out/balance_updates").collect()}
    assert got == {k: (v[0], v[1]) for k, v in model.items()}
    assert not [n for n in file_names(spark, checkpoint_dir(spark)) if "scratch" in n]  # a stream leaves no pieces behind


def test_late_rows_are_kept_and_flagged_with_the_engines_watermark(spark):
    o = FXB_OPTIONS.with_(outpoint_slots=8)
    tx = fx_b(spark, SF001, None, o)
    run = run_split(spark, tx, o)
    batches = stream_batches(tx, 3)
    highest = {r._b: r.m for r in batches.groupBy("_b").agg(F.max("timestamp").alias("m")).collect()}
    marks = {b: max((m for e, m in highest.items() if e < b), default=None) for b in highest}
    of_tx = {r.tx_id: marks[r._b] and marks[r._b] - o.late_tolerance_ms for r in batches.collect()}
    rows = read_live(spark, f"{run}/out/balance_updates").collect()
    assert len(rows) == address_updates(tx).count()
    assert all(r.watermark_ms == of_tx[r.tx_id] for r in rows)
    late = sorted(f"{r.tx_id}:{r.address}:late" for r in rows if r.watermark_ms is not None and r.timestamp_ms < r.watermark_ms)
    assert late and late == sorted(r.alert_id for r in read_live(spark, f"{run}/out/alerts").collect())


def test_backfill_then_split_stream_equals_batch(spark):
    o = FXB_OPTIONS.with_(outpoint_slots=8)
    tx = fx_b(spark, SF001, "double", o).cache()
    split = tx.approxQuantile("arrival_ms", [0.5], 0.0)[0]
    rest = tx.filter(F.col("arrival_ms") >= split)
    init = ledger_state(address_updates(tx.filter(F.col("arrival_ms") < split)), o)
    run = run_split(spark, rest, o, 2, init)
    full = ledger(address_updates(tx), o).filter(F.col("arrival_ms") >= split)
    want = full.select("arrival_ms", "seq", "pos", F.col("balance").cast("double").alias("balance"), "utxo_count")
    got = read_live(spark, f"{run}/out/balance_updates").select("arrival_ms", "seq", "pos", "balance", "utxo_count")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    entries = {(r.address, r.tx_id, r.pending) for r in read_entries(spark, f"{run}/ckpt/q_split").collect()}
    end = ledger_state(address_updates(tx), o).filter(F.col("part").isin("utxo", "pending")).collect()
    assert entries == {(r.address, r.tx_id, r.part == "pending") for r in end}

    q = start_activity_query(transaction_batches(spark, run), f"{run}/act", f"{run}/ckpt-act", o, trigger=TRIGGER, initial=init)
    drain(q)
    counts = activity_counts(ledger(address_updates(tx), o), o).filter(F.col("arrival_ms") >= split)
    want_al = activity_alerts(counts, o).select("alert_id", "details_json")
    got_al = read_live(spark, f"{run}/act/alerts_activity").select("alert_id", "details_json")
    assert got_al.count() == want_al.count() and got_al.exceptAll(want_al).count() == 0
    tx.unpersist()


def test_amounts_beyond_a_long_and_null_addresses(spark):
    big = Decimal("9999999999.99999999")
    rows = [(f"t{i}", i, [], [("a" if i % 2 else None, big, 0)], "s", i, i, i) for i in range(40)]
    rows += [("u", 50, [("a", big, "t1", 0), (None, big, "t2", 0)], [], "s", 50, 50, 50)]
    tx = spark.createDataFrame(rows, TRANSACTION)
    run = run_split(spark, tx, DEFAULT.with_(outpoint_slots=3), 2)
    last = read_live(spark, f"{run}/out/balance_updates").filter("tx_id = 'u'").collect()
    assert {(r.address, r.balance, r.utxo_count) for r in last} == {("a", float(big * 19), 19), (None, float(big * 19), 19)}
