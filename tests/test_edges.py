"""Hand-written edge rows (FIXTURES.md section 5)."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from model import run_model
from utxoflow.operators.activity import activity_counts, late_alerts
from utxoflow.operators.alerts import tx_alerts
from utxoflow.operators.ledger import ledger, pending_spends, utxo_snapshot
from utxoflow.operators.transactions import tx_metrics
from utxoflow.operators.updates import address_updates
from utxoflow.operators.watermark import with_arrival_watermark
from utxoflow.options import DEFAULT
from utxoflow.schema import TRANSACTION
from utxoflow.sinks import archive_blocks
from utxoflow.sources import parse_transactions

D = Decimal


def mk(spark, rows):
    """rows: (tx_id, ts, inputs[(addr, value, prev_tx, prev_idx)], outputs[(addr, value)], arrival)."""
    data = []
    for i, (tx_id, ts, ins, outs, arr) in enumerate(rows):
        data.append((tx_id, ts, [(a, D(str(v)), p, j) for a, v, p, j in ins],
                     [(a, D(str(v)), k) for k, (a, v) in enumerate(outs)], "t", ts, arr, i))
    return spark.createDataFrame(data, TRANSACTION)


def test_fan_out_boundaries_and_coinbase(spark):
    rows = [(f"t{n}", 1000, [], [(f"a{k}", 1) for k in range(n)], 1000 + n) for n in (7, 8, 9)]
    rows.append(("spend8", 2000, [("payer", 8, "t8", 0)], [(f"b{k}", 1) for k in range(8)], 3000))
    got = {r.tx_id: r.address for r in tx_alerts(mk(spark, rows), DEFAULT.with_(whale_threshold=1e9)).collect()}
    assert got == {"t8": "coinbase", "t9": "coinbase", "spend8": "payer"}


def test_whale_exactly_at_threshold_and_empty_outputs(spark):
    rows = [("at", 1, [], [("w", 40)], 1), ("below", 1, [], [("w", "39.99999999")], 2),
            ("none", 1, [("x", 5, "p", 0)], [], 3)]
    al = tx_alerts(mk(spark, rows), DEFAULT, rules=("whale",)).collect()
    assert {r.tx_id for r in al} == {"at"}
    none = tx_alerts(mk(spark, rows), DEFAULT.with_(whale_threshold=0.0), rules=("whale",)).collect()
    assert {r.tx_id: r.address for r in none}["none"] == "unknown"
    assert json.loads([r for r in al if r.tx_id == "at"][0].details_json) == {"total_output": 40.0}


def test_fee_clamp_and_empty_arrays(spark):
    rows = [("a", 1, [("x", 5, "p", 0)], [("y", 7)], 1), ("b", 1, [], [], 2)]
    m = {r.tx_id: r for r in tx_metrics(mk(spark, rows)).collect()}
    assert m["a"].fee_estimate == 0.0 and m["a"].total_input == 5.0 and m["a"].total_output == 7.0
    assert (m["b"].input_count, m["b"].output_count, m["b"].total_output) == (0, 0, 0.0)
    assert address_updates(mk(spark, rows[1:])).count() == 0


def test_address_twice_in_one_tx_keeps_multiplicity(spark):
    o = DEFAULT.with_(velocity_window_ms=1000, velocity_count=2)
    rows = [("t1", 100, [], [("a", 1), ("a", 2)], 1)]
    upd = address_updates(mk(spark, rows))
    led = ledger(upd, o).orderBy("pos").collect()
    assert [(r.balance, r.utxo_count) for r in led] == [(D("1"), 1), (D("3"), 2)]
    ids = [r.tx_id for r in activity_counts(ledger(upd, o), o).collect() if r.velocity_count >= 2]
    assert ids == ["t1"]


def test_spend_before_output_double_spend_and_orphan(spark):
    rows = [
        ("s1", 10, [("a", 5, "o1", 0)], [], 1),      # spend before its output
        ("o1", 5, [], [("a", 5)], 2),                # output arrives: both cancel
        ("o2", 6, [], [("a", 7)], 3),
        ("s2", 11, [("a", 7, "o2", 0)], [], 4),      # spends o2
        ("s2b", 12, [("a", 7, "o2", 0)], [], 5),     # double spend after: pending
        ("s3", 13, [("a", 1, "ghost", 0)], [], 6),   # orphan spend: pending forever
    ]
    upd = address_updates(mk(spark, rows))
    assert {(r.prev_tx_id, r.prev_output_index) for r in pending_spends(upd).collect()} == {("o2", 0), ("ghost", 0)}
    assert utxo_snapshot(upd).count() == 0
    bal = [(r.tx_id, r.balance, r.utxo_count) for r in ledger(upd).orderBy("arrival_ms").collect()]
    assert bal == [("s1", 0, 0), ("o1", 0, 0), ("o2", 7, 1), ("s2", 0, 0), ("s2b", 0, 0), ("s3", 0, 0)]


def test_window_edges_and_early_pop(spark):
    """Exactly ``window`` old counts, ``window + 1`` does not; an out-of-order
    arrival with a future timestamp pops the buffer early."""
    o = DEFAULT.with_(velocity_window_ms=100, velocity_count=1, structuring_window_ms=100,
                      structuring_count=1, structuring_ceiling=10.0)
    rows = [("e1", 1000, [], [("a", 1)], 1), ("e2", 1100, [], [("a", 1)], 2),   # e1 exactly 100 old
            ("e3", 1201, [], [("a", 1)], 3),                                    # e2 101 old
            ("f1", 5000, [], [("a", 1)], 4),                                    # future: pops all
            ("l1", 1202, [], [("a", 1)], 5)]    # late: e* are gone, f1 (future ts) still counts
    upd = address_updates(mk(spark, rows))
    got = {r.tx_id: r.velocity_count for r in activity_counts(ledger(upd, o), o).collect()}
    assert got == {"e1": 1, "e2": 2, "e3": 1, "f1": 1, "l1": 2}
    model, _ = run_model([dict(r.asDict(), order=(r.arrival_ms, r.seq, r.pos)) for r in upd.collect()],
                         100, 1, 100, 1, D("10"))
    assert sorted(v[2] for v in model.values()) == sorted(got.values())


def test_watermark_equal_is_not_late(spark):
    o = DEFAULT.with_(late_tolerance_ms=100)
    rows = [("a", 1000, [], [("x", 1)], 1), ("eq", 900, [], [("x", 1)], 2), ("late", 899, [], [("x", 1)], 3)]
    w = with_arrival_watermark(mk(spark, rows), o)
    late = {r.tx_id for r in tx_metrics(w).collect() if r.is_late}
    assert late == {"late"}
    al = late_alerts(address_updates(w)).collect()
    assert [(r.tx_id, json.loads(r.details_json)) for r in al] == [("late", {"watermark": 900, "lateness_ms": 1})]


def test_archive_missing_height_and_bad_json(spark):
    raw = spark.createDataFrame([('{"height": 5, "v": 1}', 1), ('{"v": 2}', 2), ('{"height": 5, "v": 3}', 3),
                                 ('{"height": ', 4)], "value string, offset long")
    arch, rej = archive_blocks(raw)
    assert [(r.height, r.offset) for r in arch.collect()] == [("5", 3)]
    assert {(r.offset, r.reason) for r in rej.collect()} == {(2, "missing_height"), (4, "bad_json")}


def test_parse_string_timestamp_and_quarantine(spark):
    good = {"tx_id": "t", "timestamp": "1234", "inputs": [], "outputs": [{"address": "a", "value": 1.123456789,
                                                                           "output_index": 0}], "source": "s"}
    raw = spark.createDataFrame([(json.dumps(good), 1, 1), ('{"tx_id": "u", "timest', 2, 2)],
                                "value string, arrival_ms long, offset long")
    tx, bad = parse_transactions(raw, ingest_time=F.lit(7))
    r = tx.collect()
    assert len(r) == 1 and r[0].timestamp == 1234 and r[0].outputs[0].value == D("1.12345679")
    assert [(b.offset, b.reason) for b in bad.collect()] == [(2, "malformed_json")]


@pytest.mark.parametrize("bad", ["nan", "abc"])
def test_parse_bad_timestamp_quarantined(spark, bad):
    raw = spark.createDataFrame([(json.dumps({"tx_id": "t", "timestamp": bad}), 1, 1)],
                                "value string, arrival_ms long, offset long")
    tx, q = parse_transactions(raw)
    assert tx.count() == 0 and q.first().reason == "bad_timestamp"
