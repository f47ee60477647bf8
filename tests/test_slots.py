"""State steps keyed by slots of addresses: how often they go to the state, and
the pages of a large address."""

from __future__ import annotations

import pandas as pd

from utxoflow.options import DEFAULT
from utxoflow.streaming.processor import PAGE, ActivityProcessor, LedgerProcessor
from utxoflow.streaming.two_stage import OffsetProcessor


class State(dict):
    """A map state that counts the round trips to it."""

    calls = 0

    def _called(self):
        self.calls += 1

    def exists(self):
        self._called()
        return bool(self)

    def getValue(self, key):
        self._called()
        return self.get(key)

    def updateValue(self, key, value):
        self._called()
        self[key] = value

    def removeKey(self, key):
        self._called()
        self.pop(key, None)


def step(kind, addresses, state, batch):
    p = kind(DEFAULT)
    p.accounts = state
    before = state.calls
    out = pd.concat(list(p.handleInputRows((0,), iter([batch]), None)))
    return out[out["kind"] == "balance"], state.calls - before


def rows(updates):
    """(address, kind, outpoint, units) in arrival order."""
    return pd.DataFrame([
        {"address": a, "tx_id": t if kind == "output" else f"by-{t}", "timestamp": i, "kind": kind, "pos": 0, "ref_tx": t, "ref_idx": 0,
         "source": "s", "arrival_ms": i, "seq": i, "units": u, "small": False} for i, (a, kind, t, u) in enumerate(updates)])


def test_an_account_is_read_and_written_once():
    names = [None, *(f"a{k}" for k in range(49))]
    updates = [(a, "output", f"{a}-{i}", 10 + i) for i in range(20) for a in names]
    state = State()
    out, calls = step(LedgerProcessor, names, state, rows(updates))
    assert len(out) == 1000 and calls <= 2 * len(names) + 1
    spends = [(a, "input", f"{a}-{i}", 0) for i in (3, 3, 99) for a in names]  # the second one and the unknown one are pending
    out, calls = step(LedgerProcessor, names, state, rows(spends))
    assert calls <= 2 * len(names) + 1
    total = sum(range(10, 30))
    assert {(b, n) for b, n in zip(out["balance_units"], out["utxo_count"])} == {(str(total - 13), 19)}
    out, _ = step(LedgerProcessor, names, state, rows([(a, "output", f"{a}-99", 7) for a in names]))  # cancels the pending spend
    assert {(b, n) for b, n in zip(out["balance_units"], out["utxo_count"])} == {(str(total - 13), 19)}


def test_a_large_address_is_kept_in_pages():
    state = State()
    step(LedgerProcessor, ["a"], state, rows([("a", "output", f"t{i}", 1) for i in range(20 * PAGE)]))
    pages = state[("a", 0)][3]
    assert pages >= 16 and len(state) == pages
    out, calls = step(LedgerProcessor, ["a"], state, rows([("a", "input", f"t{i}", 0) for i in range(5)]))
    assert out["utxo_count"].tolist()[-1] == 20 * PAGE - 5 and calls <= 2 * 6 + 1
    out, _ = step(LedgerProcessor, ["a"], state, rows([("a", "input", f"t{i}", 0) for i in range(5, 20 * PAGE)]))
    assert out["balance_units"].tolist()[-1] == "0" and list(state) == [("a", 0)]


def test_activity_and_offsets_of_many_addresses_in_one_call():
    state = State()
    names = [f"a{k}" for k in range(40)]
    p = ActivityProcessor(DEFAULT.with_(velocity_count=2))
    p.accounts = state
    batch = rows([(a, "output", f"{a}-{i}", 1) for i in range(2) for a in names])
    out = pd.concat(list(p.handleInputRows((0,), iter([batch]), None)))
    assert sorted(out["address"]) == sorted(names) and set(out["alert_type"]) == {"velocity_spike"}
    assert state.calls <= 2 * len(names) + 1
    q = OffsetProcessor()
    q.totals = State()
    sums = pd.DataFrame({"route": "a0", "what": "sum", "address": [*names, *names], "tx_id": "", "timestamp_ms": 0, "source": "", "kind": "",
                         "units": "5", "n": 1, "arrival_ms": 0, "seq": 0, "pos": 0, "mark": 0})
    for before in (0, 10):
        (out,) = q.handleInputRows(("a0",), iter([sums]), None)
        assert sorted(out["address"]) == sorted(names) and set(out["units"]) == {str(before)} and set(out["n"]) == {before // 5}
