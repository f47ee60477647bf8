"""Sequential model of the reference's per-address processing, written from
batch ledger and of the streaming processor."""

from __future__ import annotations

from collections import defaultdict, deque
from decimal import Decimal


def run_model(updates, w_vel, n_vel, w_str, n_str, ceiling):
    """``updates``: dicts with address, kind, tx_id, timestamp, value (Decimal),
    prev_tx_id, prev_output_index, output_index, order (sortable arrival key).
    Returns {order: (balance, utxo_count, velocity, structuring)} and the final
    (utxos, pending) per address."""
    state = defaultdict(lambda: {"bal": Decimal(0), "utxos": {}, "pending": set(), "hist": deque()})
    out = {}
    window = max(w_vel, w_str)
    for u in sorted(updates, key=lambda r: r["order"]):
        s = state[u["address"]]
        t = u["timestamp"]
        if u["kind"] == "input":
            key = (u["prev_tx_id"], u["prev_output_index"])
            item = s["utxos"].pop(key, None)
            if item is not None:
                s["bal"] -= item
            else:
                s["pending"].add(key)
        else:
            key = (u["tx_id"], u["output_index"])
            if key in s["pending"]:
                s["pending"].remove(key)
            else:
                s["utxos"][key] = u["value"]
                s["bal"] += u["value"]
        s["hist"].append((t, u["kind"], u["value"]))
        while s["hist"] and t - s["hist"][0][0] > window:
            s["hist"].popleft()
        vel = sum(1 for ht, _k, _v in s["hist"] if t - ht <= w_vel)
        st = sum(1 for ht, k, v in s["hist"] if k == "output" and v <= ceiling and t - ht <= w_str)
        out[u["order"]] = (s["bal"], len(s["utxos"]), vel, st)
    return out, state
