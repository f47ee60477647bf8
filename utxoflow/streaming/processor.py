"""Streaming form of the address ledger (Q-addr): a ``StatefulProcessor`` run by
``transformWithStateInPandas`` on RocksDB state, keyed by slots of addresses.

A call per address would cost the same for one row as for thousands, and a
micro-batch has as many addresses as it likes.  So the key is a slot (a hash of the
address, ``address_slots`` of them); the rows of a slot's addresses are applied side
by side in array steps, and an address is only a key of the slot's maps.

State: ``accounts``, a map (address, page) -> balance, utxo_count, activity
buffer, number of pages and entries, and the page's entries.  An entry is an
outpoint that is unspent (value, timestamp) or that a spend is pending for.  Page 0
has all of an ordinary address, so that one read and one write serve all its
updates of a micro-batch; a large address has its entries in pages by their hash, of
about ``PAGE``, and a micro-batch reads and writes those that it meets.  The map's
records are packed (``paged.PackedMap``): the state store is asked once for a bucket
of them, not once for each.

The activity buffer is in arrival order, packed as 64-bit integers (``RECENT``).
Money crosses into Python as exact integer units of 1e-8 (``decimal(18,8)``
scaled by 10^8 in Spark).  Balances are Python integers, kept and returned as
digit strings, so no sum of amounts overflows; Spark turns them back into
decimals afterwards.

Within a micro-batch the rows of a slot are gathered, sorted by address and the
arrival order ``(arrival_ms, seq, tx_id, pos)`` and applied as the sequential
rules say.  No time mode is used: no row is filtered by a watermark (late ones are
flagged by the writer of the micro-batch), and the query ends by itself under
``availableNow``.
"""

from __future__ import annotations

import json
from itertools import accumulate
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from utxoflow.operators.activity import window_counts
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.streaming.paged import PAGE, PackedMap, Pages, line_start  # noqa: F401 - PAGE: of an address's entries
from utxoflow.streaming.two_stage import change_entries, named

OUTPUT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("tx_id", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("balance_units", T.StringType()),
    T.StructField("utxo_count", T.LongType()),
    T.StructField("update_kind", T.StringType()),
    T.StructField("alert_id", T.StringType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("details_json", T.StringType()),
    T.StructField("arrival_ms", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("pos", T.IntegerType()),
])

_COLS = [f.name for f in OUTPUT_SCHEMA.fields]


def _dumps(d: dict) -> str:
    return json.dumps(d, separators=(",", ":"))


#: Fields of a row of the activity buffer, packed as 64-bit integers.
RECENT = ["timestamp", "small", "arrival_ms", "seq", "pos"]


def unpack(recent) -> np.ndarray:
    return np.frombuffer(recent or b"", np.int64).reshape(-1, len(RECENT))


ACCOUNT = "balance_units string, utxo_count long, recent binary, pages int, size long, entries string"


class Account:
    """What is stored of an address; its entries are loaded page by page."""

    def __init__(self, state, address: str | None, stored) -> None:
        self.state, self.address = state, address
        balance, count, recent, pages, size, first = ("0", 0, None, 1, 0, None) if stored is None else stored
        self.balance, self.count, self.recent = int(balance), int(count), unpack(recent)
        self.entries = Pages(self._load, int(pages), int(size))
        self.entries.text[0] = first or ""

    def _load(self, page: int) -> str | None:
        stored = self.state.getValue((self.address, page))
        return None if stored is None else stored[5]

    def save(self) -> None:
        texts = dict(self.entries.changed())
        texts.setdefault(0, self.entries.content(0))
        own = (str(self.balance), self.count, self.recent.tobytes(), self.entries.pages, self.entries.size)
        for page, text in sorted(texts.items()):
            if page == 0 or text:
                self.state.updateValue((self.address, page), (*(own if page == 0 else ("", 0, None, 0, 0)), text))
            else:
                self.state.removeKey((self.address, page))


class AccountEntries:
    """The entries of many accounts under their full outpoints."""

    def __init__(self, accounts: dict) -> None:
        self.accounts, self.starts = accounts, {}

    def read(self, keys: list[tuple]) -> list[tuple | None]:
        self.starts = {k: line_start(k[1], k[2]) for k in keys}
        return [self.accounts[k[0]].entries.get(start) for k, start in self.starts.items()]

    def put(self, key: tuple, value: tuple, new: bool) -> None:
        self.accounts[key[0]].entries.put(self.starts[key], value, new)

    def remove(self, key: tuple) -> None:
        self.accounts[key[0]].entries.remove(self.starts[key])


class LedgerProcessor(StatefulProcessor):
    def __init__(self, opts: LedgerOptions = DEFAULT) -> None:
        self.opts = opts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accounts = PackedMap(handle.getMapState("accounts", PackedMap.KEY, PackedMap.VALUE))

    def _save(self, accounts: list[Account]) -> None:
        for x in accounts:
            x.save()
        if isinstance(self.accounts, PackedMap):
            self.accounts.flush()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, ends, accounts = self._arrived(rows)
        units, n = change_entries(AccountEntries({x.address: x for x in accounts}), batch)
        balances, counts = [], []
        for x, lo, hi in zip(accounts, [0, *ends], ends):
            balances += list(accumulate(units[lo:hi].tolist(), initial=x.balance))[1:]
            counts += list(accumulate(n[lo:hi].tolist(), initial=x.count))[1:]
            x.balance, x.count = balances[-1], counts[-1]
        velocity, structuring = self._activity(batch, accounts)
        self._save(accounts)
        yield self._output(batch, [str(b) for b in balances], counts, velocity, structuring)

    def _arrived(self, rows: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, list[int], list[Account]]:
        """The micro-batch of the slot sorted by address (numbered ``_a``) and
        arrival, where each address's rows end, and the accounts."""
        batch = pd.concat(list(rows), ignore_index=True)
        batch["_a"], found = pd.factorize(named(batch["address"]), use_na_sentinel=False)
        batch = batch.sort_values(["_a", "arrival_ms", "seq", "tx_id", "pos"], kind="mergesort", ignore_index=True)
        names = [None if pd.isna(x) else x for x in found]
        old = self.accounts.exists()
        accounts = [Account(self.accounts, x, self.accounts.getValue((x, 0)) if old else None) for x in names]
        return batch, np.cumsum(np.bincount(batch["_a"], minlength=len(names))).tolist(), accounts

    def _activity(self, batch: pd.DataFrame, accounts: list[Account]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the batch's rows over the stored buffers and the batch side
        by side; an account gets the buffer of its last row."""
        o = self.opts
        w = o.activity_window_ms
        history = [x.recent for x in accounts]
        fresh = batch[RECENT].to_numpy(np.int64)
        rows = np.concatenate([*history, fresh])
        group = np.concatenate([np.repeat(np.arange(len(history)), [len(x) for x in history]), batch["_a"].to_numpy()])
        order = np.argsort(group, kind="stable")  # of an address, what is stored and then the batch
        rows, group, new = rows[order], group[order], order >= len(rows) - len(fresh)
        ts = rows[:, 0]
        times, rank = np.unique(ts, return_inverse=True)
        peak = times[np.maximum.accumulate(group * len(times) + rank) - group * len(times)]
        counts = window_counts(group, ts, peak, rows[:, 1] != 0, w, o.velocity_window_ms, o.structuring_window_ms, at=np.flatnonzero(new))
        last = np.append(np.flatnonzero(np.diff(group)), len(group) - 1)
        keep = peak >= peak[last][group] - w  # an address's buffer is a suffix; never empty, its last row is in it
        cuts = np.cumsum(np.bincount(group[keep], minlength=len(history)))[:-1]
        for x, recent in zip(accounts, np.split(rows[keep], cuts)):
            x.recent = recent
        return counts

    def _output(self, batch, balances, counts, velocity, structuring) -> pd.DataFrame:
        """A balance row per update, then the alerts, all with the state after
        the update (no nulls in numeric columns: nullable ints do not
        round-trip Arrow)."""
        o = self.opts
        n = len(batch)
        base = {
            "kind": "balance", "address": batch["address"], "tx_id": batch["tx_id"], "timestamp_ms": batch["timestamp"],
            "source": batch["source"], "balance_units": balances, "utxo_count": counts, "update_kind": batch["kind"],
            "arrival_ms": batch["arrival_ms"], "seq": batch["seq"], "pos": batch["pos"],
            **{c: None for c in ("alert_id", "alert_type", "severity", "details_json")}}
        parts = [{c: self._column(v, n) for c, v in base.items()}]
        for name, kind, severity, found, least, extra in (
                ("velocity", "velocity_spike", "medium", velocity, o.velocity_count, {"window_ms": o.velocity_window_ms}),
                ("structuring", "structuring", "high", structuring, o.structuring_count,
                 {"window_ms": o.structuring_window_ms, "ceiling": float(o.structuring_ceiling)})):
            at = np.flatnonzero(found >= least)
            if len(at):
                hit = {c: v[at] for c, v in parts[0].items()}
                ids = [None if t is None else f"{t}:{a}:{name}" for t, a in zip(hit["tx_id"], hit["address"])]
                details = [_dumps({"events_in_window": int(x), **extra}) for x in found[at]]
                new = {"kind": "alert", "alert_id": ids, "alert_type": kind, "severity": severity, "details_json": details}
                parts.append({**hit, **{c: self._column(v, len(at)) for c, v in new.items()}})
        return pd.DataFrame({c: np.concatenate([x[c] for x in parts]) for c in _COLS})

    @staticmethod
    def _column(values, n: int) -> np.ndarray:
        """An array of ``n`` values, or of one ``n`` times; None for every null text."""
        if values is None or isinstance(values, str):
            return np.full(n, values, object)
        if isinstance(values, pd.Series):
            return named(values).to_numpy() if values.dtype == object else values.to_numpy()
        return np.array(values, np.int64 if values and isinstance(values[0], int) else object)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Start from a batch-computed ledger (``ledger_state``).  May be
        called several times per key (one call per chunk): every part is
        merged, and the activity buffer is kept in arrival order."""
        state = initialState.assign(address=named(initialState["address"]))
        for address, g in state.groupby("address", dropna=False):
            address = None if pd.isna(address) else address
            x = Account(self.accounts, address, self.accounts.getValue((address, 0)))
            for r in g[g["part"] == "totals"].itertuples(index=False):
                x.balance, x.count = int(r.balance_units), int(r.utxo_count)
            for r in g[g["part"] == "utxo"].itertuples(index=False):
                self._put(x, r, (int(r.value_units), int(r.timestamp), False))
            for r in g[g["part"] == "pending"].itertuples(index=False):
                self._put(x, r, (0, 0, True))
            rows = np.concatenate([x.recent, g.loc[g["part"] == "recent", RECENT].to_numpy(np.int64)])
            x.recent = rows[np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2]))]
            self._save([x])

    @staticmethod
    def _put(account: Account, row, value: tuple) -> None:
        start = line_start(row.tx_id, int(row.output_index))
        account.entries.put(start, value, account.entries.get(start) is None)

    def close(self) -> None:
        pass


class ActivityProcessor(LedgerProcessor):
    """Velocity and structuring alone: of the accounts, the activity buffers."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, _, accounts = self._arrived(rows)
        velocity, structuring = self._activity(batch, accounts)
        self._save(accounts)
        out = self._output(batch, ["0"] * len(batch), [0] * len(batch), velocity, structuring)
        yield out[out["kind"] == "alert"]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        super().handleInitialState(key, initialState[initialState["part"] == "recent"], timerValues)


# Worker code travels by value with the task (no package install needed).
from utxoflow.session import pickle_by_value  # noqa: E402

pickle_by_value(__name__)
pickle_by_value("utxoflow.operators.activity")
