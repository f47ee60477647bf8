"""The streaming ledger with no key that holds a whole address.

Keyed by address, one task applies all rows of a hot address.  But what an update
does depends on its own outpoint only, and a balance is a sum; so the work is
done in two stateful steps and a scan:

1. ``OutpointProcessor``, keyed by ``slot`` (a hash of address and outpoint): set
   and pending entries in RocksDB, one per outpoint; gives every update its
   change of balance and count, and per address the sum of the slot's changes.
   The rows of a slot are stepped through together, first updates of all
   outpoints, then second ones, in array steps.  The step runs in event-time mode
   behind ``withWatermark``: every row is stamped with the engine's watermark
   (W1, W2), which is the max event time of the micro-batches before minus the
   tolerance.  The event-time column is left out of the step's input, so the engine
   filters no late row (W3); they are flagged.
2. ``OffsetProcessor``, keyed by slots of addresses for the sums (at most one row
   per address and slot of outpoints): gives an address's balance and count before
   the micro-batch and keeps the one after it.  Updates pass it packed, a row to
   ``PACK`` of a slot, and are unpacked behind it.
3. The writer of the micro-batch takes running sums, with the offset as the row
   before all others, by the skew-safe scan of the batch ledger (``scan.py``): a hot
   address is cut into pieces of its order.

Within a micro-batch updates count in the order (arrival, seq, tx_id, pos), and
micro-batches one after the other, as in the keyed form, with equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from utxoflow.operators.ledger import ORDER
from utxoflow.operators.scan import prefix_scan, with_buckets
from utxoflow.operators.updates import address_updates
from utxoflow.operators.watermark import with_watermark
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.schema import MONEY_SUM
from utxoflow.session import pickle_by_value
from utxoflow.streaming.paged import PackedMap, Pages, line_start

UNITS = 100_000_000
OUTPOINT = ["address", "ref_tx", "ref_idx"]
#: What the second step gives: an update with its change, or an offset.
ROW = T.StructType([
    T.StructField("what", T.StringType()), T.StructField("address", T.StringType()),
    T.StructField("tx_id", T.StringType()), T.StructField("timestamp_ms", T.LongType()), T.StructField("source", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("units", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("arrival_ms", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("pos", T.IntegerType()),
    T.StructField("mark", T.LongType())])
_COLS = [f.name for f in ROW.fields]
#: Fields of a row between the steps: a sum of an address, or updates that pass packed.
STEP = T.StructType([
    T.StructField("route", T.StringType()), T.StructField("address", T.StringType()), T.StructField("units", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("packed", T.BinaryType())])
_STEP = [f.name for f in STEP.fields]
#: Updates in a packed row at most.
PACK = 20_000
NONE, UNSPENT, PENDING = 0, 1, 2


def slot_of(slots: int):
    return F.pmod(F.xxhash64(*OUTPOINT), F.lit(int(slots))).cast("int")


def address_slot(address: str, slots: int):
    """The slot of an address, of a null one too."""
    return F.pmod(F.xxhash64(F.col(address)), F.lit(int(slots))).cast("int")


def route_of(address: str, slots: int):
    return F.concat(F.lit("a"), address_slot(address, slots).cast("string"))


def apply_updates(first: np.ndarray, is_input: np.ndarray, units: np.ndarray, times: np.ndarray, state: np.ndarray, held: np.ndarray,
                  since: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Changes of balance units and count of updates sorted by (outpoint, order);
    ``first``: where each outpoint's updates start.  ``state``, ``held`` and
    ``since`` (what an outpoint holds, in units, from when) are brought up to
    date.  One array step per update of the outpoint with most updates."""
    d_units, d_n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
    ends = np.append(first[1:], len(units))
    open_, at = np.arange(len(first)), first.copy()
    while len(open_):
        row, own = at[open_], state[open_]
        spends, adds = is_input[row] & (own == UNSPENT), ~is_input[row] & (own != PENDING)
        d_units[row] = np.where(spends, -held[open_], np.where(adds, units[row], 0))
        d_n[row] = np.where(spends, -1, np.where(adds & (own == NONE), 1, 0))
        cancels = ~is_input[row] & (own == PENDING)
        state[open_] = np.where(spends | cancels, NONE, np.where(adds, UNSPENT, PENDING))
        held[open_] = np.where(adds, units[row], held[open_])
        since[open_] = np.where(adds, times[row], since[open_])
        at[open_] += 1
        open_ = open_[at[open_] < ends[open_]]
    return d_units, d_n


def named(column: pd.Series) -> pd.Series:
    """A text column with None for every kind of null."""
    return column.astype(object).where(column.notna(), None)


class SlotEntries(Pages):
    """Entries of a slot, one to an outpoint, in pages of a map state."""

    def __init__(self, state, numbers) -> None:
        super().__init__(self._stored, *((1, 0) if numbers is None else (int(numbers[1]), int(numbers[0]))))
        self.state, self.starts = state, {}

    def _stored(self, page: int) -> str | None:
        stored = self.state.getValue((page,)) if self.size else None
        return None if stored is None else stored[0]

    def read(self, keys: list[tuple]) -> list[tuple | None]:
        self.starts = {k: line_start(k[0], k[1], k[2]) for k in keys}
        return [self.get(start) for start in self.starts.values()]

    def put(self, key: tuple, value: tuple, new: bool) -> None:
        super().put(self.starts[key], value, new)

    def remove(self, key: tuple) -> None:
        super().remove(self.starts[key])

    def save(self) -> tuple[int, int]:
        """Write the pages that changed; (number of entries, of pages)."""
        for page, text in self.changed():
            if text:
                self.state.updateValue((page,), (text,))
            else:
                self.state.removeKey((page,))
        return self.size, self.pages


def change_entries(entries, batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Apply updates, in order per outpoint, to ``entries``; changes of balance
    units and count per row.  An outpoint is written once, and not at all when it
    comes and goes within the batch."""
    group = batch.groupby(OUTPOINT, sort=False, dropna=False).ngroup().to_numpy()
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    places = batch[OUTPOINT].iloc[order[first]]
    keys = [(a, t, int(i)) for a, t, i in zip(named(places["address"]), named(places["ref_tx"]), places["ref_idx"])]
    stored = entries.read(keys)
    state = np.array([NONE if s is None else PENDING if s[2] else UNSPENT for s in stored])
    held = np.array([0 if s is None else int(s[0]) for s in stored], np.int64)
    since = np.array([0 if s is None else int(s[1]) for s in stored], np.int64)
    was = state.copy(), held.copy(), since.copy()
    d_units, d_n = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
    d_units[order], d_n[order] = apply_updates(first, (batch["kind"] == "input").to_numpy()[order], batch["units"].to_numpy(np.int64)[order],
                                               batch["timestamp"].to_numpy(np.int64)[order], state, held, since)
    for i in np.flatnonzero((state == NONE) & (was[0] != NONE)).tolist():
        entries.remove(keys[i])
    changed = (state != was[0]) | (held != was[1]) | (since != was[2])
    for i in np.flatnonzero((state != NONE) & changed).tolist():
        entries.put(keys[i], (int(held[i]), int(since[i]), bool(state[i] == PENDING)), bool(was[0][i] == NONE))
    return d_units, d_n


class OutpointProcessor(StatefulProcessor):
    """Step 1.  ``entries``: per outpoint of the slot its unspent amount, or that
    a spend of it is pending, in pages; ``size``: how many entries and pages there are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getMapState("entries", "page int", "entries string")
        self.size = handle.getValueState("size", "n long, pages int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = int(timerValues.getCurrentWatermarkInMs())
        batch = pd.concat(list(rows), ignore_index=True)
        if not len(batch):
            return
        batch = batch.sort_values(["arrival_ms", "seq", "tx_id", "pos"], kind="mergesort", ignore_index=True)
        entries = SlotEntries(self.entries, self.size.get())
        units, n = change_entries(entries, batch)
        self.size.update(entries.save())
        updates = pd.DataFrame({
            "what": "update", "address": batch["address"], "tx_id": batch["tx_id"], "timestamp_ms": batch["timestamp"],
            "source": batch["source"], "kind": batch["kind"], "units": [str(u) for u in units.tolist()], "n": n,
            "arrival_ms": batch["arrival_ms"], "seq": batch["seq"], "pos": batch["pos"], "mark": mark})[_COLS]
        packed = [pack(updates.iloc[at:at + PACK]) for at in range(0, len(updates), PACK)]
        yield pd.DataFrame({"route": f"r{key[0]}", "address": None, "units": None, "n": 0, "packed": packed})[_STEP]
        total: dict[str | None, list[int]] = {}  # exact integers: a sum of amounts may not fit a long
        for address, u, m in zip(named(batch["address"]), units.tolist(), n.tolist()):
            own = total.setdefault(address, [0, 0])
            own[0] += u
            own[1] += m
        yield self._sums(total)

    @staticmethod
    def _sums(total: dict) -> pd.DataFrame:
        names = list(total)
        return pd.DataFrame({
            "route": "", "address": pd.Series(names, dtype=object), "units": [str(total[a][0]) for a in names],
            "n": [total[a][1] for a in names], "packed": None})[_STEP]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        entries = SlotEntries(self.entries, self.size.get())
        for r in initialState.assign(address=named(initialState["address"])).itertuples(index=False):
            key = (r.address, r.tx_id, int(r.output_index))
            entries.put(key, (int(r.value_units), int(r.timestamp), bool(r.pending)), entries.read([key])[0] is None)
        self.size.update(entries.save())

    def close(self) -> None:
        pass


def _arrow() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "integer": pa.int32()}
    return pa.schema([(f.name, kinds[f.dataType.typeName()]) for f in ROW.fields])


def pack(updates: pd.DataFrame) -> bytes:
    """Updates as one value: the second step has them pass, and a row costs it the
    same however much is in it."""
    batch = pa.RecordBatch.from_pandas(updates, _arrow(), preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (``ROW``) of what the second step gives."""
    schema = _arrow()
    for batch in batches:
        packed = batch.column("packed")
        for value in packed.drop_null():
            yield from pa.ipc.open_stream(value.as_buffer())
        rows = batch.filter(packed.is_null())
        if rows.num_rows:
            n = rows.num_rows
            blank = {"what": pa.array(["offset"] * n, pa.string())}
            for f in schema:
                empty = "" if f.type == pa.string() else 0
                blank.setdefault(f.name, rows.column(f.name) if f.name in ("address", "units", "n") else pa.array([empty] * n, f.type))
            yield pa.RecordBatch.from_arrays([blank[f.name].cast(f.type) for f in schema], schema=schema)


class OffsetProcessor(StatefulProcessor):
    """Step 2.  ``totals``: balance and count of every address of the slot after
    the micro-batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = PackedMap(handle.getMapState("totals", PackedMap.KEY, PackedMap.VALUE))

    def _save(self) -> None:
        if isinstance(self.totals, PackedMap):
            self.totals.flush()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0].startswith("r"):
            for part in rows:
                yield part[_STEP[1:]]
            return
        batch = pd.concat(list(rows), ignore_index=True)
        if not len(batch):
            return
        names = named(batch["address"]).tolist()
        total: dict[str | None, list[int]] = {}
        for address, u, m in zip(names, batch["units"], batch["n"].tolist()):
            own = total.setdefault(address, [0, 0])
            own[0] += int(u)
            own[1] += m
        old = self.totals.exists()
        before = {a: self.totals.getValue((a,)) if old else None for a in total}
        before = {a: (0, 0) if t is None else (int(t[0]), int(t[1])) for a, t in before.items()}
        for address, (u, m) in total.items():
            self.totals.updateValue((address,), (str(before[address][0] + u), before[address][1] + m))
        self._save()
        yield pd.DataFrame({"address": pd.Series(list(before), dtype=object), "units": [str(u) for u, _ in before.values()],
                            "n": [m for _, m in before.values()], "packed": None})[_STEP[1:]]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for r in initialState.assign(address=named(initialState["address"])).itertuples(index=False):
            self.totals.updateValue((r.address,), (str(int(r.units)), int(r.n)))
        self._save()

    def close(self) -> None:
        pass


def _initial(state: DataFrame, slots: int, address_slots: int) -> tuple[DataFrame, DataFrame]:
    """``ledger.ledger_state`` of a batch backfill as the two steps' initial states."""
    pending = F.col("part") == "pending"
    entries = state.filter(F.col("part").isin("utxo", "pending")).select(
        slot_of_names("address", "tx_id", "output_index", slots).alias("slot"), "address", "tx_id", "output_index",
        F.coalesce("value_units", F.lit(0)).cast("long").alias("value_units"),
        F.coalesce("timestamp", F.lit(0)).cast("long").alias("timestamp"), pending.alias("pending"))
    totals = state.filter(F.col("part") == "totals").select(
        route_of("address", address_slots).alias("route"), "address", F.col("balance_units").cast("string").alias("units"),
        F.col("utxo_count").cast("long").alias("n"))
    return entries, totals


def slot_of_names(address: str, tx: str, index: str, slots: int):
    return F.pmod(F.xxhash64(F.col(address), F.col(tx), F.col(index).cast("int")), F.lit(int(slots))).cast("int")


def change_stream(tx: DataFrame, opts: LedgerOptions = DEFAULT, initial: DataFrame | None = None) -> DataFrame:
    """Steps 1 and 2 on a stream of canonical transactions."""
    slots = opts.outpoint_slots
    timed = with_watermark(tx.withColumn("event_time", F.timestamp_millis("timestamp")), opts.late_tolerance_ms)
    upd = address_updates(timed).select(
        slot_of_names("address", "ref_tx", "ref_idx", slots).alias("slot"), *OUTPOINT, "tx_id", "timestamp", "kind", "pos", "source",
        (F.col("value") * F.lit(UNITS)).cast("long").alias("units"), "arrival_ms", "seq")
    entries, totals = (None, None) if initial is None else _initial(initial, slots, opts.address_slots)
    changes = upd.groupBy("slot").transformWithStateInPandas(
        statefulProcessor=OutpointProcessor(), outputStructType=STEP, outputMode="Append", timeMode="EventTime",
        initialState=None if entries is None else entries.groupBy("slot"))
    changes = changes.withColumn("route", F.when(F.col("packed").isNull(), route_of("address", opts.address_slots)).otherwise(F.col("route")))
    passed = changes.groupBy("route").transformWithStateInPandas(
        statefulProcessor=OffsetProcessor(), outputStructType=T.StructType(STEP.fields[1:]), outputMode="Append", timeMode="None",
        initialState=None if totals is None else totals.groupBy("route"))
    return passed.mapInArrow(unpack, ROW)


def balances_of(batch: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """Step 3: the balance records of a micro-batch of changes and offsets, with
    the watermark each met (``watermark_ms``, null before there is one)."""
    later = (F.col("what") == "update").cast("int")
    rows = batch.withColumns({
        "_later": later, "d_balance": (F.col("units").cast("decimal(28,8)") / F.lit(UNITS)).cast(MONEY_SUM)})
    order = ["_later", *ORDER]
    b, hot = with_buckets(rows, "address", order, opts)
    run = prefix_scan(b, "address", order, hot, sums={"balance": F.col("d_balance"), "utxo_count": F.col("n")})
    return run.filter("_later = 1").select(
        "address", "timestamp_ms", "source", F.col("balance").cast("double").alias("balance"), "utxo_count", "tx_id", "kind",
        "arrival_ms", "seq", "pos", F.when(F.col("mark") > 0, F.col("mark")).alias("watermark_ms"))


def read_entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Unspent and pending outpoints (L7, L8) from the state of step 1."""
    st = spark.read.format("statestore").option("operatorId", 1).option("stateVarName", "entries").load(checkpoint)
    return entry_rows(st.select(F.col("user_map_value.entries").alias("entries")), "address", "tx_id")


def entry_rows(pages: DataFrame, *names: str) -> DataFrame:
    """Rows of pages of ``entries`` (``paged``): of its names those that lie in the
    lines, then index, amount in units, time and whether a spend is pending."""
    line = F.explode(F.filter(F.split("entries", "\n"), lambda x: x != "")).alias("_e")
    e = pages.select(*[c for c in pages.columns if c != "entries"], line).withColumn("_e", F.from_json("_e", "array<string>"))
    fields = [*names, ("output_index", "int"), ("value_units", "long"), ("timestamp", "long"), ("pending", "boolean")]
    return e.select(*[c for c in e.columns if c != "_e"],
                    *[F.col("_e")[i].alias(f) if isinstance(f, str) else F.col("_e")[i].cast(f[1]).alias(f[0]) for i, f in enumerate(fields)])


pickle_by_value(__name__)
