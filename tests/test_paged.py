"""State in pages and buckets: same contents as plain maps, few calls, few partitions."""

from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from test_slots import State, rows
from utxoflow.options import DEFAULT
from utxoflow.schema import TRANSACTION
from utxoflow.sinks.versions import file_names
from utxoflow.streaming.paged import BUCKET, PAGE, PackedMap, Pages, line_start
from utxoflow.streaming.processor import LedgerProcessor
from utxoflow.streaming.stream import drain, read_state_pending, read_state_utxos, start_addr_query, start_split_query
from utxoflow.streaming.two_stage import OffsetProcessor, OutpointProcessor, read_entries, unpack
from utxoflow.plans.stream_queries import FILES, stream_fixture, transaction_batches


class Value:
    def __init__(self):
        self.held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Times:
    def getCurrentWatermarkInMs(self):
        return 0


NAMES = [None, "", "a", 'a"b', "a\nb", "[", ',0,1,2,true]\n["x"', "\\", "ü", "\ud800", *(f"t{i}" for i in range(40))]


def test_pages_hold_what_a_plain_map_holds():
    rng = random.Random(5)
    stored, plain, pages, size = {}, {}, 1, 0
    for step in range(60):
        p = Pages(stored.get, pages, size)
        for _ in range(rng.choice([1, 5, 60, 400])):
            key = (rng.choice(NAMES), rng.randrange(40))
            start, held = line_start(*key), plain.get(key)
            assert p.get(start) == held
            if held is not None and rng.random() < 0.3:
                p.remove(start)
                del plain[key]
            else:
                plain[key] = (rng.randrange(10**15), rng.randrange(10**13), rng.random() < 0.5)
                p.put(start, plain[key], held is None)
        for page, text in p.changed():
            stored[page] = text
        pages, size = p.pages, p.size
        assert size == len(plain) == sum(len(x.split("\n")) - 1 for x in stored.values() if x)
    assert pages > 1


def test_packed_records_are_what_a_map_state_holds():
    rng = random.Random(6)
    state, plain = State(), {}
    for step in range(40):
        m = PackedMap(state)
        assert m.exists() == bool(plain)
        for _ in range(rng.choice([1, 200])):
            key = (rng.choice(NAMES), rng.randrange(20))
            assert m.getValue(key) == plain.get(key)
            if rng.random() < 0.3:
                m.removeKey(key)
                plain.pop(key, None)
            else:
                plain[key] = (str(step), step, None, b"x")
                m.updateValue(key, plain[key])
        m.flush()
    assert plain and len(state) > 2
    m = PackedMap(state)
    assert all(m.getValue(k) == v for k, v in plain.items())


def test_a_step_asks_for_buckets_not_for_addresses():
    names = [f"a{k}" for k in range(40 * BUCKET)]
    ledger, state = LedgerProcessor(DEFAULT), State()
    for n in range(2):
        ledger.accounts, before = PackedMap(state), state.calls
        list(ledger.handleInputRows((0,), iter([rows([(a, "output", f"{a}-{n}", 1) for a in names])]), None))
    assert state.calls - before <= 2 * 64 + 2
    offsets, totals = OffsetProcessor(), State()
    sums = pd.DataFrame({"route": "a0", "what": "sum", "address": names, "tx_id": "", "timestamp_ms": 0, "source": "", "kind": "",
                         "units": "5", "n": 1, "arrival_ms": 0, "seq": 0, "pos": 0, "mark": 0})
    for n in range(2):
        offsets.totals, before = PackedMap(totals), totals.calls
        (out,) = offsets.handleInputRows(("a0",), iter([sums]), None)
        assert set(out["units"]) == {str(5 * n)}
    assert totals.calls - before <= 2 * 64 + 2


def test_outpoints_of_a_slot_are_read_and_written_by_pages():
    p = OutpointProcessor()
    p.entries, p.size, n = State(), Value(), 20 * PAGE
    batch = rows([(f"a{i % 7}", "output", f"t{i}", 1) for i in range(n)])
    list(p.handleInputRows((0,), iter([batch]), Times()))
    before = p.entries.calls
    spent = rows([(f"a{i % 7}", "input", f"t{i}", 0) for i in range(n)])
    out = pd.concat(list(p.handleInputRows((0,), iter([spent]), Times())))
    assert p.entries.calls - before <= 2 * 32 and p.size.get()[0] == 0 and not p.entries
    assert np.sum(out[out["packed"].isna()]["units"].astype(int)) == -n
    (updates,) = unpack([pa.RecordBatch.from_pandas(out[out["packed"].notna()])])  # all of them in one row
    assert updates.num_rows == n and set(updates.column("units").to_pylist()) == {"-1"}


def test_state_partitions_follow_the_cores_not_the_shuffles(spark):
    """A session for much data has hundreds of shuffle partitions; a micro-batch
    opened as many stores and wrote as many files a day."""
    one = Decimal(1)
    tx = [(f"t{i}", i, [], [(f"a{i % 5}", one, 0)], "s", i, i, i) for i in range(40)]
    tx += [("w\n", 50, [("a1", one, "t1", 0), (None, one, "no\"ne", 0)], [], "s", 50, 50, 50)]
    run = stream_fixture(spark, "", 2, tx=spark.createDataFrame(tx, TRANSACTION), files=FILES)
    session = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for start, name in ((start_addr_query, "q_addr"), (start_split_query, "q_split")):
            drain(start(transaction_batches(spark, run), f"{run}/{name}", f"{run}/ckpt", DEFAULT, trigger={"availableNow": True}))
            stores = [n for n in file_names(spark, f"{run}/ckpt/{name}/state/0") if n.isdigit()]
            assert 1 <= len(stores) <= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", session)
    want = {(f"a{i % 5}", f"t{i}", 0, 1.0, i) for i in range(40) if i != 1}
    assert {tuple(r) for r in read_state_utxos(spark, f"{run}/ckpt").collect()} == want
    assert [tuple(r) for r in read_state_pending(spark, f"{run}/ckpt").collect()] == [(None, 'no"ne', 0)]
    split = read_entries(spark, f"{run}/ckpt/q_split").withColumn("value", F.col("value_units") / 100_000_000)
    assert {(r.address, r.tx_id, r.output_index, r.value, r.timestamp) for r in split.collect() if not r.pending} == want
    assert [(r.address, r.tx_id, r.output_index) for r in split.collect() if r.pending] == [(None, 'no"ne', 0)]
