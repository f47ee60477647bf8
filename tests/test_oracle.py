"""Every registered batch query against its DuckDB oracle (sf0.001; the
driver runs the same comparison at sf0.01, streams included)."""

from __future__ import annotations

from conftest import SF001
from oracle_check import run


def test_batch_queries_match_duckdb_oracle(spark):
    import __spark_entry__ as entry

    # queries of the optional subpackage have tests of their own (tests/llm)
    ledger = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]
    assert set(ledger) <= set(entry.oracle_sql())
    names = [n for n in ledger if not n.startswith("stream_")]
    res = run(SF001, names, spark=spark)
    bad = {k: v for k, v in res.items() if not v.get("ok")}
    assert not bad, bad
