"""Helpers shared by the operators: staged tables in the cluster's shared
folder, column binding inside one expression, Arrow column building."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.session import checkpoint_dir

#: ASCII white space of the word contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and
    a lost executor costs a reread of the file, not the work before it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the
    body (and lambdas inside it) refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_mod(key: Column, n: int) -> Column:
    """``crc32(key as text) mod n``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % F.lit(n)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of the few types the Arrow stages return."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, kinds[t]) for n, t in (x.strip().split(" ") for x in ddl.split(","))])


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """Record batch from Python lists, numpy arrays or Arrow arrays by name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f in schema for c in [columns[f.name]]], schema=schema)


def text_bytes(value: pa.Scalar) -> bytes:
    """UTF-8 bytes of a string scalar without decoding; null is empty."""
    buf = value.as_buffer()
    return b"" if buf is None else buf.to_pybytes()


def slices(batches, rows: int = 512):
    """Arrow batches cut into slices, so that results of very long texts leave
    the worker early and memory stays bounded by a slice."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def worker_cache(key, make):
    """An object made once per Python worker (functions of this package travel
    by value, so their own globals do not outlive a task)."""
    import sys
    import types

    held = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def tiktoken_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
