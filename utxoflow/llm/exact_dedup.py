"""Exact deduplication by Grace hashing.

Texts are equal when identical after deleting ASCII white space.  Records are
partitioned by a hash of the normalised text; each partition is read by one
task that keeps an open-addressing table of complete contents.  Contents that
no longer fit the table are spilled to a Parquet file in
the shared folder, partitioned again by another hash, and so on until nothing
is spilled.  A content already in the table is never spilled, so every level
finishes at least one content per partition and every content is decided by
one table that compared it byte for byte.

Before the first shuffle each map task collapses the copies it has itself
(one record per content and window, with a bounded list of members), so a group
holding a third of all rows sends its text once per window only.  The members stay
in the written records: the tables decide the class of a record, and its members
get the verdict by a join on the record, so no task holds the members of a group.

Defined results: null text counts as empty; empty texts form one group; rows
that repeat a doc_id (or a whole row) are rows of their own, exactly one row
of a group is kept; a null doc_id loses ties; an empty table gives no rows;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utxoflow.llm.common import SPACE, SPACE_BYTES, arrow_schema, batch_of, shared_path, staged, text_bytes
from utxoflow.session import pickle_by_value

RECORD = ("rec bigint, h bigint, content binary, n bigint, best_n bigint, best_id bigint, best_at int, ids array<bigint>, "
          "sizes array<bigint>")
DECIDED = "rec bigint, class_id bigint, text_sha256 string, h bigint, content binary"


class ContentTable:
    """Open-addressing (linear probing) table from complete contents to slots
    0, 1, ...; the hash only picks where probing starts."""

    def __init__(self, bits: int = 10):
        self.mask = (1 << bits) - 1
        self.cells = array("q", [-1]) * (self.mask + 1)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """(slot or -1, cell where the probe ended)."""
        at = (h ^ (h >> 32)) & self.mask
        while (slot := self.cells[at]) >= 0:
            if self.hashes[slot] == h and self.contents[slot] == content:
                return slot, at
            at = (at + 1) & self.mask
        return -1, at

    def add(self, cell: int, h: int, content: bytes) -> int:
        slot = len(self.contents)
        self.cells[cell] = slot
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 120
        if 2 * slot > self.mask:
            self._grow()
        return slot

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.cells = array("q", [-1]) * (self.mask + 1)
        for slot, h in enumerate(self.hashes):
            at = (h ^ (h >> 32)) & self.mask
            while self.cells[at] >= 0:
                at = (at + 1) & self.mask
            self.cells[at] = slot


def _hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)


def _best(ids: list[int | None], sizes: list[int]) -> int:
    """Place of the member that would stay: most code points, then smallest id (null last), then first."""
    return min(range(len(ids)), key=lambda i: (-sizes[i], ids[i] is None, ids[i] or 0, i))


def _collapse(window_bytes: int, window_rows: int):
    """Map side: one record per content and window, with its members and the
    one of them that would stay."""
    schema = arrow_schema(RECORD)

    def flush(table, ids, sizes, first):
        step = 256
        for at in range(0, len(ids), step):
            part_ids, part_sizes = ids[at:at + step], sizes[at:at + step]
            best = [_best(i, n) for i, n in zip(part_ids, part_sizes)]
            yield batch_of(schema, {
                "rec": first + at + np.arange(len(part_ids)), "h": table.hashes[at:at + step], "content": table.contents[at:at + step],
                "n": [len(i) for i in part_ids], "best_n": [n[b] for n, b in zip(part_sizes, best)],
                "best_id": [i[b] for i, b in zip(part_ids, best)], "best_at": best, "ids": part_ids, "sizes": part_sizes})

    def run(batches):
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 33
        table, ids, sizes, rows = ContentTable(), [], [], 0
        for batch in batches:
            keys, lengths = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for key, text, n in zip(keys, batch.column(1), lengths):
                content = text_bytes(text).translate(None, SPACE_BYTES)
                h = _hash(content)
                slot, cell = table.find(h, content)
                if slot < 0:
                    table.add(cell, h, content)
                    ids.append([])
                    sizes.append([])
                ids[slot].append(key)
                sizes[slot].append(n)
                rows += 1
                if table.bytes > window_bytes or rows >= window_rows:
                    yield from flush(table, ids, sizes, made)
                    made += len(ids)
                    table, ids, sizes, rows = ContentTable(), [], [], 0
        yield from flush(table, ids, sizes, made)

    return run


def _grace(table_bytes: int, level: int):
    """Reduce side of one level: the class of every record whose content fits
    the table, and the records of all others, spilled as they are."""
    schema = arrow_schema(DECIDED)

    def run(batches):
        from pyspark import TaskContext

        table, digests = ContentTable(), []
        base = (level << 56) | (TaskContext.get().partitionId() << 32)
        for batch in batches:
            recs, slots, spilled = [], [], []
            for i, (rec, h, content) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                slot, cell = table.find(h, content)
                if slot < 0 and table.contents and table.bytes + len(content) > table_bytes:
                    spilled.append(i)
                    continue
                if slot < 0:
                    slot = table.add(cell, h, content)
                    digests.append(hashlib.sha256(content).hexdigest())
                recs.append(rec)
                slots.append(slot)
            n, none = len(recs), pa.nulls
            if n:
                yield batch_of(schema, {"rec": recs, "class_id": base + np.array(slots), "text_sha256": [digests[s] for s in slots],
                                        "h": none(n, pa.int64()), "content": none(n, pa.binary())})
            if spilled:
                rest, n = batch.take(pa.array(spilled)), len(spilled)
                yield batch_of(schema, {"rec": rest.column(0).cast(pa.int64()), "class_id": none(n, pa.int64()), "text_sha256": none(n, pa.string()),
                                        "h": rest.column(1).cast(pa.int64()), "content": rest.column(2).cast(pa.binary())})

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, table_mb: float = 96,
                window_mb: float = 24, window_rows: int = 20_000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    n_chars.  Of equal texts the row with the most code points, then the
    smallest doc_id, is kept."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                         F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n_chars"))
    kept = shared_path(spark, "exact-records")
    source.mapInArrow(_collapse(int(window_mb * 2**20), window_rows), RECORD).write.option("compression", "zstd").parquet(kept)
    records = spark.read.schema(RECORD).parquet(kept)
    open_, done, level = records.select("rec", "h", "content"), None, 0
    while True:
        path = shared_path(spark, f"grace-{level}")
        bucket = F.col("h") if level == 0 else F.xxhash64(F.col("h"), F.lit(level))
        open_.repartition(bucket).mapInArrow(_grace(int(table_mb * 2**20), level), DECIDED).write.parquet(path)
        out = spark.read.schema(DECIDED).parquet(path)
        decided = out.filter("class_id is not null").select("rec", "class_id", "text_sha256")
        done = decided if done is None else done.unionByName(decided)
        open_ = out.filter("class_id is null").select("rec", "h", "content")
        if open_.limit(1).count() == 0:
            break
        level += 1
    # Records, not members, meet their class: a hot content has one per window.  Its members stay with their records.
    best = F.max(F.struct(F.col("best_n"), F.bitwise_not("best_id").alias("back"), F.bitwise_not("rec").alias("last"), "best_at"))
    classes = done.join(records.select("rec", "n", "best_n", "best_id", "best_at"), "rec").groupBy("class_id").agg(
        F.sum("n").alias("group_size"), best.alias("best"))
    verdict = done.join(classes, "class_id").select(
        "rec", "group_size", "text_sha256", F.bitwise_not("best.back").alias("keep_id"),
        F.when(F.bitwise_not("best.last") == F.col("rec"), F.col("best.best_at")).alias("stays"))
    out = records.select("rec", "ids", "sizes").join(verdict, "rec").select("*", F.posexplode(F.arrays_zip("ids", "sizes")).alias("at", "m"))
    return out.select(F.col("m.ids").alias("doc_id"), "keep_id", "group_size", F.col("at").eqNullSafe(F.col("stays")).alias("kept"),
                      "text_sha256", F.col("m.sizes").alias("n_chars"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns as they were."""
    verdict = staged(exact_dedup(docs, id_col, text_col, **options), "exact")
    keys = [F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")]
    kept = verdict.filter("kept").select(*keys)
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE + "+", ""), 256)

    def matching(rows, wanted, how):
        return rows.join(wanted, rows["__key"].eqNullSafe(wanted["__id"]) & (rows["__text"] == wanted["__sha"]), how)

    rows = matching(docs.withColumns({"__key": F.col(id_col).cast("bigint"), "__text": sha}), kept, "left_semi")
    # rows that repeat the kept row's doc_id in its group match too; normally there are none
    again = verdict.filter("not kept and doc_id <=> keep_id").select(*keys).distinct()
    if not again.isEmpty():
        one = Window.partitionBy("__key", "__text").orderBy(F.length(F.coalesce(text_col, F.lit(""))).desc())
        first = matching(rows, again, "left_semi").withColumn("__at", F.row_number().over(one)).filter("__at = 1").drop("__at")
        rows = matching(rows, again, "left_anti").unionByName(first)
    return rows.drop("__key", "__text")


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
