"""Block archives as a source of their own (S3, S4): a Python data source over
packed archives (``sinks.write_packed_archive``), batch and stream.

    spark.dataSource.register(BlockArchive)
    spark.read.format("block_archive").option("path", p).option("lo", 10).option("hi", 99).load()
    spark.readStream.format("block_archive").option("path", p).load()

Rows are ``height`` and ``raw``, the last write of every height.  A scan is cut into
stretches of ``stretch`` heights, one task each, which read the row groups that
overlap theirs.  The stream's offset is a height: a micro-batch takes all heights
above the last one; a height that is written again behind the offset is not
delivered again.

Files are opened by the tasks through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from utxoflow.session import pickle_by_value

SCHEMA = "height bigint, raw string"


def open_path(path: str):
    """(Arrow file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def live_folders(path: str) -> list[str]:
    """Folders of the newest version of a table (``sinks.versions``)."""
    from pyarrow import fs

    system, root = open_path(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/_versions", allow_not_found=True))
    lists = sorted(f.path for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("."))
    if not lists:
        return []
    with system.open_input_stream(lists[-1]) as f:
        return [f"{root}/{p['folder']}" for p in json.loads(f.read())["parts"]]


def blocks(path: str, lo: int, hi: int) -> dict[int, str]:
    """The last write of every height in [lo, hi]."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    system, _ = open_path(path)
    newest: dict[int, tuple[int, str]] = {}
    for folder in live_folders(path):
        within = (pc.field("height_number") >= lo) & (pc.field("height_number") <= hi)
        scan = ds.dataset(folder, filesystem=system, format="parquet")
        for batch in scan.to_batches(columns=["height_number", "offset", "raw"], filter=within):
            for height, offset, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if height not in newest or newest[height][0] < offset:
                    newest[height] = (offset, raw)
    return {h: raw for h, (_, raw) in newest.items()}


def ends(path: str) -> tuple[int, int] | None:
    """Least and largest height, from the files' statistics alone."""
    import pyarrow.dataset as ds

    system, _ = open_path(path)
    lows, highs = [], []
    for folder in live_folders(path):
        for fragment in ds.dataset(folder, filesystem=system, format="parquet").get_fragments():
            for group in fragment.row_groups:
                seen = (group.statistics or {}).get("height_number")
                if seen:
                    lows.append(seen["min"])
                    highs.append(seen["max"])
    return (min(lows), max(highs)) if lows else None


class Stretch(InputPartition):
    def __init__(self, lo: int, hi: int) -> None:
        self.lo, self.hi = lo, hi


def stretches(lo: int, hi: int, size: int) -> list[Stretch]:
    return [Stretch(a, min(a + size - 1, hi)) for a in range(lo, hi + 1, size)]


class _Read:
    """Reading a stretch, the same for batch and stream."""

    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("stretch", 10_000))
        self.lo, self.hi = (int(options[k]) if k in options else None for k in ("lo", "hi"))

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        found = blocks(self.path, partition.lo, partition.hi)
        heights = sorted(found)
        for at in range(0, len(heights), 1000):
            part = heights[at:at + 1000]
            yield pa.record_batch({"height": pa.array(part, pa.int64()), "raw": pa.array([found[h] for h in part], pa.string())})


class BatchReader(_Read, DataSourceReader):
    def partitions(self) -> list[Stretch]:
        seen = ends(self.path)
        if seen is None:
            return [Stretch(0, -1)]
        lo, hi = (max(seen[0], self.lo) if self.lo is not None else seen[0]), (min(seen[1], self.hi) if self.hi is not None else seen[1])
        return stretches(lo, hi, self.size) or [Stretch(0, -1)]


class StreamReader(_Read, DataSourceStreamReader):
    """Offsets: the largest height delivered."""

    def initialOffset(self) -> dict:
        seen = ends(self.path)
        return {"height": (self.lo if self.lo is not None else seen[0] if seen else 0) - 1}

    def latestOffset(self) -> dict:
        seen = ends(self.path)
        top = seen[1] if seen else self.initialOffset()["height"]
        return {"height": top if self.hi is None else min(top, self.hi)}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return stretches(int(start["height"]) + 1, int(end["height"]), self.size)

    def commit(self, end: dict) -> None:
        pass


class BlockArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "block_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)


def read_blocks(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """``height`` and ``raw`` of a packed archive."""
    spark.dataSource.register(BlockArchive)
    reader = (spark.readStream if streaming else spark.read).format("block_archive").option("path", path)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def block_transactions(found: DataFrame) -> DataFrame:
    """The transactions of blocks (``{"height": h, "transactions": [text, ...]}``)
    as raw JSON text, with the height and the place in it as offset."""
    said = F.from_json("raw", "height bigint, transactions array<string>")
    return (found.select("height", F.posexplode(said["transactions"]).alias("at", "value"))
                 .select("value", F.shiftleft(F.col("height"), 20).bitwiseOR(F.col("at").cast("long")).alias("offset")))


pickle_by_value(__name__)
