"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted.  A document longer than the largest is
cut into pieces of that length and a rest; no token is dropped.  Pieces are
dealt to shards of about ``shard_rows`` by a hash of id, text, piece and the number
of the copy (rows equal in id and text are counted and told apart by number), so
no id and no repeated row can fill a shard, and the bins do not depend on how the
table's rows lie in files.  Each shard is packed by one task, longest piece first:
a piece goes to the open bin it leaves the least room in; if none has room, a
bin of the permitted length with the least expected cost per token is opened,
the expectation being how much of the room the pieces still to come can fill.
Because a greedy choice of size can lose against a plain one, the shard is also
packed opening one fixed length (or the least that fits) throughout, and the
cheapest packing is taken.  At the end every bin is downsized to the least
permitted length that holds its contents.

A bin costs its length plus ``overhead``, or what ``costs`` says.  Tokens are
words without ASCII white space unless a length column is given.

Defined results: rows without tokens (null, empty, white space, a null or
negative length) get one row with n_tokens 0 and no bin; repeated rows are
packed one by one; ties go by doc_id and piece; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import staged
from utxoflow.llm.quality_rules import words_of
from utxoflow.session import pickle_by_value

CAPACITIES = (256, 512, 1024, 2048, 4096)
PACKED = ("doc_id bigint, piece int, piece_start bigint, n_tokens bigint, bin_id bigint, bin_capacity int, bin_used int, "
          "bin_offset int")


def pack_once(lengths: list[int], capacities: list[int], costs: list[float], opening: int | None) -> list[list[int]]:
    """Bins (lists of places in ``lengths``, which descend): best fit, opening
    at least ``opening`` or, if None, the length of least expected cost."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some open bin has room r
    after = np.append(np.cumsum(lengths[::-1])[::-1], 0).tolist()  # tokens from a place on
    ascending = lengths[::-1]
    for at, size in enumerate(lengths):
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            mine = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            best = None
            for capacity, cost in zip(capacities, costs):
                if capacity < size or (opening is not None and capacity < min(opening, capacities[-1])):
                    continue
                spare = capacity - size
                first = max(at + 1, len(lengths) - bisect_right(ascending, spare))
                rate = cost / (size + min(spare, after[first]))
                if best is None or rate < best[0]:
                    best = (rate, capacity)
                if opening is not None:
                    break
            room, mine = best[1], len(bins)
            bins.append([])
        bins[mine].append(at)
        room -= size
        if room:
            by_room.setdefault(room, []).append(mine)
            rooms |= 1 << room
    return bins


def pack(lengths: list[int], capacities: list[int], costs: list[float]) -> list[tuple[int, list[int]]]:
    """The cheapest packing of descending lengths: (downsized capacity, places)."""
    def sized(bins):
        return [(next(k for k, c in enumerate(capacities) if c >= sum(lengths[i] for i in b)), b) for b in bins]

    tried = [sized(pack_once(lengths, capacities, costs, opening)) for opening in (None, *capacities)]
    best = min(tried, key=lambda bins: sum(costs[k] for k, _ in bins))
    return [(capacities[k], b) for k, b in best]


#: Copies that one row numbers, so that a third of all rows is numbered by many tasks.
COPIES = 4096


def numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: 0, 1, ... among equal rows.  Equal rows are counted
    (map-side first), the counts cut into stretches and these dealt out before
    they become rows again."""
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    stretch = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES).cast("bigint")))
    dealt = counted.withColumn("stretch", stretch).repartition(*names, "stretch")
    first = F.col("stretch") * COPIES
    copies = F.sequence(first, F.least(F.col("n"), first + COPIES) - 1)
    return dealt.withColumn("copy", F.explode(copies)).drop("n", "stretch")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length_col: str | None = None,
                   capacities=CAPACITIES, costs=None, overhead: float = 16, shard_rows: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, piece_start and n_tokens in the
    document, bin_id, bin_capacity, bin_used and bin_offset in its sequence."""
    sizes = sorted(capacities)
    price = [float(costs[c]) if costs else c + overhead for c in sizes]
    largest = sizes[-1]
    n = F.greatest(F.coalesce(F.col(length_col).cast("bigint"), F.lit(0)), F.lit(0)) if length_col else F.size(words_of(F.col(text_col)))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), n.cast("bigint").alias("total"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    rows = numbered_copies(rows)
    count = F.greatest(F.ceil(F.col("total") / largest), F.lit(1)).cast("int")
    pieces = rows.select("doc_id", "total", "key", "copy", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    pieces = staged(pieces.withColumn("piece_start", F.col("piece").cast("bigint") * largest)
                    .withColumn("n_tokens", F.least(F.col("total") - F.col("piece_start"), F.lit(largest))).drop("total"), "pieces")
    shards = max(1, -(-pieces.filter("n_tokens > 0").count() // shard_rows))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "doc_id", "piece", "key", "copy"], ascending=[False, True, True, True, True],
                                  ignore_index=True)
        lengths = group["n_tokens"].tolist()
        shard, parts = int(group["shard"].iloc[0]), []
        for k, (capacity, places) in enumerate(pack(lengths, sizes, price)):
            ends = np.cumsum([lengths[i] for i in places])
            parts += [(i, (shard << 32) | k, capacity, ends[-1], end - lengths[i]) for i, end in zip(places, ends)]
        at, bin_id, capacity, used, offset = (np.array(x) for x in zip(*parts))
        out = group.loc[at, ["doc_id", "piece", "piece_start", "n_tokens"]].reset_index(drop=True)
        return out.assign(doc_id=out["doc_id"].astype("Int64"), bin_id=bin_id, bin_capacity=capacity, bin_used=used, bin_offset=offset)

    shard = F.pmod(F.xxhash64("doc_id", "key", "piece", "copy"), F.lit(shards)).alias("shard")
    full = pieces.filter("n_tokens > 0").select("*", shard).groupBy("shard").applyInPandas(packed, PACKED)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("bin_id", "bigint"), ("bin_capacity", "int"), ("bin_used", "int"), ("bin_offset", "int"))]
    return full.unionByName(pieces.filter("n_tokens <= 0").select("doc_id", "piece", "piece_start", "n_tokens", *none))


pickle_by_value(__name__)
