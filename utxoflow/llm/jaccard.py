"""Near-duplicate classes by an exact n-gram Jaccard join.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.  Two
documents link when ``100 * |A and B| >= percent * |A or B|``; classes are the
connected components of all links.  Nothing is sampled away and no partner is
capped; hashing to 64 bits is the only approximation.

1. Equal sets collapse to one node (a digest of the set), so groups of copies
   count once.  A node keeps its size and a bitmap signature: bit ``h mod m`` is
   the parity of the shingles hashed there, ``m`` growing with the size band, so
   two signatures differ in at most ``|A xor B|`` bits.
2. Tiles.  In any fixed order of shingles, linked sets share one among the first
   ``n - ceil(t n) + 1`` of each (prefix filter).  The order puts shingles that
   are frequent in a sample of documents last, so common passages rarely make
   tiles; the sample only shapes the order, never the result.  Nodes with a
   prefix shingle in common meet in its tile, sorted by place in the prefix and
   size.  What precedes a first common shingle is not shared, so place and size
   bound the overlap (size bands and places together).
3. Forest.  Every node is compared with the first node of its tiles it meets
   most often and may link with.  Bit counts bound the overlap from above,
   survivors get the exact sorted-array intersection.  Links found are merged
   to components.
4. Rest.  Only nodes of one tile in different components are still of interest.
   Tiles are cut into blocks of at most ``block_rows`` nodes, every pair of
   blocks of a tile is a unit of its own, and there pairs of different
   components and fitting sizes and places are tested by bit counts.  Survivors are
   intersected exactly.  Every linked pair is thus either inside one component
   or tested here.

Components are merged by alternating large-star and small-star steps; each step
is written to the shared folder.  Only the frequent shingles (``frequent`` at
most) and a bitmap of fixed size (which texts are still needed) reach the driver.

Defined results: null, empty or wordless text has 0 shingles and is a class of
its own (component_id is its doc_id); a text of fewer than five words is one
shingle; repeated rows have equal sets and share a class; a null doc_id never
is a component_id unless all ids of the class are null; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import SPACE_BYTES, arrow_schema, batch_of, slices, staged, worker_cache
from utxoflow.session import pickle_by_value

WORDS = 5
#: Bytes hashed at once; a longer text is cut between words.
CHUNK = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply) over an array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers of a stream."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


SPACES = np.zeros(256, bool)
SPACES[list(SPACE_BYTES)] = True
#: A number per byte; ASCII capitals have that of their small letter.
BYTES = constants(256, 1)
BYTES[0x41:0x5B] = BYTES[0x61:0x7B]
SHINGLE = constants(WORDS, 2)


def place_numbers(n: int) -> np.ndarray:
    """A multiplier for each place in a word, for words of up to n bytes."""
    size = 1 << max(10, n.bit_length())
    return worker_cache(("places", size), lambda: constants(size, 3))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of a buffer in which texts begin at ``starts``."""
    inked = np.flatnonzero(~SPACES[data])
    if not len(inked):
        return np.empty(0, np.uint64), inked
    first = np.ones(len(inked), bool)
    first[1:] = inked[1:] != inked[:-1] + 1
    at = np.searchsorted(inked, starts)  # a text's first inked byte begins a word
    first[at[at < len(inked)]] = True
    begin = np.flatnonzero(first)
    sizes = np.diff(np.append(begin, len(inked)))
    place = np.arange(len(inked)) - np.repeat(begin, sizes)
    sums = np.add.reduceat(BYTES[data[inked]] * place_numbers(int(sizes.max()))[place], begin)
    return mixed(sums + sizes.astype(np.uint64)), inked[begin]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; text i is data[offsets[i]:offsets[i + 1]]."""
    hashes, begins, at = [], [], int(offsets[0])
    while at < offsets[-1]:
        stop = min(at + CHUNK, int(offsets[-1]))
        if stop < offsets[-1]:  # cut where a text or a word ends
            cut = np.flatnonzero(SPACES[data[at:stop]])
            ends = offsets[np.searchsorted(offsets, stop, side="right") - 1]
            stop = max(int(ends), at + int(cut[-1]) + 1 if len(cut) else 0)
            if stop <= at:  # one word longer than a chunk
                more = np.flatnonzero(SPACES[data[at:]])
                stop = min([x for x in (at + int(more[0]) if len(more) else int(offsets[-1]),
                                        int(offsets[np.searchsorted(offsets, at, side="right")])) if x > at])
        inside = offsets[(offsets >= at) & (offsets < stop)] - at
        got, begin = word_hashes(data[at:stop], inside)
        hashes.append(got)
        begins.append(begin + at)
        at = stop
    words = np.concatenate([np.empty(0, np.uint64), *hashes])
    bounds = np.searchsorted(np.concatenate([np.empty(0, np.int64), *begins]), offsets)
    m = max(0, len(words) - WORDS + 1)
    runs = mixed(sum((words[k:m + k] * SHINGLE[k] for k in range(WORDS)), np.zeros(m, np.uint64)))
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= WORDS:
            out.append(np.unique(runs[lo:hi - WORDS + 1]))
        elif hi > lo:  # too few words: all of them are one shingle
            whole = (words[lo:hi] * SHINGLE[:hi - lo]).sum(keepdims=True)
            out.append(mixed(whole + SHINGLE[:1] * np.array([hi - lo], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def node_of(found: np.ndarray, salt: int) -> tuple[int, int]:
    """(node, check): two halves of a digest of the set."""
    raw = hashlib.blake2b(found.tobytes(), digest_size=16, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def signature(found: np.ndarray) -> bytes:
    """Parity bitmap of at least twice as many bits as shingles (a power of two, 64 to 65536)."""
    bits = min(1 << 16, max(64, 1 << (2 * max(1, len(found)) - 1).bit_length()))
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(raw: bytes, size: int) -> np.ndarray:
    """The signature at a smaller width: halves laid over each other keep parity."""
    x = np.frombuffer(raw, np.uint64)
    while len(x) * 8 > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def may_link(a: np.ndarray, b: np.ndarray, na, nb, percent: int):
    """From above: |A and B| <= (na + nb - differing bits) / 2."""
    differ = np.bitwise_count(a ^ b).sum(axis=-1).astype(np.int64)
    return (100 + percent) * (na + nb - differ) >= 2 * percent * (na + nb)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test by intersection of sorted arrays."""
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(b) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)


def _each(batches, most: int = 1 << 21):
    """(slice, sets) over (doc_id, text) batches, some MB of text at a time."""
    for batch in batches:
        texts = pa.array(batch.column(1), pa.string()) if not pa.types.is_string(batch.column(1).type) else batch.column(1)
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, int)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if n else np.empty(0, np.uint8)
        at = 0
        while at < n:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, stop - at), shingle_sets(data, offsets[at:stop + 1])
            at = stop


SETS = "doc_id bigint, n bigint, node bigint, check bigint, bitmap binary"
#: at: place in the prefix in the upper 32 bits, size of the set in the lower.
POSTINGS = "shingle bigint, at bigint, node bigint"
TILES = POSTINGS + ", mate bigint"
FOUND = "node bigint, content binary"
PAIRS = "a bigint, b bigint"


def _sets(docs: DataFrame, salt: int) -> DataFrame:
    schema = arrow_schema(SETS)

    def run(batches):
        for batch, sets in _each(batches):
            nodes = [node_of(x, salt) for x in sets]
            yield batch_of(schema, {"doc_id": batch.column(0), "n": [len(x) for x in sets], "node": [a for a, _ in nodes],
                                    "check": [b for _, b in nodes], "bitmap": [signature(x) for x in sets]})

    return docs.mapInArrow(run, SETS)


def frequent_shingles(docs: DataFrame, one_in: int, most: int) -> np.ndarray:
    """Shingles that at least four documents of a sample share, rarest first;
    at most ``most``."""
    schema = arrow_schema("shingle bigint, df bigint")

    def run(batches):
        for _, sets in _each(batches):
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            yield batch_of(schema, {"shingle": values.view(np.int64), "df": counts})

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
    counts = sample.mapInArrow(run, "shingle bigint, df bigint").groupBy("shingle").agg(F.sum("df").alias("df")).filter("df >= 4")
    counts = staged(counts, "frequent")
    by_df = sorted(((r["df"], r["count"]) for r in counts.groupBy("df").count().collect()), reverse=True)
    least, total = 1 << 62, 0
    for df, n in by_df:
        if total + n > most:
            break
        least, total = df, total + n
    rows = sorted((r["df"], r["shingle"]) for r in counts.filter(F.col("df") >= least).collect())
    return np.array([s for _, s in rows], np.int64).view(np.uint64)


def _postings(docs: DataFrame, frequent: np.ndarray, percent: int, salt: int) -> DataFrame:
    schema = arrow_schema(POSTINGS)
    by_value = np.argsort(frequent)
    values = frequent[by_value]  # rank of values[i] is by_value[i]

    def prefix(x: np.ndarray) -> np.ndarray:
        n = len(x)
        most = n - -(-percent * n // 100) + 1
        if len(values) and n:
            at = np.minimum(np.searchsorted(values, x), len(values) - 1)
            common = values[at] == x
            if common.any():
                x = np.concatenate([x[~common], x[common][np.argsort(by_value[at[common]])]])
        return x[:most]

    def run(batches):
        seen = set()
        for _, sets in _each(batches):
            got = []
            for x in sets:
                node = node_of(x, salt)[0]
                if len(x) and node not in seen:
                    seen.add(node)
                    got.append((prefix(x), len(x), node))
            if len(seen) > 500_000:
                seen.clear()
            sizes = [len(p) for p, _, _ in got]
            yield batch_of(schema, {
                "shingle": np.concatenate([np.empty(0, np.uint64), *(p for p, _, _ in got)]).view(np.int64),
                "at": np.concatenate([np.empty(0, np.int64), *((np.arange(k) << 32) | n for k, (_, n, _) in zip(sizes, got))]),
                "node": np.repeat(np.array([k for _, _, k in got], np.int64), sizes)})

    return docs.mapInArrow(run, POSTINGS)


def fits(at, other, percent: int):
    """Can sets that first meet in these places of their prefixes link?  What
    precedes a first common shingle is not shared, so the overlap is at most
    the smaller rest of the two."""
    n, m = at & 0xFFFFFFFF, other & 0xFFFFFFFF
    return (100 + percent) * np.minimum(n - (at >> 32), m - (other >> 32)) >= percent * (n + m)


def _tiles(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of shingles that two or more nodes have, each with the first
    node of its tile when the two can link.  Input is sorted by shingle, place,
    size and node within partitions: first comes a set with few rarer shingles,
    in a group of near copies one with few changes."""
    schema = arrow_schema(TILES)

    def run(batches):
        held = None  # the last row so far (its tile may go on), whether it has company, its tile's first row
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(3)])
            if held is not None:
                rows = np.concatenate([held[0], rows], axis=1)
            if not rows.shape[1]:
                continue
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)  # copies of a node from other tasks
            rows = rows[:, new]
            n = rows.shape[1]
            same = np.zeros(n + 1, bool)  # is row i in the tile of row i - 1?
            same[1:n] = rows[0, 1:] == rows[0, :-1]
            lead = np.maximum.accumulate(np.where(same[:n], 0, np.arange(n)))
            lead_at, lead_node = rows[1, lead], rows[2, lead]
            has = same[:n].copy()
            if held is not None and held[1]:
                first = lead == 0  # these belong to the tile the batch before left open
                lead_at[first], lead_node[first], has[0] = held[2][0], held[2][1], True
            keep = has | same[1:]
            keep[n - 1] = False
            mated = has & fits(rows[1], lead_at, percent)
            if keep.any():
                yield batch_of(schema, {"shingle": rows[0, keep], "at": rows[1, keep], "node": rows[2, keep],
                                        "mate": pa.array(lead_node[keep], mask=~mated[keep])})
            held = (rows[:, n - 1:], bool(has[n - 1]), (int(lead_at[n - 1]), int(lead_node[n - 1])))
        if held is not None and held[1]:
            mated = bool(fits(held[0][1], held[2][0], percent)[0])
            yield batch_of(schema, {"shingle": held[0][0], "at": held[0][1], "node": held[0][2], "mate": [held[2][1] if mated else None]})

    return postings.mapInArrow(run, TILES)


def _bit_tested(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bitmaps leave room for a link."""
    schema = arrow_schema(PAIRS)

    def run(batches):
        for batch in slices(batches, 2048):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            na, nb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            x, y = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            keep = []
            for i in range(len(a)):
                size = min(len(x[i]), len(y[i]))
                if may_link(folded(x[i], size), folded(y[i], size), na[i], nb[i], percent):
                    keep.append(i)
            yield batch_of(schema, {"a": [a[i] for i in keep], "b": [b[i] for i in keep]})

    left = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("x"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "x", "y").mapInArrow(run, PAIRS)


#: Tiles of up to so many rows are compared by array steps, larger ones in blocks.
SMALL = 64
#: Bits of the map that tells which nodes' texts are needed (fixed, 4 MB).
MAP_BITS = 25


def _sets_of(docs: DataFrame, pairs: DataFrame, salt: int) -> DataFrame:
    """(node, sorted set) of all nodes in ``pairs``, recomputed from the texts.
    A bitmap of fixed size spares the other texts' sets the shuffle."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    bit = F.col("node").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    words = nodes.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(node & 63 as int))")).alias("mask")).collect()  # at most 2 ** (MAP_BITS - 6) rows
    wanted = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in words:
        wanted[r["word"]] = r["mask"]
    schema = arrow_schema(FOUND)

    def run(batches):
        seen = set()
        for _, sets in _each(batches):
            got = []
            for x in sets:
                if not len(x):
                    continue
                node = node_of(x, salt)[0]
                low = node & ((1 << MAP_BITS) - 1)
                if (int(wanted[low >> 6]) >> (low & 63)) & 1 and node not in seen:
                    seen.add(node)
                    got.append((node, x.tobytes()))
            if len(seen) > 500_000:
                seen.clear()
            yield batch_of(schema, {"node": [k for k, _ in got], "content": [c for _, c in got]})

    found = docs.mapInArrow(run, FOUND)
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("content").alias("content"))


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, salt: int) -> DataFrame:
    """The pairs that link, by exact intersection."""
    schema = arrow_schema(PAIRS)

    def run(batches):
        for batch in slices(batches, 512):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [i for i in range(len(a)) if linked(np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64), percent)]
            yield batch_of(schema, {"a": [a[i] for i in keep], "b": [b[i] for i in keep]})

    sets = staged(_sets_of(docs, pairs, salt), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("content").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("content").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, PAIRS)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): the least node of its
    connected component, by large-star and small-star steps."""
    edges = staged(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))  # v < u for all edges here
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


def _cross_pairs(tiles: DataFrame, roots: DataFrame, classes: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Pairs of a tile in different components that places, sizes and bitmaps
    allow."""
    schema = arrow_schema(PAIRS)

    def small(batches):
        """All pairs of tiles of at most SMALL rows, by places and sizes."""
        left = None
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(4)])
            rows = rows if left is None else np.concatenate([left, rows], axis=1)
            if not rows.shape[1]:
                continue
            last = int(np.searchsorted(rows[0], rows[0, -1]))  # the last tile may go on; shingles ascend
            yield from pairs(rows[:, :last])
            left = rows[:, last:]
        if left is not None:
            yield from pairs(left)

    def pairs(rows):
        m = rows.shape[1]
        if m < 2:
            return
        ends = np.searchsorted(rows[0], rows[0], side="right")  # end of each row's tile
        found = []
        for step in range(1, SMALL):
            i = np.flatnonzero(np.arange(m) + step < ends)
            if not len(i):
                break
            j = i + step
            ok = (rows[3, i] != rows[3, j]) & fits(rows[1, i], rows[1, j], percent)
            found.append(np.stack([rows[2, i[ok]], rows[2, j[ok]]]))
        got = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        got = np.unique(np.sort(got, axis=0), axis=1)
        if got.shape[1]:
            yield batch_of(schema, {"a": got[0], "b": got[1]})

    def compare(rows):
        """Rows of one unit: all pairs that belong to it and may link."""
        at, node, root, apart, own = (np.array([r[k] for r in rows]) for k in range(1, 6))
        n = at & 0xFFFFFFFF
        widths = [len(r[6]) for r in rows]
        out = []
        for size in sorted(set(widths)):  # pairs whose narrower signature has this width
            mine = [i for i, w in enumerate(widths) if w >= size]
            marks = np.stack([folded(rows[i][6], size) for i in mine])
            mine = np.array(mine)
            exact = np.array([widths[i] == size for i in mine])
            for k, i in enumerate(mine):
                ok = (root[mine] != root[i]) & fits(at[mine], at[i], percent)
                ok &= (np.arange(len(mine)) < k) & (exact | exact[k])
                ok &= (own[mine] != own[i]) | (apart[i] == 0)
                js = np.flatnonzero(ok)
                if len(js):
                    js = js[may_link(marks[js], marks[k], n[mine[js]], n[i], percent)]
                    out += [(min(node[i], x), max(node[i], x)) for x in node[mine[js]].tolist()]
        return out

    def large(batches):
        key, rows, out = None, [], set()
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for row in zip(*columns):
                if row[0] != key:
                    if len(rows) > 1:
                        out.update(compare(rows))
                    key, rows = row[0], []
                rows.append(row)
                if len(out) > 100_000:
                    yield batch_of(schema, {"a": [a for a, _ in out], "b": [b for _, b in out]})
                    out = set()
        if len(rows) > 1:
            out.update(compare(rows))
        yield batch_of(schema, {"a": [a for a, _ in out], "b": [b for _, b in out]})

    rows = tiles.select("shingle", "at", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rows.groupBy("shingle").agg(F.count("*").alias("members"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    rows = staged(rows.join(open_.filter("lo != hi").select("shingle", "members"), "shingle"), "open")
    few = rows.filter(F.col("members") <= min(SMALL, block_rows)).select("shingle", "at", "node", "root")
    few = few.repartition("shingle").sortWithinPartitions("shingle", "at", "node").mapInArrow(small, PAIRS).distinct()

    many = rows.filter(F.col("members") > min(SMALL, block_rows)).withColumn("blocks", F.ceil(F.col("members") / block_rows).cast("int"))
    many = many.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a row goes to the units of its block with every block (once, for a tile of one block)
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    unit = F.concat_ws(":", F.col("shingle").cast("string"), lo.cast("string"), hi.cast("string"))
    many = many.select(unit.alias("unit"), "at", "node", "root", (hi - lo).alias("apart"), "own")
    many = many.join(classes.select("node", "bitmap"), "node").select("unit", "at", "node", "root", "apart", "own", "bitmap")
    many = many.repartition("unit").sortWithinPartitions("unit", "at", "node").mapInArrow(large, PAIRS).distinct()
    return _bit_tested(few, classes, percent).union(many).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 75,
                    sample_one_in: int = 16, frequent: int = 1 << 16, block_rows: int = 2048) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links)."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    salt = 0
    while True:
        sets = staged(_sets(source, salt), "docs")
        # two sets under one node would merge classes: take another digest then
        if sets.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).filter("lo != hi").isEmpty():
            break
        salt += 1
    classes = staged(sets.filter("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), F.min("doc_id").alias("first_id")), "classes")
    order = frequent_shingles(source, sample_one_in, frequent)
    postings = _postings(source, order, percent, salt)
    tiles = staged(_tiles(postings.repartition("shingle").sortWithinPartitions("shingle", "at", "node"), percent), "tiles")

    met = tiles.filter("mate is not null").groupBy("node", "mate").agg(F.count("*").alias("times"))
    forest = met.groupBy("node").agg(F.max(F.struct("times", "mate")).alias("best"))
    forest = forest.select(F.col("node").alias("a"), F.col("best.mate").alias("b"))
    tested = staged(_bit_tested(forest, classes, percent), "forest")
    links = staged(_verified(source, tested, percent, salt), "links")
    roots = components(links)

    cross = staged(_cross_pairs(tiles, roots, classes, percent, block_rows), "cross")
    more = staged(_verified(source, cross, percent, salt), "more")
    if not more.isEmpty():
        roots = components(links.union(more))
    named = classes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = named.join(least, "root").select("node", "component_id")
    out = sets.select("doc_id", "n", "node").join(of_node, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, that of the smallest id (null ids last), all columns
    as they were; rows without words are no copies of each other and stay."""
    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, "__row", text_col, **options).withColumnRenamed("doc_id", "__row")
    ids = rows.select("__row", F.col(id_col).cast("bigint").alias("id"))
    least = found.join(ids, "__row").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "__row")).alias("least"))
    return rows.join(least.select(F.col("least.__row").alias("__row")), "__row", "left_semi").select(*docs.columns)


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
