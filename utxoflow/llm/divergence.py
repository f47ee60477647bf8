"""Source divergence audit over quadtrees of the group-term count matrix.

For every language, groups (its sources) and kept terms (in at least
``least_docs`` of its documents) span a count matrix.  With add-one smoothing a
term has the integer share ``p = 1 + floor(10^9 (count + 1) / (N + V))`` in a
group; two groups differ by the sum over all kept terms of ``floor((p - q)^2 / q)``.

The matrix is nearly empty and is never laid out.  It is cut into tiles (blocks of
groups by hashed sets of about ``tile_terms`` terms), and each tile becomes a
quadtree: a K-squared tree with K = 2, one bit per quadrant of every nonzero node,
children found by the rank of their bit.  Two bands of groups are walked jointly:
where the quadrants of both are empty, every pair of their groups has the same two
shares in all of the quadrant's terms, so the quadrant is priced by one product
per pair; only where one of them holds a nonzero leaf is it descended.  Terms that
no group of the tile's blocks has are one more empty quadrant.

Counting is done per task before anything is shuffled; a unit of work is one tile
and two blocks of groups, so memory is bounded by ``tile_terms * 2 * block_groups``
counts however large a source, a term or a language is.  Results are sums of
tiles.  All arithmetic is on integers.

Defined results: null text, language or source count as the empty text; every
occurring group is priced, also without any term; a language without kept terms
has pairs of value 0 and no terms; repeated rows are documents of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, staged, text_bytes
from utxoflow.session import pickle_by_value

#: Bytes of a text to bytes of its terms: ASCII letters in lower case and everything beyond ASCII; the rest separates.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
#: Distinct (group, term) counts that a task holds before it hands them on.
HELD = 400_000
#: Pairs of quadrants walked in one array step.
STEP = 1 << 18

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
FOUND = "lang string, source string, part string, item string, value bigint"


# ---- counts ----

def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Occurrences and documents of every (lang, source, term), and one row
    with a null term for every group."""
    schema = arrow_schema(COUNTS)

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, in_docs) in held.items():
            terms = list(n)
            yield batch_of(schema, {"lang": [lang] * (len(terms) + 1), "source": [source] * (len(terms) + 1),
                                    "term": [None, *(t.decode() for t in terms)], "n": [0, *n.values()],
                                    "docs": [0, *(in_docs[t] for t in terms)]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        for batch in batches:
            texts = batch.column(2)
            for row, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key not in held:
                    held[key] = (Counter(), Counter())
                    size += 1
                n, in_docs = held[key]
                words = text_bytes(texts[row]).translate(TERM_BYTES).split()
                size -= len(n)
                n.update(words)
                in_docs.update(set(words))
                size += len(n)
                if size >= HELD:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(text(lang_col), text(source_col), text(text_col)).mapInArrow(run, COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- shares ----

def shares(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / (total + terms))`` in three decimal steps,
    exact while ``total + terms`` is below 9 * 10^15."""
    over = np.asarray(total, np.int64) + terms
    left = np.asarray(count, np.int64) + 1
    out = left // over
    left = left % over
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // over
        left = left % over
    return out + 1


# ---- the tree ----

def spread(x: np.ndarray) -> np.ndarray:
    """The low 16 bits of ``x`` at every second place."""
    x = x.astype(np.int64)
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x | (x << shift)) & mask
    return x


class QuadTree:
    """K-squared tree (K = 2) of the nonzero cells of a matrix of side
    2^height.  ``bits[l]`` has the four quadrant bits of every nonzero node of
    level l, ``child[l]`` the place of a set bit among those of its level;
    leaves are numbered in the same order, ``order`` gives their cells."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, height: int) -> None:
        path = (spread(rows) << 1) | spread(cols)
        self.order = np.argsort(path, kind="stable")
        path = path[self.order]
        self.bits, self.child = [], []
        parents = np.zeros(min(1, len(path)), np.int64)
        for level in range(1, height + 1):
            nodes = np.unique(path >> (2 * (height - level)))
            bits = np.zeros(4 * len(parents), bool)
            bits[np.searchsorted(parents, nodes >> 2) * 4 + (nodes & 3)] = True
            self.bits.append(bits)
            self.child.append(np.where(bits, np.cumsum(bits) - 1, -1))
            parents = nodes
        self.root = 0 if len(path) else -1

    def step(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The child in ``quadrant`` of every node, -1 where it is empty."""
        table = self.child[level]
        if not len(table):
            return np.full(len(node), -1)
        return np.where(node >= 0, table[np.maximum(node, 0) * 4 + quadrant], -1)


def walk(a: QuadTree, b: QuadTree, n_a: int, n_b: int, terms: int, height: int, same: bool
         ) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """Walk two trees jointly.  Returns the matrix (groups of a x groups of b) of
    how many terms lie in quadrants empty in both, complete once the iterator
    of (group of a, group of b, leaf of a, leaf of b) is used up; -1 stands
    for a cell that is zero.  With ``same`` only pairs with the first group before
    the second are walked."""
    empty = np.zeros((n_a, n_b), np.int64)

    def price(level: int, first: np.ndarray, second: np.ndarray, width: np.ndarray) -> None:
        side = 1 << (height - level)
        bands = np.zeros((-(-n_a // side), -(-n_b // side)), np.int64)
        np.add.at(bands, (first, second), width)
        empty[...] += bands[(np.arange(n_a) // side)[:, None], (np.arange(n_b) // side)[None, :]]

    def leaves() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        start = tuple(np.array([x]) for x in (a.root, b.root, 0, 0, 0))
        stack = [(0, start)]
        if a.root < 0 and b.root < 0:
            price(0, start[2], start[3], np.array([terms]))
            return
        while stack:
            level, part = stack.pop()
            if len(part[0]) > STEP and level < height:
                middle = len(part[0]) // 2
                stack += [(level, tuple(x[:middle] for x in part)), (level, tuple(x[middle:] for x in part))]
                continue
            node_a, node_b, first, second, column = part
            if level == height:
                yield first, second, node_a, node_b
                continue
            side = 1 << (height - level - 1)
            grown = []
            for q in range(8):
                down_a, down_b, right = q >> 2, (q >> 1) & 1, q & 1
                f, s, c = 2 * first + down_a, 2 * second + down_b, 2 * column + right
                at = (f * side < n_a) & (s * side < n_b) & (c * side < terms)
                if same:
                    at &= (f <= s) if side > 1 else (f < s)
                f, s, c = f[at], s[at], c[at]
                x, y = a.step(level, node_a[at], 2 * down_a + right), b.step(level, node_b[at], 2 * down_b + right)
                none = (x < 0) & (y < 0)
                if none.any():
                    price(level + 1, f[none], s[none], np.minimum((c[none] + 1) * side, terms) - c[none] * side)
                grown.append((x[~none], y[~none], f[~none], s[~none], c[~none]))
            joined = tuple(np.concatenate(x) for x in zip(*grown))
            if len(joined[0]):
                stack.append((level + 1, joined))

    return empty, leaves()


# ---- a unit of work ----

def price_pairs(cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]], totals: list[np.ndarray], terms: int, missing: int,
                width: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Values of the tile for all pairs (a, b) of groups of two blocks, and of
    (b, a).  ``cells``: (group, term, count) of each block; ``totals``: N of
    its groups; ``terms``: kept terms of the language; ``width``: terms of
    the tile that occur in the blocks, ``missing``: those that do not."""
    n_a, n_b = len(totals[0]), len(totals[1])
    height = max(1, int(max(width, n_a, n_b) - 1).bit_length())
    trees = [QuadTree(r, c, height) for r, c, _ in cells]
    leaf = [shares(n[t.order], total[r[t.order]], terms) for (r, _, n), t, total in zip(cells, trees, totals)]
    none = [shares(np.zeros(len(t), np.int64), t, terms) for t in totals]
    forth, back = np.zeros((n_a, n_b), np.int64), np.zeros((n_a, n_b), np.int64)
    empty, found = walk(*trees, n_a, n_b, width, height, same)
    for first, second, x, y in found:
        p = np.where(x >= 0, leaf[0][np.maximum(x, 0)], none[0][first]) if len(leaf[0]) else none[0][first]
        q = np.where(y >= 0, leaf[1][np.maximum(y, 0)], none[1][second]) if len(leaf[1]) else none[1][second]
        apart = (p - q) * (p - q)
        np.add.at(forth, (first, second), apart // q)
        np.add.at(back, (first, second), apart // p)
    p, q = none[0][:, None], none[1][None, :]
    apart = (p - q) * (p - q)
    return forth + (empty + missing) * (apart // q), back + (empty + missing) * (apart // p)


def tile_columns(rows: np.ndarray, terms: np.ndarray, n_terms: int) -> np.ndarray:
    """Columns of the terms: those of many groups first, then by their first
    group, so that zeros lie together."""
    groups = np.bincount(terms, minlength=n_terms)
    first = np.full(n_terms, np.iinfo(np.int64).max)
    np.minimum.at(first, terms, rows)
    place = np.empty(n_terms, np.int64)
    place[np.lexsort((first, -groups))] = np.arange(n_terms)
    return place


def top_terms(rows: np.ndarray, terms: np.ndarray, values: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` largest values of every row (ties: smaller term)."""
    order = np.lexsort((terms, -values, rows))
    starts = np.searchsorted(rows[order], rows[order], side="left")
    return order[np.arange(len(order)) - starts < top]


UNIT = ["lang", "tile", "block_a", "block_b"]


def price_unit(table: pa.Table, block_groups: int, top: int) -> Iterator[dict]:
    """Rows of ``FOUND`` of one tile and two blocks of groups (or one, with
    itself).  Rows with a null term describe the groups."""
    col = {name: table.column(name).combine_chunks() for name in table.column_names}
    block_a, block_b = col["block_a"][0].as_py(), col["block_b"][0].as_py()
    same = block_a == block_b
    idx = col["idx"].to_numpy(zero_copy_only=False)
    meta = col["term"].is_null().to_numpy(zero_copy_only=False)
    n, of_lang = (col[c].to_numpy(zero_copy_only=False) for c in ("n", "lang_n"))
    lang, vocabulary, in_tile = col["lang"][0].as_py(), *(int(col[c].drop_null()[0].as_py()) for c in ("vocabulary", "in_tile"))
    names, totals = [], []
    for block in (block_a, block_b):
        own = np.flatnonzero(meta & (idx // block_groups == block))
        own = own[np.argsort(idx[own], kind="stable")]
        names.append(col["source"].take(pa.array(own)).to_pylist())
        totals.append(n[own])
    if not vocabulary:
        found = [(a, b, 0) for a in names[0] for b in names[1]]
        for a, b, v in found:
            if not (same and a == b):
                yield {"source": a, "part": "pair", "item": b, "value": v}
                if not same:
                    yield {"source": b, "part": "pair", "item": a, "value": v}
        return

    cell = np.flatnonzero(~meta)
    words, term = np.unique(col["term"].take(pa.array(cell)).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    row, count = idx[cell] % block_groups, n[cell]
    place = tile_columns(idx[cell], term, len(words))
    sides = [idx[cell] // block_groups == block for block in (block_a, block_b)]
    cells = [(row[s], place[term[s]], count[s]) for s in sides]
    forth, back = price_pairs(cells, totals, vocabulary, in_tile - len(words), len(words), same)
    for a, source in enumerate(names[0]):
        for b, other in enumerate(names[1]):
            if not same or a < b:
                yield {"source": source, "part": "pair", "item": other, "value": int(forth[a, b])}
                yield {"source": other, "part": "pair", "item": source, "value": int(back[a, b])}
    if same and len(cell):
        lang_total = int(of_lang[np.flatnonzero(meta)[0]])
        p, q = shares(count, totals[0][row], vocabulary), shares(of_lang[cell], lang_total, vocabulary)
        above = np.flatnonzero(p > q)
        value = ((p - q) * (p - q) // q)[above]
        for i in top_terms(row[above], term[above], value, top):
            yield {"source": names[0][row[above[i]]], "part": "term", "item": str(words[term[above[i]]]), "value": int(value[i])}


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *, least_docs: int = 3,
          top: int = 200, tile_terms: int = 4096, block_groups: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the
    language by divergence (``pair``), and the ``top`` terms that stand out
    against the language (``term``)."""
    counts = staged(count_terms(docs, text_col, lang_col, source_col), "divergence-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.filter(F.col("term").isNotNull()).withColumns({
        "lang_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term),
        "lead": F.min("source").over(of_term) == F.col("source")})
    kept = staged(kept.filter(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", "lead"),
                  "divergence-kept")

    total = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("lead").cast("long")).alias("leads"))
    of_lang = Window.partitionBy("lang")
    groups = counts.filter(F.col("term").isNull()).select("lang", "source").join(total, ["lang", "source"], "left")
    groups = groups.fillna(0, ["total", "leads"]).withColumns({
        "idx": (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long"),
        "groups": F.count(F.lit(1)).over(of_lang), "vocabulary": F.sum("leads").over(of_lang),
        "lang_total": F.sum("total").over(of_lang)})
    groups = staged(groups.withColumns({
        "tiles": F.greatest(F.lit(1), F.ceil(F.col("vocabulary") / tile_terms)).cast("long"),
        "blocks": F.ceil(F.col("groups") / block_groups).cast("long")}).drop("leads", "groups"), "divergence-groups")

    tile = F.pmod(F.xxhash64("term"), F.col("tiles"))
    # Spark broadcasts the groups when their file is small, and joins by sorting when it is not.
    cells = kept.join(groups.drop("total", "lang_total", "vocabulary"), ["lang", "source"]).withColumn("tile", tile)
    sizes = cells.filter("lead").groupBy("lang", "tile").agg(F.count(F.lit(1)).alias("in_tile"))
    described = groups.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).join(
        sizes, ["lang", "tile"], "left").fillna(0, ["in_tile"])
    unknown = F.lit(None)
    rows = described.select("lang", "tile", "idx", "blocks", "source", unknown.cast("string").alias("term"), F.col("total").alias("n"),
                            F.col("lang_total").alias("lang_n"), "vocabulary", "in_tile").unionByName(
        cells.select("lang", "tile", "idx", "blocks", unknown.cast("string").alias("source"), "term", "n", "lang_n",
                     unknown.cast("long").alias("vocabulary"), unknown.cast("long").alias("in_tile")))
    own, other = F.floor(F.col("idx") / block_groups).cast("long"), F.col("other")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumns({
        "block_a": F.least(own, other), "block_b": F.greatest(own, other)}).drop("other", "blocks")
    schema = arrow_schema(FOUND)

    def unit(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        return pa.Table.from_pylist([{"lang": lang, **x} for x in price_unit(table, block_groups, top)], schema=schema)

    found = staged(rows.groupBy(*UNIT).applyInArrow(unit, FOUND), "divergence-found")
    pairs = found.filter(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    terms = found.filter(F.col("part") == "term").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
