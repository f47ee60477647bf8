from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from utxoflow.llm import exact_dedup, jaccard
from utxoflow.llm.exact_dedup import ContentTable

WS = re.compile("[\x20\x09-\x0d]+")


def exact_model(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault(WS.sub("", text or ""), []).append((-len(text or ""), doc is None, doc if doc is not None else 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        for _, none, doc, _ in members:
            out.append((None if none else doc, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("options", [{}, {"table_mb": 0.0005, "window_mb": 0.0005}, {"window_rows": 1}])
def test_exact_dedup(docs, options):
    """Also with a table and windows so small that records spill over several levels."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = exact_dedup.exact_dedup(docs, **options).collect()
    want, groups = exact_model(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    assert sum(r["kept"] for r in got) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_hot_group(spark):
    rows = [(i, "same text" + " " * (i % 3)) for i in range(600)] + [(600 + i, f"text {i}") for i in range(600)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), table_mb=0.01).collect()
    hot = [r for r in got if r["group_size"] == 600]
    assert len(got) == 1200 and len(hot) == 600 and {r["keep_id"] for r in hot} == {2}


def test_members_of_a_hot_group_stay_with_their_records(spark):
    """A group over many windows, with a window for each tenth row."""
    rows = [(i, "same") for i in range(300)] + [(300 + i, f"t{i}") for i in range(50)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), window_rows=10).collect()
    assert len(got) == 350 and sum(r["kept"] for r in got) == 51
    assert {(r["keep_id"], r["group_size"]) for r in got if r["doc_id"] < 300} == {(0, 300)}


def test_exact_dedup_empty(no_docs):
    assert exact_dedup.exact_dedup(no_docs).collect() == []
    assert exact_dedup.drop_copies(no_docs).collect() == []


def test_drop_copies_keeps_columns_and_one_row_each(docs):
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    norm = [WS.sub("", r["text"] or "") for r in got.collect()]
    assert len(norm) == len(set(norm)) == len({WS.sub("", r["text"] or "") for r in docs.collect()})


def test_content_table_compares_contents_not_hashes():
    table = ContentTable(bits=2)
    for i in range(50):
        slot, cell = table.find(7, str(i).encode())
        assert slot < 0
        table.add(cell, 7, str(i).encode())
    assert [table.find(7, str(i).encode())[0] for i in range(50)] == list(range(50))


def sets_of(rows):
    sets = []
    for doc, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x20\x09-\x0d]+", lower)
        grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
        sets.append((doc, frozenset(grams)))
    return sets


def jaccard_model(rows, percent=75):
    sets = sets_of(rows)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        least.setdefault(find(i), []).append(doc)
    return sorted(((doc, len(s), min((x for x in least[find(i)] if x is not None), default=None) if s else doc)
                   for i, (doc, s) in enumerate(sets)), key=str)


def same(got, rows):
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == jaccard_model(rows)


def test_jaccard_edges(docs):
    same(jaccard.near_duplicates(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block_rows": 3, "sample_one_in": 1}), (3, {"block_rows": 5, "frequent": 0})])
def test_jaccard_random(spark, seed, options):
    """Near copies around the threshold, common passages, equal texts; blocks of a few rows."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(25)]
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 30, 60, 120]))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(copy + (common if rng.random() < 0.3 else []))))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    same(jaccard.near_duplicates(frame, **options).collect(), rows)


def test_jaccard_empty_and_keep_one(docs, no_docs):
    assert jaccard.near_duplicates(no_docs).collect() == []
    assert jaccard.keep_one(no_docs).collect() == []
    got = jaccard.keep_one(docs)
    assert got.columns == docs.columns
    want = {c for _, _, c in jaccard_model([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert {r["doc_id"] for r in got.collect()} == want


def test_bit_counts_bound_overlap_from_above():
    rng = np.random.default_rng(0)
    for _ in range(200):
        pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 380))) for _ in range(2))
        x, y = jaccard.signature(a), jaccard.signature(b)
        size = min(len(x), len(y))
        if jaccard.linked(a, b, 75):
            assert jaccard.may_link(jaccard.folded(x, size), jaccard.folded(y, size), len(a), len(b), 75)
        both = len(np.intersect1d(a, b))
        assert jaccard.linked(a, b, 75) == (100 * both >= 75 * (len(a) + len(b) - both))


def test_components_are_least_members(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_keep_one_row_of_each_class(spark):
    """Null ids and repeated ids of other classes do not keep a near duplicate."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(None, "a single text"), (None, a), (None, b), (None, b + " tail"), (1, b), (2, c), (1, c + " tail"), (2, a + " tail"), (7, ""), (7, None)]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in spark.createDataFrame(
        [(None, "a single text"), (1, b), (1, c + " tail"), (2, a + " tail"), (7, ""), (7, None)], "doc_id bigint, text string").collect())
