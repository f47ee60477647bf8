from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from utxoflow.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def model(rows, least=3, top=200):
    """Dense audit of (text, lang, source) in Python integers."""
    docs = [(lang or "", source or "", TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        in_docs = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in in_docs.items() if n >= least)
        counts = defaultdict(Counter)
        for own, source, words in docs:
            if own == lang:
                counts[source].update(w for w in words if in_docs[w] >= least)
        whole = sum(counts.values(), Counter())

        def share(count):
            total = sum(count.values())
            return {t: 1 + 1000000000 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in p:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in p if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in
                        enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit])]
    return sorted(out)


def got(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def random_rows(rng, n=220, sources=9, vocabulary=120):
    words = [f"{rng.choice(['a', 'Über', 'é', '日本', 'zz'])}{'xy' * (k % 7)}{chr(97 + k % 26)}" for k in range(vocabulary)]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(sources)}"
        own = words[: 20 + 9 * (hash(source) % 5)] if source != "hot" else words
        rows.append((" ".join(rng.choice(own) + rng.choice([",", "", "1", "-"]) for _ in range(rng.randint(0, 60))),
                     rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "empty"), ("", "en", "empty"), (None, None, None), ("!!! 12", "fr", "a"), ("once", "fr", "b"), ("x " * 3, "fr", None),
             ("Solo solo", "it", "a"), ("solo", "it", "a"), ("SOLO", "it", "a"), ("w" * 30_000, "en", "s1"), ("word " * 20_000, "de", "s2")]
    return rows + rows[:30]


def test_against_dense_model(spark):
    rows = random_rows(random.Random(5))
    frame = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "text string, lang string, source string, n bigint, term string, value int")
    want = model(rows)
    assert got(divergence.audit(frame)) == want
    # Many tiles, blocks of groups against each other, few terms reported.
    assert got(divergence.audit(frame, tile_terms=16, block_groups=3)) == want
    assert got(divergence.audit(frame, tile_terms=7, block_groups=2, top=5)) == model(rows, top=5)


def test_empty_table(spark):
    none = divergence.audit(spark.createDataFrame([], "text string, lang string, source string"))
    assert none.collect() == [] and none.columns == list(COLUMNS)


def test_walk_covers_every_pair_and_term():
    rng = np.random.default_rng(2)
    for _ in range(120):
        n_a, n_b, terms = (int(x) for x in rng.integers(1, 20, 3))
        same = bool(rng.integers(2))
        n_b = n_a if same else n_b
        a = rng.integers(0, 4, (n_a, terms)) * (rng.random((n_a, terms)) < rng.random())
        b = a if same else rng.integers(0, 4, (n_b, terms)) * (rng.random((n_b, terms)) < 0.2)
        height = max(1, int(max(n_a, n_b, terms) - 1).bit_length())
        trees = [divergence.QuadTree(*np.nonzero(m), height) for m in (a, b)]
        empty, leaves = divergence.walk(*trees, n_a, n_b, terms, height, same)
        met = np.zeros((n_a, n_b), np.int64)
        for first, second, x, y in leaves:
            np.add.at(met, (first, second), 1)
            assert ((x >= 0) | (y >= 0)).all()
        pairs = np.triu(np.ones((n_a, n_b), bool), 1) if same else np.ones((n_a, n_b), bool)
        assert ((met + empty)[pairs] == terms).all()
        assert (met[pairs] == ((a[:, None, :] > 0) | (b[None] > 0)).sum(axis=2)[pairs]).all()


def test_prices_against_dense_sums():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n_a, n_b, terms, missing = (int(x) for x in rng.integers(1, 12, 4))
        a, b = (rng.integers(0, 50, (n, terms)) * (rng.random((n, terms)) < 0.3) for n in (n_a, n_b))
        totals = [m.sum(axis=1) + int(rng.integers(0, 1000)) for m in (a, b)]
        cells = [(*np.nonzero(m), m[np.nonzero(m)]) for m in (a, b)]
        forth, back = divergence.price_pairs(cells, totals, terms + missing, missing, terms, False)
        p, q = ([[1 + 10**9 * (int(c) + 1) // (int(t) + terms + missing) for c in [*row, *[0] * missing]] for row, t in zip(m, total)]
                for m, total in zip((a, b), totals))
        assert forth.tolist() == [[sum((x - y) ** 2 // y for x, y in zip(u, v)) for v in q] for u in p]
        assert back.tolist() == [[sum((x - y) ** 2 // x for x, y in zip(u, v)) for v in q] for u in p]


def test_shares_of_large_counts():
    for count, total, terms in ((7 * 10**14, 8 * 10**15, 10**6), (0, 10**15, 5), (10**12, 10**12, 1), (0, 0, 1)):
        assert int(divergence.shares(np.array([count]), total, terms)[0]) == 1 + 10**9 * (count + 1) // (total + terms)
