"""Quality classifier: histogram gradient-boosted trees over document
statistics, flattened into arrays.

Each text becomes a fixed row of statistics (lengths, shares of character
classes, repetition of words and lines).  The trees are fitted on the driver
from a sample of labelled rows whose size ``max_rows`` bounds (rows are taken by
a hash of their id); statistics are binned into ``bins`` quantile bins and each
level is grown from gradient histograms.  All trees are laid out one after the
other in flat arrays (feature, threshold, left child, value); a batch of
documents walks all trees at once, one numpy step per level.

Defined results: null, empty or wordless text has statistics 0 and a score;
without labels (or with one class only) every score is the share of label 1,
0.5 if there is none; a doc_id labelled more than once takes its largest
label; repeated rows score alike; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import SPACE_BYTES, arrow_schema, batch_of, slices, staged, text_bytes
from utxoflow.session import pickle_by_value

FEATURES = ("log_bytes", "log_words", "word_bytes", "symbols", "stops", "digits", "capitals", "non_ascii", "line_feeds",
            "repeated_neighbours", "distinct_words", "distinct_lines", "ended_words", "longest_word", "other_marks")


def class_matrix() -> np.ndarray:
    """256 x classes: which byte counts for which character class."""
    out = np.zeros((256, 8))
    for k, chars in enumerate((b"#*$%&|<>", b".,;:!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
        out[list(chars), k] = 1
    out[0x80:, 4] = 1
    out[0x0A, 5] = 1
    out[list(SPACE_BYTES), 6] = 1
    out[list(b"\"'()-/=@[\\]^_`{}~+"), 7] = 1
    return out


CLASSES = class_matrix()


def statistics(raw: bytes) -> list[float]:
    """The row of FEATURES of one text in UTF-8."""
    words = raw.split()  # at ASCII white space
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES
    inked = max(1.0, size - counts[6])
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [np.log1p(size), np.log1p(n), inked / n, counts[0] / inked, counts[1] / inked, counts[2] / inked, counts[3] / inked,
            counts[4] / inked, counts[5] / n, sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n,
            len(set(lines)) / len(lines), sum(w[-1] in b".,;:!?" for w in words) / n, max(map(len, words)), counts[7] / inked]


@dataclass
class Trees:
    """Flat trees: inner nodes have ``left`` (right is left + 1), leaves -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for a matrix of statistics."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        line = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            left = self.left[at]
            right = rows[line, self.feature[at]] > self.threshold[at]
            at = np.where(left >= 0, left + right, at)
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
              shrink: float = 1.0, least: int = 10) -> Trees:
    """Logistic boosting on binned statistics; every level of a tree is split
    from one histogram of gradients per node and feature."""
    share = float(y.mean()) if len(y) else 0.5
    none = Trees(*(np.zeros(0, k) for k in (int, float, int, float, int)), 0, 0.0)
    if len(y) == 0 or share in (0.0, 1.0):
        none.base = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
        return none
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(0), threshold.append(0.0), left.append(-1), value.append(0.0)
        return len(left) - 1

    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        roots.append(node())
        level = [(roots[-1], np.arange(len(y)))]
        for d in range(depth + 1):
            below = []
            for me, rows in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                value[me] = rate * g / (h + shrink)
                if d == depth or len(rows) < 2 * least:
                    margin[rows] += value[me]
                    continue
                best = (1e-6, -1, 0)
                for f in range(x.shape[1]):
                    b = binned[rows, f]
                    gl = np.cumsum(np.bincount(b, grad[rows], bins))
                    hl = np.cumsum(np.bincount(b, hess[rows], bins))
                    nl = np.cumsum(np.bincount(b, minlength=bins))
                    gain = gl**2 / (hl + shrink) + (g - gl)**2 / (h - hl + shrink) - g**2 / (h + shrink)
                    gain[(nl < least) | (len(rows) - nl < least)] = -1
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
                _, f, k = best
                if f < 0 or k >= len(edges[f]):
                    margin[rows] += value[me]
                    continue
                feature[me], threshold[me], left[me], value[me] = f, float(edges[f][k]), node(), 0.0
                node()
                right = binned[rows, f] > k
                below += [(left[me], rows[~right]), (left[me] + 1, rows[right])]
            level = below
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots), depth, base)


STATS = "doc_id bigint, " + ", ".join(f"{f} double" for f in FEATURES)
SCORED = "doc_id bigint, held_out boolean, score double"


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        learn: Column | None = None, *, max_rows: int = 20_000, **options) -> Trees:
    """Fit on at most about ``max_rows`` labelled documents for which ``learn``
    (a condition on the id) holds."""
    schema = arrow_schema(STATS)

    def run(batches):
        for batch in slices(batches):
            rows = np.array([statistics(text_bytes(t)) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            yield batch_of(schema, {"doc_id": batch.column(0), **{f: rows[:, k] for k, f in enumerate(FEATURES)}})

    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.filter(learn) if learn is not None else known
    known = known.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = staged(known, "labels")
    n = known.count()
    if n > max_rows:  # by hash: the same rows each time, about max_rows of them
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(known.select("doc_id")), "doc_id")  # about max_rows ids
    rows = sample.mapInArrow(run, STATS).join(known, "doc_id").orderBy("doc_id", *FEATURES).limit(2 * max_rows).toPandas()
    return fit_trees(rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float), **options)


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out and the probability of label 1 of every row."""
    schema = arrow_schema(SCORED)

    def run(batches):
        for batch in slices(batches, 256):
            rows = np.array([statistics(text_bytes(t)) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            yield batch_of(schema, {"doc_id": batch.column(0), "held_out": batch.column(2).cast(pa.bool_()), "score": model.score(rows)})

    flag = F.lit(False) if held_out is None else held_out
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col), flag.alias("held_out")).mapInArrow(run, SCORED)


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
