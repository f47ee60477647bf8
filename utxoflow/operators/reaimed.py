"""Operators re-aimed from the reference's simulator and file scanner
(R1 coin selection, R2 transaction-shape mix, R3 pattern scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.operators.scan import prefix_scan, with_buckets
from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.schema import MONEY_SUM
from utxoflow.session import staged

# The eight suspicious-text patterns of the reference's scanner
# (matched case-insensitively, anywhere in the text).
SUSPICIOUS_PATTERNS = [
    r"eval\(",
    r"Function\(",
    r"fetch\(",
    r"XMLHttpRequest",
    r"child_process",
    r"wasm",
    r"base64_decode",
    r"unsafe",
]


def select_coins(utxos: DataFrame, targets: DataFrame, opts: LedgerOptions = DEFAULT) -> DataFrame:
    """R1, largest-first coin selection: per address, the shortest prefix of
    its unspent outputs by (value desc, tx_id, output_index) whose sum covers
    the target; addresses whose total is below the target select nothing.

    ``utxos``: address, tx_id, output_index, value.  ``targets``: address, target.
    The running sum is the skew-safe two-level scan (pieces of the order)."""
    u = utxos.join(targets, "address").withColumn("_neg", -F.col("value"))
    order = ["_neg", "tx_id", "output_index"]
    b, hot = with_buckets(u, "address", order, opts)
    run = prefix_scan(b, "address", order, hot, sums={"running": F.col("value").cast(MONEY_SUM)})
    # A row is needed iff the sum *before* it is still short of the target;
    # an address is covered iff one row crosses the target (at most one per
    # address), so no separate total is needed.  All sums are exact decimals: a
    # target that a prefix meets exactly takes no coin more.
    exact = F.col("target").cast(MONEY_SUM)
    needed = staged(run.filter(F.col("running") - F.col("value").cast(MONEY_SUM) < exact), "coins")
    crossing = needed.filter(F.col("running") >= exact).select("address")
    return (needed.join(crossing, "address", "left_semi")
               .select("address", "tx_id", "output_index", "value",
                       F.col("running").cast("double").alias("running"), "target"))


def pattern_mix(tx: DataFrame) -> DataFrame:
    """R2: share of each ``tx_id`` label prefix (``fanout-...`` -> fanout).

    The total is a scalar subquery in the same plan (no unpartitioned window,
    no join)."""
    labeled = tx.select(F.regexp_extract("tx_id", r"^([a-z]+)-", 1).alias("label"))
    total = tx.select(F.count(F.lit(1))).scalar()
    return (labeled.groupBy("label").agg(F.count(F.lit(1)).alias("txs"))
                   .withColumn("share", F.col("txs") / total))


def pattern_scan(docs: DataFrame, id_col: str, text_col: str,
                 patterns: list[str] | None = None) -> DataFrame:
    """One row per (document, pattern) whose case-insensitive regex
    matches anywhere in the whole text.  Each pattern is a literal ``rlike``
    (compiled once per task, inside codegen); the hits of a row are gathered
    in one array and exploded -- no join, no pattern-side shuffle."""
    pats = list(patterns or SUSPICIOUS_PATTERNS)
    text = F.col(text_col)
    hits = F.array(*[F.when(text.rlike("(?i)" + p), F.lit(p)) for p in pats])
    # No alternation prefilter: one regex per pattern keeps each pattern's
    # literal-prefix search fast, while an alternation is several times slower.
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("pattern"))
