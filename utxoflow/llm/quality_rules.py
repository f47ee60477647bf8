"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target
and the raw corpus, next to plain counting rules.  DataFrame functions only.

Words are maximal runs without ASCII white space.  Every word and every pair
of neighbouring words is an n-gram, hashed into ``2 ** bits`` buckets.  The raw
multinomial counts the n-grams of every document, the target those of
documents that pass stricter counting rules (``trusted``).  With add-one
smoothing, a document's score is the mean over its n-grams of
``log p_target(bucket) - log p_raw(bucket)``; it is kept when the base rules
pass and the score is at least ``threshold``.  No sampling, no randomness:
equal inputs give equal verdicts.  The two count vectors have a fixed number of
buckets; their ratios form one array that a scalar subquery hands to the scan,
where documents are scored without a shuffle.

Defined results: null or empty text, or white space only, has no words: all
counts 0, score null, ``base_failed`` true, ``kept`` false.  With no trusted
document the target is uniform.  Repeated rows are judged alike; an empty table
gives no rows; columns other than the id and the text pass through
``quality_columns`` untouched unless they bear the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utxoflow.llm.common import SPACE, let, staged

BITS = 18
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")
#: Low bits of a window's hash that hold its place.
PLACE_BITS = 20
#: Between junk (mean log ratio below -0.19 on the labelled rows) and clean text (above -0.05).
THRESHOLD = -0.15


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    """64-bit hash of every word; n-grams hash these instead of the words again."""
    return F.transform(words, lambda w: F.xxhash64(w))


def base_counts(text: Column, words: Column, hashes: Column, n: Column) -> dict[str, Column]:
    """The counting columns of one document; ``words``, ``hashes`` and ``n`` are bound."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def window(h: Column, i: Column) -> Column:
        return F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))

    def equal(i: Column, j: Column) -> Column:  # do the windows at places i and j hold the same words?
        return F.forall(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.get(words, i + k) == F.get(words, j + k))

    def ordered(grams: Column) -> Column:
        return F.sort_array(F.slice(grams, F.lit(1), F.greatest(n - 2, F.lit(0))))

    # Equal windows are neighbours once sorted by hash.  Places stand in the low bits of the hash, so plain numbers
    # are sorted; should unequal windows share the rest of a hash (or a text be too long), whole hashes decide.
    low = F.lit((1 << PLACE_BITS) - 1).cast("bigint")
    packed = ordered(F.transform(hashes, lambda h, i: window(h, i).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint"))))
    whole = ordered(F.transform(hashes, lambda h, i: F.struct(window(h, i).alias("h"), i.alias("i"))))

    def place(x: Column) -> Column:
        return x.bitwiseAND(low).cast("int")

    def alike(x: Column, y: Column) -> Column:
        return F.shiftright(x.bitwiseXOR(y), PLACE_BITS) == 0

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & equal(x["i"], y["i"])

    def by_whole(s: Column) -> Column:
        again = F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1)))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def by_packed(s: Column) -> Column:
        again = F.filter(s, lambda x, k: alike(x, F.get(s, k + 1)) | alike(x, F.get(s, k - 1)))
        return let(again, lambda a: F.when(
            F.size(F.filter(a, lambda x, k: alike(x, F.get(a, k + 1)) & ~equal(place(x), place(F.get(a, k + 1))))) == 0,
            F.sort_array(F.transform(a, place))).otherwise(let(whole, by_whole)))

    # first places of windows whose words occur again, in order
    starts = F.when(n < (1 << PLACE_BITS), let(packed, by_packed)).otherwise(let(whole, by_whole))

    def covered(p: Column) -> Column:  # words covered by the windows that start at p
        width = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(width, F.lit(0), lambda a, x: a + x)

    return {
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace(full, r"[^#*$%&|<>]+", "")).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": let(starts, covered).cast("bigint"),
    }


def trusted(text: Column, n: Column) -> Column:
    """Stricter rules that only choose the target text: enough words, few
    symbols, few capitals, few repeated lines."""
    full = F.coalesce(text, F.lit(""))
    symbols = F.length(F.regexp_replace(full, r"[^#*$%&|<>]+", ""))
    capitals = F.length(F.regexp_replace(full, r"[^\p{Lu}]+", ""))
    lines = F.split(full, "\n")
    repeats = let(lines, lambda x: 2 * F.size(F.array_distinct(x)) >= F.size(x))
    return (n >= 50) & (20 * symbols <= n) & (5 * capitals <= F.length(full)) & repeats


def buckets_of(hashes: Column, n: Column, bits: int) -> Column:
    """Bucket of every word and every pair of neighbouring words."""
    mask = F.lit((1 << bits) - 1).cast("bigint")
    ones = F.transform(hashes, lambda h: h.bitwiseAND(mask).cast("int"))
    twos = F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)).bitwiseAND(mask).cast("int"))
    return F.concat(ones, F.slice(twos, F.lit(1), F.greatest(n - 1, F.lit(0))))


def fit_ratios(docs: DataFrame, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row, ``ratios``: log p_target - log p_raw by bucket, counted over all
    documents and written to the shared folder."""
    words = words_of(F.col(text_col))
    grams = docs.select(let(words, lambda w: let(hashes_of(w), lambda h: F.struct(
        trusted(F.col(text_col), F.size(w)).cast("int").alias("t"), buckets_of(h, F.size(w), bits).alias("b")))).alias("d"))
    counts = (grams.select(F.col("d.t").alias("t"), F.explode("d.b").alias("b")).groupBy("b")
              .agg(F.sum("t").alias("target"), F.count("*").alias("raw")))
    # from here on at most 2 ** bits rows: every bucket, with one added to its counts
    every = docs.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("b"))
    smooth = staged(every.join(counts, "b", "left").select(
        "b", *(F.coalesce(c, F.lit(0)).alias(c) + 1 for c in ("target", "raw"))).toDF("b", "target", "raw"), "ngrams")
    t, r = F.sum("target").over(Window.partitionBy(F.lit(0))), F.sum("raw").over(Window.partitionBy(F.lit(0)))
    rows = smooth.select("b", (F.log("target") - F.log("raw") + F.log(r / t)).alias("ratio"))
    found = F.array_sort(F.collect_list(F.struct("b", "ratio")))
    return staged(rows.agg(F.transform(found, lambda x: x["ratio"]).alias("ratios")), "ratios")


def quality_columns(docs: DataFrame, ratios: DataFrame, text_col: str = "text", *, bits: int = BITS,
                    threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, llr, base_failed and kept (names after ``prefix``)."""
    text = F.col(text_col)

    def judged(w: Column, h: Column, n: Column, table: Column) -> Column:
        total = F.aggregate(buckets_of(h, n, bits), F.lit(0.0), lambda a, b: a + F.get(table, b))
        return F.struct(n.cast("bigint").alias("n_words"), *(c.alias(k) for k, c in base_counts(text, w, h, n).items()),
                        F.when(n > 0, total / (2 * n - 1)).alias("llr"))

    def verdict(q: Column) -> Column:  # bound once: a filter on ``kept`` does not judge a text again
        failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
        return F.struct(*(q[k].alias(k) for k in COUNTS), failed.alias("base_failed"),
                        (~failed & F.coalesce(q["llr"] >= threshold, F.lit(False))).alias("kept"))

    # the subquery is folded into the one place that uses it, so no row carries the array
    rows = docs.withColumn("__ratios", ratios.scalar()).withColumn("__quality", let(
        F.col("__ratios"), lambda table: let(words_of(text), lambda w: let(
            hashes_of(w), lambda h: let(F.size(w), lambda n: let(judged(w, h, n, table), verdict)))))).drop("__ratios")
    names = (*COUNTS, "base_failed", "kept")
    return rows.withColumns({prefix + k: F.col("__quality")[k] for k in names}).drop("__quality")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, bits: int = BITS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the counting columns, llr, base_failed and kept of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = quality_columns(source, fit_ratios(source, "text", bits), "text", bits=bits, threshold=threshold)
    return out.drop("text")


def drop_low_quality(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    ratios = fit_ratios(docs, text_col, options.get("bits", BITS))
    out = quality_columns(docs, ratios, text_col, prefix="__q_", **options)
    return out.filter("__q_kept").select(*docs.columns)
