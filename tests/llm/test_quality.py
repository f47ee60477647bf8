from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from utxoflow.llm import quality_gbt, quality_rules
from utxoflow.llm.common import crc_mod, table

SF = "/root/testdata/sf0.01"


def counts_model(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            n < 50 or 100 * len(again) > 50 * n)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark, docs):
    more = spark.createDataFrame([(100, "a b c a b c a b"), (101, "a a a a"), (102, "x y z\nx y z\n\n \nx y z q"), (103, "#*$%&|<> <b>")],
                                 "doc_id bigint, text string")
    for frame in (docs, more, table(spark, SF, "documents")):
        want = sorted((str(r["doc_id"]), *counts_model(r["text"])) for r in frame.collect())
        got = quality_rules.quality_rules(frame).collect()
        assert sorted((str(r["doc_id"]), *(r[k] for k in NAMES)) for r in got) == want


def test_ratio_score_and_verdict(spark):
    """The score against a plain count of the same hashed n-grams."""
    docs = table(spark, SF, "documents").limit(300).cache()
    bits = 12
    words = quality_rules.words_of(F.col("text"))
    rows = docs.select("doc_id", "text", F.size(words).alias("n"),
                       quality_rules.buckets_of(quality_rules.hashes_of(words), F.size(words), bits).alias("b"),
                       quality_rules.trusted(F.col("text"), F.size(words)).alias("t")).collect()
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(r["b"])
        target.update(r["b"] if r["t"] else [])
        assert len(r["b"]) == max(0, 2 * r["n"] - 1)
    a, z = sum(raw.values()) + 2**bits, sum(target.values()) + 2**bits
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, bits=bits).collect()}
    for r in rows:
        want = sum(math.log((target[b] + 1) / z) - math.log((raw[b] + 1) / a) for b in r["b"]) / len(r["b"])
        assert abs(got[r["doc_id"]]["llr"] - want) < 1e-6
        assert got[r["doc_id"]]["kept"] == (not got[r["doc_id"]]["base_failed"] and got[r["doc_id"]]["llr"] >= quality_rules.THRESHOLD)


def test_rules_keep_good_and_reject_bad(spark):
    got = quality_rules.quality_rules(table(spark, SF, "documents")).join(table(spark, SF, "labels"), "doc_id")
    n = {(r["quality"], r["base_failed"], r["kept"]): r["count"] for r in got.groupBy("quality", "base_failed", "kept").count().collect()}
    assert (1, False, False) not in n and n.get((0, False, True), 0) == 0


def test_junk_is_told_apart_in_varied_text(spark):
    """1.2 million distinct n-grams: junk still scores below the threshold, prose above."""
    words = F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.concat(
        F.when(F.col("junk"), F.lit("#")).otherwise(F.lit("w")), F.pmod(F.xxhash64("doc_id", i), F.lit(200_000)).cast("string")))
    docs = spark.range(3050).select(F.col("id").alias("doc_id"), (F.col("id") < 50).alias("junk")).select(
        "doc_id", F.array_join(words, " ").alias("text"))
    got = quality_rules.quality_rules(docs).filter("not base_failed").select("doc_id", "kept").collect()
    assert len(got) == 3050 and {r["doc_id"] for r in got if not r["kept"]} == set(range(50))


def test_rules_edges(docs, no_docs):
    got = quality_rules.drop_low_quality(docs)
    assert got.columns == docs.columns and 0 < got.count() < docs.count()
    assert quality_rules.quality_rules(no_docs).collect() == [] and quality_rules.drop_low_quality(no_docs).collect() == []
    none = quality_rules.quality_rules(docs).filter("n_words = 0").first()
    assert none["llr"] is None and none["base_failed"] and not none["kept"]


def test_rules_plan_is_native(spark):
    plan = quality_rules.quality_rules(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_trees_walk_like_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    model = quality_gbt.fit_trees(x, y, trees=30)

    def walk(row):
        total = model.base
        for at in model.roots:
            while model.left[at] >= 0:
                at = model.left[at] + (row[model.feature[at]] > model.threshold[at])
            total += model.value[at]
        return 1 / (1 + math.exp(-total))

    probe = rng.normal(size=(200, 4))
    assert np.allclose(model.score(probe), [walk(r) for r in probe])
    truth = (probe[:, 0] > 0.3) ^ (probe[:, 2] < -0.5)
    assert ((model.score(probe) > 0.5) == truth).mean() > 0.95


def test_trees_without_two_classes():
    for y, want in ((np.zeros(0), 0.5), (np.ones(5), 1.0), (np.zeros(5), 0.0)):
        model = quality_gbt.fit_trees(np.zeros((len(y), 3)), y)
        assert np.allclose(model.score(np.zeros((2, 3))), want, atol=1e-5)


def test_classifier_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = crc_mod(F.col("doc_id"), 5) == 0
    got = quality_gbt.score(docs, quality_gbt.fit(docs, labels, learn=~held), held_out=held)
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.3) == r["quality"] for r in rows]) > 0.95


def test_classifier_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (1, 1), (9, 1), (20, 0), (None, 1), (3, None)], "doc_id bigint, quality int")
    model = quality_gbt.fit(docs, labels, least=1)
    got = quality_gbt.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality_gbt.score(no_docs, model).collect() == []
    assert {r["score"] for r in quality_gbt.score(docs, quality_gbt.fit(docs, labels.limit(0))).collect()} == {0.5}
    few = quality_gbt.fit(docs, labels, max_rows=1)
    assert quality_gbt.score(docs, few).count() == docs.count()


def test_statistics_of_wordless_text():
    assert quality_gbt.statistics(b"") == quality_gbt.statistics(b" \n\t") == [0.0] * len(quality_gbt.FEATURES)
