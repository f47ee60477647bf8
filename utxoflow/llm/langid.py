"""Language id by language-bitmask n-gram filters.

Learning counts letter trigrams per language (one shuffle of partial counts).
A trigram belongs to a language when its share of that language's trigrams is
at least ``rival`` times its largest share in any language, however rare it is.
The pairs fill one bit-sliced Bloom filter: ``2 ** bits`` slots, each a bitmask
with one bit per language (as many 64-bit slices as the languages need, narrower
masks for few languages).  And-ing the ``hashes`` slots of a trigram returns all
languages that contain it at once.

The filter's size follows the counted pairs: the fullest plane has at most ``fill``
of its bits set.  Spark or-s the bits in blocks of slots, and only finished blocks
come to the driver.  ``most_bits`` bounds the filter's memory, not what it holds:
all pairs are in it at any size; beyond the bound its planes are fuller and have
more false positives, which the decision corrects for.

A text's popcount per language, corrected for the false positives expected
from that language's bit plane, decides; ties go to the language with more
learned text, then to the first by name.

Letters are Unicode letters in lower case, everything else separates words.
Defined results: null text or a text without letters is ``und`` with score 0; a
text none of whose trigrams is known gets the language with most learned
text and score 0; rows with null text or language teach nothing; with no
taught language every text is ``und``; repeated rows are judged alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, slices, staged, worker_cache
from utxoflow.session import pickle_by_value

UNKNOWN = "und"
#: Code points handled at once, so that a very long text needs bounded memory.
CHUNK = 1 << 20
COUNTS = "lang string, gram bigint, n bigint"
PREDICTED = "doc_id bigint, lang_pred string, score double, held_out boolean"


def letters() -> np.ndarray:
    """Which code points are letters."""
    return worker_cache("letters", lambda: np.array([chr(i).isalpha() for i in range(0x110000)]))


def trigrams(text: str, at: int = 0, size: int = CHUNK) -> tuple[np.ndarray, bool]:
    """Trigrams around the ``size`` code points from ``at`` (beyond the text's
    ends stands a blank), packed into 63 bits; whether one of them is a letter."""
    part = (text[at - 1] if at else " ") + text[at:at + size] + (text[at + size:at + size + 1] or " ")
    points = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    is_letter = letters()[points]
    inner = is_letter[1:-1]
    if not inner.any():
        return np.empty(0, np.int64), False
    points = np.where(is_letter, points, 32)
    return ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[inner], True


def all_trigrams(text: str | None):
    """``trigrams`` of a whole text, a chunk at a time."""
    for at in range(0, len(text or ""), CHUNK):
        yield trigrams(text, at)


def mask_type(languages: int) -> np.dtype:
    """The narrowest mask that has a bit for every language of a slice."""
    return np.dtype(next((f"u{size}" for size in (1, 2, 4) if languages <= 8 * size), "u8"))


class Filter:
    """Bit-sliced Bloom filter from trigrams to sets of languages."""

    def __init__(self, languages: list[str], weights: list[int], bits: int, hashes: int):
        self.languages, self.bits, self.hashes = languages, bits, hashes
        self.slices = max(1, -(-len(languages) // 64))
        self.slots = np.zeros((self.slices, 1 << bits), dtype=mask_type(len(languages)))
        self.prior = max(range(len(languages)), key=lambda i: (weights[i], -i), default=None)
        self.order = sorted(range(len(languages)), key=lambda i: (-weights[i], i))

    def places(self, grams: np.ndarray):
        """Slot numbers of each hash function (multiply, mix, keep the top bits)."""
        x = grams.astype(np.uint64)
        for k in range(self.hashes):
            y = (x ^ (x >> np.uint64(31 + k))) * np.uint64((0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019) & (2**64 - 1))
            y = (y ^ (y >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield (y >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, language: int, grams: np.ndarray) -> None:
        part, bit = divmod(language, 64)
        for at in self.places(grams):
            np.bitwise_or.at(self.slots[part], at, self.slots.dtype.type(1 << bit))

    def mask(self, language: int):
        return self.slots.dtype.type(1 << language % 64)

    def seal(self) -> "Filter":
        """False positive rate per language: its plane's fill to the power of the hashes."""
        fill = [np.count_nonzero(self.slots[i // 64] & self.mask(i)) / (1 << self.bits) for i in range(len(self.languages))]
        self.false = np.minimum(np.array(fill) ** self.hashes, 0.999999)
        return self

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """Bitmasks (slices x grams) of the languages that contain each gram."""
        found = None
        for at in self.places(grams):
            found = self.slots[:, at] if found is None else found & self.slots[:, at]
        return found

    def decide(self, hits: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score from popcounts (texts x languages) over n grams."""
        real = np.maximum(0, hits - n[:, None] * self.false) / (1 - self.false)
        order = np.array(self.order)
        best = order[np.argmax(real[:, order], axis=1)]
        total = real.sum(axis=1)
        score = np.where(total > 0, real[np.arange(len(n)), best] / np.maximum(total, 1e-12), 0.0)
        return best, score


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, rival: float = 0.1, fill: float = 0.3,
          least_bits: int = 16, most_bits: int = 24, hashes: int = 3, held_keys: int = 400_000) -> Filter:
    """Count trigrams of all rows with a language and fill the filter."""
    schema = arrow_schema(COUNTS)

    def flush(held):
        for lang, parts in held.items():
            total = pd.concat(parts).groupby(level=0).sum()
            yield batch_of(schema, {"lang": [lang] * len(total), "gram": total.index.to_numpy(np.int64), "n": total.to_numpy(np.int64)})

    def count(batches):
        held, keys = {}, 0
        for batch in slices(batches, 1024):
            grams: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams.setdefault(lang, []).extend(found for found, _ in all_trigrams(text))
            for lang, parts in grams.items():
                got = pd.Series(np.concatenate([np.empty(0, np.int64), *parts])).value_counts(sort=False)
                held.setdefault(lang, []).append(got)
                keys += len(got)
            if keys > held_keys:
                held = {k: [pd.concat(v).groupby(level=0).sum()] for k, v in held.items()}
                keys = sum(len(v[0]) for v in held.values())
                if keys > held_keys // 2:
                    yield from flush(held)
                    held, keys = {}, 0
        yield from flush(held)

    taught = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string"), F.col(text_col))
    counts = staged(taught.mapInArrow(count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}  # a row per language
    languages = sorted(totals)
    if not languages:
        return Filter([], [], least_bits, hashes).seal()
    spark = docs.sparkSession
    numbered = spark.createDataFrame([(k, i, totals[k]) for i, k in enumerate(languages)], "lang string, language int, total bigint")
    shares = counts.join(numbered, "lang").withColumn("share", F.col("n") / F.col("total"))
    best = F.max("share").over(Window.partitionBy("gram"))
    pairs = staged(shares.withColumn("best", best).filter(F.col("share") >= rival * F.col("best")).select("language", "gram"), "gram-pairs")
    most = pairs.groupBy("language").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    bits = min(most_bits, max(least_bits, int(hashes * most / fill).bit_length()))
    return filled(pairs, Filter(languages, [totals[k] for k in languages], bits, hashes)).seal()


#: Slots of a block that one group or-s together.
BLOCK_BITS = 12
PLACES = "slice int, block int, slot int, language int"
PLANES = "slice int, block int, plane binary"


def filled(pairs: DataFrame, empty: Filter) -> Filter:
    """``empty`` with the (language, gram) rows of ``pairs`` in it."""
    places_schema, planes_schema = arrow_schema(PLACES), arrow_schema(PLANES)
    kind = empty.slots.dtype

    def places(batches):
        for batch in batches:
            language = batch.column(0).to_numpy()
            for at in empty.places(batch.column(1).to_numpy()):
                yield batch_of(places_schema, {"slice": language // 64, "block": (at >> BLOCK_BITS).astype(np.int32),
                                               "slot": (at & ((1 << BLOCK_BITS) - 1)).astype(np.int32), "language": language})

    def block(table: pa.Table) -> pa.Table:
        slots = np.zeros(1 << BLOCK_BITS, kind)
        bits = np.left_shift(np.uint64(1), (table.column("language").to_numpy() % 64).astype(np.uint64)).astype(kind)
        np.bitwise_or.at(slots, table.column("slot").to_numpy(), bits)
        return pa.Table.from_pylist([{"slice": table.column("slice")[0].as_py(), "block": table.column("block")[0].as_py(),
                                      "plane": slots.tobytes()}], schema=planes_schema)

    for r in pairs.mapInArrow(places, PLACES).groupBy("slice", "block").applyInArrow(block, PLANES).toLocalIterator():
        at = r["block"] << BLOCK_BITS
        empty.slots[r["slice"], at:at + (1 << BLOCK_BITS)] = np.frombuffer(r["plane"], kind)
    return empty


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text",
            held_out: Column | None = None) -> DataFrame:
    """doc_id, lang_pred, score (the winner's share of all corrected counts) and
    the ``held_out`` flag as given."""
    schema = arrow_schema(PREDICTED)
    names = [*model.languages, UNKNOWN]

    def run(batches):
        for batch in slices(batches, 256):
            hits, sizes, has = [], [], []
            for text in batch.column(1).to_pylist():
                hit, size, letter = np.zeros(len(model.languages)), 0, False
                for grams, some in all_trigrams(text):
                    masks = model.lookup(grams)
                    hit += [np.count_nonzero(masks[i // 64] & model.mask(i)) for i in range(len(hit))]
                    size, letter = size + len(grams), letter or some
                hits.append(hit)
                sizes.append(size)
                has.append(letter)
            if model.languages:
                best, score = model.decide(np.array(hits, dtype=float), np.array(sizes, dtype=float))
                picked = np.where(has, best, len(names) - 1)
            else:
                picked, score = np.zeros(len(has), int), np.zeros(len(has))
            yield batch_of(schema, {"doc_id": batch.column(0), "lang_pred": [names[i] for i in picked],
                                    "score": np.where(has, score, 0.0), "held_out": batch.column(2).cast(pa.bool_())})

    flag = F.lit(False) if held_out is None else held_out
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col), flag.alias("held_out")).mapInArrow(run, PREDICTED)


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
