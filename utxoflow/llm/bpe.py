"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file fixes the vocabulary.  Its bytes are written as printable
characters (a table from each byte to one character), every way to split a
token into two smaller tokens becomes a merge ordered by the token's rank, and
the tokenizers library merges each match of the split pattern on its own.
Work runs over Arrow batches; a worker encodes a distinct match, and decodes its
ids, once and keeps a bounded number of them.  Ids carry offsets in code points of the text: a
token that ends inside a character covers that whole character.

Ranks alone decide a merge.  Where one token arises from several pairs, the one
with the longer left part comes first, as a merge from the left would have it;
tests hold the ids against the rank library, also for repetitive matches.

Decoding maps ids to byte characters and reverses the byte table.  Characters
split over tokens join again in the bytes; ``decode_text`` replaces what is not
valid UTF-8 (an id list cut inside a character) by U+FFFD.

Defined results: null or empty text gives no ids; repeated rows are encoded
alike; an empty table gives no rows; other columns are ignored; unknown ids
raise ``KeyError``.
"""

from __future__ import annotations

import gc
import hashlib
import os
from contextlib import contextmanager
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, slices, tiktoken_ranks, worker_cache
from utxoflow.session import pickle_by_value

#: Distinct matches of a generation; a worker remembers this and the one before.
REMEMBERED = 300_000
#: Distinct matches whose number of ids is remembered where only numbers are asked for.
COUNTED = 100_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class Remembered(dict):
    """Match to [ids, ids as text, decoded bytes, number of ids].  A match not seen before gets
    an empty entry, to be filled when the batch is encoded, so a match is looked
    up once; one that only ``old``, the generation before, has moves over."""

    def __init__(self, old: dict):
        self.old = old
        self.new: list[tuple[str, list]] = []

    def __missing__(self, piece: str) -> list:
        entry = self.old.get(piece)
        if entry is None:
            self.new.append((piece, entry := []))
        self[piece] = entry
        return entry


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, models

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks = tiktoken_ranks(path)
        self.chars = byte_characters()
        self.latin = {b: c for b, c in enumerate(self.chars)}
        self.byte_of = {c: b for b, c in enumerate(self.chars)}
        names = {token: self.to_chars(token) for token in ranks}
        merges = sorted((rank, -i, 0, token[:i], token[i:])
                        for token, rank in ranks.items() for i in range(1, len(token))
                        if token[:i] in ranks and token[i:] in ranks)
        self.model = Tokenizer(models.BPE(vocab={names[t]: r for t, r in ranks.items()},
                                          merges=[(names[a], names[b]) for *_, a, b in merges]))
        self.name_of = {r: names[t] for t, r in ranks.items()}
        self.bytes_of = {r: bytes(self.byte_of[c] for c in self.name_of[r]) for r in self.name_of}
        self.split = regex.compile(pattern).findall
        self.known = Remembered({})
        self.sizes: dict[str, int] = {}

    def to_chars(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.latin)

    def matches(self, texts: list[str | None]) -> list[list[list]]:
        """Per text, the entries [ids, ids as text, decoded bytes, number of ids] of its matches."""
        if len(self.known) > REMEMBERED:
            self.known = Remembered(dict(self.known))
        find = self.known.__getitem__
        found = [list(map(find, self.split(t))) if t else [] for t in texts]
        new, self.known.new = self.known.new, []
        raw = [piece.encode() for piece, _ in new]
        for (_, entry), got in zip(new, self.model.encode_batch(list(map(self.to_chars, raw)), add_special_tokens=False)):
            ids = got.ids
            entry += (ids, " ".join(map(str, ids)), self.decode(ids), len(ids))
        return found

    def count_batch(self, texts: list[str | None]) -> list[int]:
        """Number of ids of every text; ids are not kept."""
        if len(self.sizes) > COUNTED:
            self.sizes = {}
        pieces = [self.split(t) if t else [] for t in texts]
        new = list({p for found in pieces for p in found if p not in self.sizes})
        raw = [self.to_chars(p.encode()) for p in new]
        self.sizes.update(zip(new, (len(x.ids) for x in self.model.encode_batch(raw, add_special_tokens=False))))
        return [sum(map(self.sizes.__getitem__, found)) for found in pieces]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        return [list(chain.from_iterable(map(itemgetter(0), pieces))) for pieces in self.matches(texts)]

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """(start, end) of every id in code points of ``text``."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # code point of each byte
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids])
        return [(int(char[a]), int(char[b - 1]) + 1) for a, b in zip([0, *ends[:-1]], ends)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_text(self, ids: list[int]) -> str:
        return self.decode(ids).decode("utf-8", "replace")


@contextmanager
def no_cycles():
    """Without the cyclic collector: lists of ids make no cycles, and scanning
    them costs more than the merges.  It runs again after the task."""
    running = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if running:
            gc.enable()


def load(path: str, pattern: str) -> ByteBPE:
    return worker_cache(("bpe", path, pattern), lambda: ByteBPE(path, pattern))


def _where(vocabulary: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


ENCODED = "doc_id bigint, ids array<int>, starts array<int>, ends array<int>"
DECODED = "doc_id bigint, raw binary, text string"
ROUND = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Ids of every whole text with their offsets in code points."""
    where, schema = _where(vocabulary, pattern), arrow_schema(ENCODED)

    def run(batches):
        bpe = load(*where)
        for batch in slices(batches, 128):
            texts = batch.column(1).to_pylist()
            ids = bpe.encode_batch(texts)
            spans = [bpe.offsets(t, x) if x else [] for t, x in zip(texts, ids)]
            yield batch_of(schema, {"doc_id": batch.column(0), "ids": ids, "starts": [[a for a, _ in s] for s in spans],
                                    "ends": [[b for _, b in s] for s in spans]})

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", *, vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Bytes and text of every id list; a null list is empty."""
    where, schema = _where(vocabulary, pattern), arrow_schema(DECODED)

    def run(batches):
        bpe = load(*where)
        for batch in slices(batches, 128):
            raw = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
            yield batch_of(schema, {"doc_id": batch.column(0), "raw": raw, "text": [x.decode("utf-8", "replace") for x in raw]})

    return encoded.select(F.col(id_col).cast("bigint"), F.col(ids_col)).mapInArrow(run, DECODED)


def count_tokens(docs: DataFrame, text_col: str = "text", name: str = "n_tokens", *, vocabulary: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """``docs`` with the number of ids of every whole text as column ``name``."""
    where = _where(vocabulary, pattern)

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        bpe, held = load(*where), texts.tolist()
        with no_cycles():  # a few texts at a time, as the matches of many would fill the worker
            counts = [bpe.count_batch(held[at:at + 64]) for at in range(0, len(held), 64)]
        return pd.Series([n for part in counts for n in part], dtype="int64")

    return docs.withColumn(name, count(F.col(text_col)))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """Encode and decode every whole text; per row the number of ids and the
    digests of the ids and of the decoded bytes."""
    where, schema = _where(vocabulary, pattern), arrow_schema(ROUND)

    def run(batches):
        bpe = load(*where)
        said, decoded, size = map(itemgetter, (1, 2, 3))
        with no_cycles():
            for batch in slices(batches, 128):
                found = bpe.matches(batch.column(1).to_pylist())
                yield batch_of(schema, {
                    "doc_id": batch.column(0), "n_tokens": [sum(map(size, x)) for x in found],
                    "ids_sha256": [hashlib.sha256(" ".join(map(said, x)).encode()).hexdigest() for x in found],
                    "decoded_sha256": [hashlib.sha256(b"".join(map(decoded, x))).hexdigest() for x in found]})

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, ROUND)


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
