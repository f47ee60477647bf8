"""Secret scan: fixed patterns, and a token-efficiency test for the rest.

Fixed patterns (leftmost, non-overlapping per kind): ``assign`` a key word with
a value of 12 or more characters, ``access`` an access key id of 18 or more,
``hex`` a run of 16 or more lower-case hex digits.

Token efficiency (kind ``random``): a byte-pair vocabulary spends few tokens on
text it has seen and about one per two characters on random strings.  A maximal
run of 16 or more key characters that holds a letter is a secret when a
tiktoken vocabulary gives it fewer than ``ratio`` characters per token.  So that
readable parts do not hide a key, each stretch of unreadable parts between
separators, and each such part, is tested likewise when the run as a whole is no
secret; the span is the stretch's or part's then.  A run with fewer than 16
characters from its first to its last unreadable part (and in numbers outside)
is none, and so is a run of bases (ACGT), a digest in base64 behind its name
(``sha256-...``) and a run of readable parts only: numbers, known digests (hex of a
digest's length), UUIDs, parts of up to three characters, and words with up to
four digits after them; a word has at least ``ratio`` characters per token
itself, or is short with at most two tokens.

Spans are (start, end, kind) in code points, end exclusive, over whole texts.
Defined results: null or empty text has no spans; repeated rows are scanned
alike; an empty table gives no rows; other columns are ignored by ``scan`` and
kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, slices, tiktoken_ranks, worker_cache
from utxoflow.session import pickle_by_value

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z", re.IGNORECASE | re.ASCII)
#: A digest in base64 behind its name, as lock files and integrity attributes have it.
NAMED = re.compile(r"(?<![A-Za-z0-9])sha(1|224|256|384|512)[-_=:]([A-Za-z0-9+/_-]+={0,2})\Z", re.IGNORECASE | re.ASCII)
NAMED_BYTES = {"1": 20, "224": 28, "256": 32, "384": 48, "512": 64}
#: A sequence of bases.
BASES = re.compile(r"(?:[ACGTUN]+|[acgtun]+)\Z")
PART = re.compile(r"(?<![A-Za-z0-9])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![A-Za-z0-9])|[A-Za-z0-9]+", re.IGNORECASE | re.ASCII)
WORD = re.compile(r"([A-Za-z]+)[0-9]{0,4}\Z")
#: The key words of ``assign``, to pass over texts without any.
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LETTER = re.compile(r"[A-Za-z]")

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end: sorts by start, then kind


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def tokenizer(path: str):
    """The tiktoken encoding of a rank file, once per worker."""
    def make():
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tiktoken_ranks(path),
                                 special_tokens={})
    return worker_cache(("tiktoken", path), make)


def is_word(letters: str, encoding, ratio: float) -> bool:
    n = len(encoding.encode_ordinary(letters))
    return n <= 2 and len(letters) < 16 or len(letters) >= ratio * n


def is_named_digest(run: str) -> bool:
    named = NAMED.search(run)
    return named is not None and len(named[2].rstrip("=")) == -(-8 * NAMED_BYTES[named[1]] // 6)


def is_readable(part: str, encoding, ratio: float) -> bool:
    if len(part) <= 3 or part.isdigit() or "-" in part or DIGEST.match(part):  # only a UUID holds a dash
        return True
    word = WORD.match(part)
    return word is not None and is_word(word[1], encoding, ratio)


def stretches(run: str, encoding, ratio: float) -> list[list[tuple[int, int]]]:
    """Neighbouring unreadable parts of ``run``, as (start, end)."""
    found: list[list[tuple[int, int]]] = []
    joined = False
    for part in PART.finditer(run):
        if is_readable(part[0], encoding, ratio):
            joined = False
            continue
        if not joined:
            found.append([])
        found[-1].append(part.span())
        joined = True
    return found


def random_spans(text: str, encoding, ratio: float) -> list[Span]:
    def is_random(run: str) -> bool:
        return len(run) >= 16 and LETTER.search(run) is not None and len(run) < ratio * len(encoding.encode_ordinary(run))

    found: list[Span] = []
    for m in RUN.finditer(text):
        run = m[0].strip("+/_=-")
        if len(run) < 16 or not LETTER.search(run) or BASES.match(run) or is_named_digest(text[max(0, m.start() - 7):m.end()]):
            continue
        groups = stretches(run, encoding, ratio)
        if not groups:
            continue
        start = m.start() + m[0].index(run)
        first, last = groups[0][0][0], groups[-1][-1][1]
        unread = last - first + sum(len(x) for x in PART.findall(run[:first]) + PART.findall(run[last:]) if x.isdigit())
        if unread >= 16 and is_random(run):
            found.append((start, 3, start + len(run)))
            continue
        for parts in groups:
            whole = (parts[0][0], parts[-1][1])
            spans = [whole] if is_random(run[slice(*whole)]) else [p for p in parts if is_random(run[slice(*p)])]
            found += [(start + a, 3, start + b) for a, b in spans]
    return found


def all_spans(text: str, encoding, ratio: float) -> list[Span]:
    return sorted(base_spans(text) + random_spans(text, encoding, ratio))


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """``text`` with every span (overlapping ones merged) replaced by ``mark``."""
    parts, at, end = [], 0, -1
    for start, _, stop in spans:
        if start >= end:
            if end >= 0:
                at = end
            parts += [text[at:start], mark]
            end = stop
        else:
            end = max(end, stop)
    return text if end < 0 else "".join(parts) + text[end:]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


SCAN = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_spans string, spans string"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str | None = None,
         ratio: float = 2.25) -> DataFrame:
    """Per row: counts by kind, and the spans as ``kind:start:end`` joined by
    commas, ordered by start and kind (``base_spans`` without ``random``)."""
    path, schema = vocabulary or default_vocabulary(), arrow_schema(SCAN)

    def run(batches):
        encoding = tokenizer(path)
        for batch in slices(batches):
            rows = [all_spans(t or "", encoding, ratio) for t in batch.column(1).to_pylist()]
            said = [[(k, f"{KINDS[k]}:{s}:{e}") for s, k, e in row] for row in rows]
            counts = [[k for _, k, _ in row] for row in rows]
            yield batch_of(schema, {
                "doc_id": batch.column(0), **{f"n_{name}": [c.count(k) for c in counts] for k, name in enumerate(KINDS)},
                "base_spans": [",".join(x for k, x in row if k < 3) for row in said],
                "spans": [",".join(x for _, x in row) for row in said]})

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, SCAN)


def redact(docs: DataFrame, text_col: str = "text", *, vocabulary: str | None = None, ratio: float = 2.25,
           mark: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets of ``text_col`` replaced; all rows and columns stay."""
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        encoding = tokenizer(path)
        return texts.map(lambda t: t if t is None else redacted(t, all_spans(t, encoding, ratio), mark))

    return docs.withColumn(text_col, clean(F.col(text_col)))


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
