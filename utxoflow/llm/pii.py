"""Personal data by a semi-Markov conditional random field.

Base spans come from fixed patterns (email, ip, card, phone).  The method adds
what they miss - numbers without a country code, masked addresses (``(at)``,
``[.]``), IPv6, other separators, IBANs and social security numbers - by scoring
whole segments.  A text is a sequence of alphanumeric runs.  A candidate segment
spans up to ``MAX_RUNS`` of them and ``MAX_CHARS`` characters and gets, for every
type its runs and gaps allow, features of the whole span: check digits, digit
count, group lengths, separators, prefix, the word of its kind before it, the
characters at its borders.  All other runs are outside, with score 0.  Viterbi
over the segments, with a weight for every pair of neighbouring types, chooses
borders and types together; entities are bounded in length, so it takes time
linear in the text.  Runs that no candidate covers are outside whatever the
weights, so each island of candidates is solved by itself, exactly.

The weights are trained here, by the exact gradient of the conditional
likelihood (forward and backward over all segmentations), from at most
``max_windows`` stretches of at most ``max_docs`` documents (chosen by hashes)
with their base spans as labels, and as many stretches with entities and
look-alikes (dates, versions, prices, numbers that fail their check) that rules
make, put between the words of those stretches.

Result: base spans always, and the chosen segments that overlap none of them.
Spans are (start, kind, end) in code points, end exclusive, over whole texts.

Defined results: null or empty text has no spans; repeated rows are scanned
alike; an empty table gives no rows (the weights are then trained from the rules
alone); other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, slices
from utxoflow.session import pickle_by_value

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
EMAIL, IP, CARD, PHONE, IBAN, SSN = range(6)
MAX_RUNS, MAX_CHARS, MAX_GAP = 10, 64, 3

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end: sorts by start, then kind

# ---- base patterns ----

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits before a match of these are never skipped by a search from the left, so a run is tried once.
BASE_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
BASE_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
BASE_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def is_byte(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping: every ``@`` is tried once, with the local part
    that ends at it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, EMAIL, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[Span]:
    found: list[Span] = emails(text) if "@" in text else []
    if not DIGITS.search(text):
        return found
    found += [(m.start(), IP, m.end()) for m in BASE_IP.finditer(text) if all(map(is_byte, m[0].split(".")))]
    for m in BASE_CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        found += [(m.start(), PHONE, m.end()) for m in BASE_PHONE.finditer(text) if 10 <= len(DIGITS.findall(m[0])) <= 15]
    return sorted(found)


# ---- candidate segments ----

RUN = re.compile(r"[^\W_]+")
#: A candidate holds a digit, an @, or an @ or dot in letters.
SEED = re.compile(r"[0-9@]|[(\[{]\s?(?:at|dot)\s?[)\]}]|\sdot\s")
MASKED_AT = re.compile(r"\s?[(\[{]\s?(?:at|@)\s?[)\]}]\s?|\sat\s|\s?@\s?")
MASKED_DOT = re.compile(r"\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\sdot\s")
PLAIN_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,10}")
NUMBER = re.compile(r"[0-9]+")
HEX_GROUP = re.compile(r"[0-9A-Fa-f]{1,4}")
IBAN_HEAD = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]*")
IBAN_PART = re.compile(r"[A-Z0-9]{1,4}")
PHONE_GAPS = frozenset((" ", "-", ".", "/", " (", ") ", ")", ")-", " - ", "("))
CARD_GAPS = frozenset((" ", "-", ".", "  "))
IP_GAPS = frozenset((".", "[.]", "(.)", " . "))
SPELLED = re.compile(r"@|[(\[{]\s?(?:at|dot)\s?[)\]}]|\sdot\s")
#: Fixed words that announce an entity of a kind.
CUES = {EMAIL: ("mail", "contact", "write to", "reach"), IP: ("ip", "host", "server", "address", "from", "peer"),
        CARD: ("card", "visa", "credit", "cc"), PHONE: ("phone", "tel", "call", "fax", "mobile", "cell", "dial"),
        IBAN: ("iban", "bank", "account", "konto"), SSN: ("ssn", "social", "security")}
NOT_ENTITY = ("version", "isbn", "order", "page", "line", "fig", "chapter", "date", "build", "serial")


@dataclass
class Segment:
    first: int  # runs first..last, last included
    last: int
    kind: int
    start: int
    end: int
    features: list[str] = field(default_factory=list)


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def has_cue(before: str, kind: int) -> bool:
    return any(w in before for w in CUES[kind])


def whole_span(text: str, runs: list[tuple[int, int]], first: int, last: int, kind: int, start: int, end: int) -> list[str]:
    """Names of the features of one segment with one type."""
    span, name = text[start:end], KINDS[kind]
    parts = [text[a:b] for a, b in runs[first:last + 1]]
    gaps = {text[a[1]:b[0]] for a, b in zip(runs[first:last], runs[first + 1:last + 1])}
    digits = "".join(DIGITS.findall(span))
    before, after = text[max(0, start - 24):start].lower(), text[end:end + 2]
    out = [name, f"{name} digits {min(len(digits), 20)}", f"{name} groups {len(parts)}",
           f"{name} gaps {'|'.join(sorted(gaps)) if len(gaps) <= 2 else 'many'}"]
    if has_cue(before, kind):
        out.append(f"{name} cue")
    if any(w in before for w in NOT_ENTITY):
        out.append(f"{name} other cue")
    if before and (before[-1].isalnum() or before[-1] in "-/._=+#$€£,:@"):
        out.append(f"{name} before {before[-1] if not before[-1].isalnum() else 'x'}")
    if after and (after[0] in "-/_=@%€:" or after[0] in ".," and after[1:2].isalnum()):
        out.append(f"{name} after {after[0]}")
    if kind == EMAIL:
        out.append("email plain" if " " not in span and span.count("@") == 1 and PLAIN_EMAIL.fullmatch(span) else "email masked")
        out.append(f"email end {len(parts[-1])}")
    elif kind == IP:
        if ":" in span:
            out.append("ip six" + (" short" if "::" in span else "") + (" whole" if len(parts) == 8 else ""))
            out.append("ip letters" if any(c.isalpha() for c in span) else "ip no letters")
            out.append("ip pairs" if all(len(p) == 2 for p in parts) else "ip no pairs")
        else:
            out.append("ip bytes" if all(map(is_byte, parts)) else "ip no bytes")
    elif kind == CARD:
        out.append("card luhn" if luhn(digits) else "card no luhn")
        out.append("card even" if len({len(p) for p in parts[:-1]}) <= 1 else "card uneven")
        if len(set(digits)) <= 2:
            out.append("card dull")
    elif kind == PHONE:
        shape = "+" if "+" in span[:2] else "00" if digits.startswith("00") else "(" if span[0] == "(" else "none"
        out += [f"phone prefix {shape}", f"phone shape {shape} {'-'.join(str(len(p)) for p in parts[-3:])}",
                f"phone last {len(parts[-1])}", "phone date" if is_date(parts) else "phone no date"]
        if luhn(digits) and len(digits) >= 13:
            out.append("phone luhn")
    elif kind == IBAN:
        out.append("iban check" if mod97("".join(parts)) else "iban no check")
    return out


def is_date(parts: list[str]) -> bool:
    if len(parts) != 3 or not all(len(p) in (1, 2, 4) for p in parts):
        return False
    return len(parts[0]) == 4 and int(parts[1]) <= 12 and int(parts[2]) <= 31 or len(parts[2]) == 4 and int(parts[0]) <= 31 and int(parts[1]) <= 31


def kinds_of(text: str, parts: list[str], gaps: list[str], start: int, end: int) -> Iterator[tuple[int, int]]:
    """Types that the runs and gaps of a segment allow, and where it starts then."""
    n = sum(map(len, parts))
    if all(NUMBER.fullmatch(p) for p in parts):
        if 13 <= n <= 19 and len(parts) <= 5 and all(g in CARD_GAPS for g in gaps) and all(len(p) >= 3 for p in parts[:-1]):
            yield CARD, start
        if 7 <= n <= 15 and len(parts) <= 6 and all(g in PHONE_GAPS for g in gaps):
            head = start
            while head and head > start - 2 and text[head - 1] in "+(":
                head -= 1
            told = has_cue(text[max(0, head - 24):head].lower(), PHONE)
            if told or head < start or (parts[0].startswith("00") and gaps) or any(g.strip() for g in gaps):
                yield PHONE, head
        if len(parts) == 4 and all(g in IP_GAPS for g in gaps) and all(len(p) <= 3 for p in parts):
            yield IP, start
        if [len(p) for p in parts] == [3, 2, 4] and len(set(gaps)) == 1 and gaps[0] in ("-", " "):
            yield SSN, start
    if len(parts) >= 3 and all(g in (":", "::") for g in gaps) and all(HEX_GROUP.fullmatch(p) for p in parts) and (
            len(parts) == 8 or gaps.count("::") == 1):
        yield IP, start
    if 15 <= n <= 34 and IBAN_HEAD.fullmatch(parts[0]) and all(g == " " for g in gaps) and (
            len(parts) == 1 or len(parts[0]) == 4 and all(IBAN_PART.fullmatch(p) for p in parts[1:])):
        yield IBAN, start


def email_like(span: str) -> bool:
    plain = MASKED_DOT.sub(".", MASKED_AT.sub("@", span, count=1))
    return PLAIN_EMAIL.fullmatch(plain) is not None


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold every candidate, borders included."""
    lo = hi = -1
    for m in SEED.finditer(text):
        a, b = max(0, m.start() - MAX_CHARS), min(len(text), m.end() + MAX_CHARS)
        if a > hi:
            if hi >= 0:
                yield lo, hi
            lo = a
        hi = b
    if hi >= 0:
        yield lo, hi


def segments(text: str, lo: int, hi: int) -> tuple[list[tuple[int, int]], list[Segment]]:
    """Runs of a zone and its candidates, by first run, last run and type."""
    runs = [m.span() for m in RUN.finditer(text, lo, hi)]
    if runs and lo and runs[0][0] == lo and RUN.match(text[lo - 1]):  # a run cut by the border of the zone
        runs.pop(0)
    if runs and hi < len(text) and runs[-1][1] == hi and RUN.match(text[hi]):
        runs.pop()
    spelled = [m.start() for m in SPELLED.finditer(text, lo, hi)]
    found: list[Segment] = []
    mark = 0
    for first, (start, _) in enumerate(runs):
        while mark < len(spelled) and spelled[mark] < start:
            mark += 1
        masked = mark < len(spelled) and spelled[mark] - start < MAX_CHARS
        head = text[start:runs[first][1]]
        plain = text[start] in "0123456789" or IBAN_HEAD.fullmatch(head) or HEX_GROUP.fullmatch(head) and text[runs[first][1]:runs[first][1] + 1] == ":"
        if not masked and not plain:
            continue
        parts, gaps = [], []
        for last in range(first, min(first + MAX_RUNS, len(runs))):
            a, b = runs[last]
            if last > first:
                gap = text[runs[last - 1][1]:a]
                if len(gap) > MAX_GAP or "\n" in gap:
                    break
                gaps.append(gap)
            parts.append(text[a:b])
            if b - start > MAX_CHARS:
                break
            allowed = list(kinds_of(text, parts, gaps, start, b)) if plain else []
            if masked and spelled[mark] < b and gaps and email_like(text[start:b]):
                allowed.append((EMAIL, start))
            for kind, at in sorted(allowed):
                found.append(Segment(first, last, kind, at, b, whole_span(text, runs, first, last, kind, at, b)))
    return runs, found


# ---- the model ----

OUTSIDE = 0  # labels: 0 outside, 1 + kind


@dataclass
class Model:
    weights: dict[str, float]
    between: np.ndarray  # label before x label; outside to outside is 0

    def score(self, s: Segment) -> float:
        return sum(self.weights.get(f, 0.0) for f in s.features)


def islands(found: list[Segment]) -> Iterator[list[Segment]]:
    """Candidates (by first run) that overlap or touch, directly or through
    others."""
    held: list[Segment] = []
    end = -1
    for s in found:
        if held and s.first > end + 1:
            yield held
            held = []
        held.append(s)
        end = max(end, s.last)
    if held:
        yield held


def best(model: Model, found: list[Segment]) -> list[Segment]:
    """The segments of the best segmentation of one island."""
    lo, hi = found[0].first, max(s.last for s in found) + 1
    n, t = hi - lo, model.between
    by_end: dict[int, list[Segment]] = {}
    for s in found:
        by_end.setdefault(s.last + 1 - lo, []).append(s)
    none = float("-inf")
    value = [[none] * len(t) for _ in range(n + 1)]
    came: list[list[tuple[int, int, Segment | None] | None]] = [[None] * len(t) for _ in range(n + 1)]
    value[0][OUTSIDE] = 0.0
    for p in range(1, n + 1):
        steps = [(p - 1, OUTSIDE, 0.0, None)] + [(s.first - lo, s.kind + 1, model.score(s), s) for s in by_end.get(p, ())]
        for at, label, own, s in steps:
            for y, v in enumerate(value[at]):
                if v != none and v + t[y][label] + own > value[p][label]:
                    value[p][label] = v + t[y][label] + own
                    came[p][label] = (at, y, s)
    label = max(range(len(t)), key=lambda y: value[n][y] + t[y][OUTSIDE])
    out, p = [], n
    while p:
        p, label, s = came[p][label]
        if s is not None:
            out.append(s)
    return out[::-1]


def chosen(text: str, model: Model) -> list[Span]:
    """Spans of the best segmentation of the whole text."""
    out: list[Span] = []
    for lo, hi in zones(text):
        for island in islands(segments(text, lo, hi)[1]):
            out += [(s.start, s.kind, s.end) for s in best(model, island)]
    return out


def all_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), both in order."""
    base = base_spans(text)
    added, reach, at = [], 0, 0
    for start, kind, end in sorted(chosen(text, model)):
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if start >= reach:
            added.append((start, kind, end))
    return base, sorted(base + added)


# ---- training ----

def likelihood(model: Model, runs: int, found: list[Segment], gold: set[int]) -> tuple[float, dict[str, float], np.ndarray]:
    """Log likelihood of the segmentation with the candidates at the places
    ``gold``, and its gradient by feature and by pair of labels."""
    t = model.between
    k = len(t)
    own = [model.score(s) for s in found]
    by_end: dict[int, list[int]] = {}
    by_start: dict[int, list[int]] = {}
    for i, s in enumerate(found):
        by_end.setdefault(s.last + 1, []).append(i)
        by_start.setdefault(s.first, []).append(i)
    forth, into = np.full((runs + 1, k), -np.inf), np.full((runs + 1, k), -np.inf)
    forth[0, OUTSIDE] = 0.0
    for p in range(runs + 1):
        if p:
            forth[p, OUTSIDE] = into[p - 1, OUTSIDE]
            for i in by_end.get(p, ()):
                y = found[i].kind + 1
                forth[p, y] = np.logaddexp(forth[p, y], into[found[i].first, y] + own[i])
        into[p] = np.logaddexp.reduce(forth[p][:, None] + t, axis=0)
    back, ahead = np.full((runs + 1, k), -np.inf), np.full((runs + 1, k), -np.inf)
    back[runs] = t[:, OUTSIDE]
    for p in range(runs, -1, -1):
        if p < runs:
            ahead[p, OUTSIDE] = back[p + 1, OUTSIDE]
            for i in by_start.get(p, ()):
                y = found[i].kind + 1
                ahead[p, y] = np.logaddexp(ahead[p, y], own[i] + back[found[i].last + 1, y])
            back[p] = np.logaddexp.reduce(t + ahead[p][None, :], axis=1)
    whole = into[runs, OUTSIDE]
    grad: dict[str, float] = {}
    for i, s in enumerate(found):
        y = s.kind + 1
        share = float(np.exp(into[s.first, y] + own[i] + back[s.last + 1, y] - whole))
        for f in s.features:
            grad[f] = grad.get(f, 0.0) + (i in gold) - share
    pairs = np.zeros((k, k))
    for p in range(runs):
        pairs -= np.exp(forth[p][:, None] + t + ahead[p][None, :] - whole)
    pairs[:, OUTSIDE] -= np.exp(forth[runs] + t[:, OUTSIDE] - whole)
    total, label, p = 0.0, OUTSIDE, 0
    ends = {found[i].first: i for i in gold}
    while p < runs:
        i = ends.get(p)
        y = OUTSIDE if i is None else found[i].kind + 1
        pairs[label, y] += 1
        total += t[label, y] + (0.0 if i is None else own[i])
        label, p = y, p + 1 if i is None else found[i].last + 1
    pairs[label, OUTSIDE] += 1
    return float(total + t[label, OUTSIDE] - whole), grad, pairs


Example = tuple[int, list[Segment], set[int]]


def example(text: str, spans: list[Span]) -> Example | None:
    """Runs, candidates and the places of the labelled ones; None for a text
    without candidates."""
    runs, found = segments(text, 0, len(text))
    if not found:
        return None
    want, taken, gold = set(spans), -1, set()
    for i, s in enumerate(found):
        if (s.start, s.kind, s.end) in want and s.first > taken:
            gold.add(i)
            taken = s.last
    return len(runs), found, gold


def fit_model(examples: list[Example], epochs: int = 12, rate: float = 0.4, shrink: float = 1e-3, seed: int = 11) -> Model:
    """Adaptive gradient ascent, one example at a time."""
    model = Model({}, np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    seen: dict[str, float] = {}
    seen_pairs = np.full_like(model.between, 1e-2)
    order = list(range(len(examples)))
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            _, grad, pairs = likelihood(model, *examples[i])
            for f, g in grad.items():
                g -= shrink * model.weights.get(f, 0.0)
                seen[f] = seen.get(f, 1e-2) + g * g
                model.weights[f] = model.weights.get(f, 0.0) + rate * g / seen[f] ** 0.5
            pairs -= shrink * model.between
            pairs[OUTSIDE, OUTSIDE] = 0.0  # the reference: islands stay independent
            seen_pairs += pairs * pairs
            model.between += rate * pairs / np.sqrt(seen_pairs)
    return model


def digits_of(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def cut(text: str, sizes: tuple[int, ...], gap: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(text[at:at + n])
        at += n
    return gap.join([*out, text[at:]] if at < len(text) else out)


def card_number(rng: random.Random, valid: bool) -> str:
    head = rng.choice("23456") + digits_of(rng, rng.choice((14, 14, 14, 13, 12, 17)))
    last = next(d for d in "0123456789" if luhn(head + d))
    return head + (last if valid else str((int(last) + rng.randrange(1, 10)) % 10))


def iban_number(rng: random.Random, valid: bool) -> str:
    country, own = rng.choice(("DE", "FR", "ES", "GB", "NL")), digits_of(rng, rng.choice((14, 18, 20)))
    check = 98 - int("".join(str(int(c, 36)) for c in own + country + "00")) % 97
    return f"{country}{(check if valid else (check + rng.randrange(1, 96)) % 97):02d}{own}"


def entity(rng: random.Random, word: Callable[[], str]) -> tuple[int, str]:
    """A made-up entity, as the base patterns know it or not."""
    kind = rng.choice((EMAIL, EMAIL, IP, CARD, PHONE, PHONE, PHONE, IBAN, SSN))
    if kind == EMAIL:
        at = rng.choice(("@", "@", " (at) ", "[at]", " [at] ", " at ", " @ ", "(at)"))
        dot = "." if at in ("@", " @ ") else rng.choice((" (dot) ", "[dot]", " dot ", "."))
        dot = " dot " if at == " at " else dot
        local = word() + rng.choice(("", str(rng.randrange(100)), "." + word(), "_" + word()))
        return kind, local + at + word() + rng.choice(("", dot + word())) + dot + rng.choice(("com", "org", "net", "de", "fr", "io", "info"))
    if kind == IP:
        if rng.random() < 0.3:
            groups = [f"{rng.randrange(65536):x}" for _ in range(8)]
            at = rng.randrange(2, 5)
            return kind, ":".join(groups) if rng.random() < 0.5 else ":".join(groups[:at]) + "::" + ":".join(groups[at + 2:])
        return kind, rng.choice((".", ".", "[.]", "(.)")).join(str(rng.randrange(256)) for _ in range(4))
    if kind == CARD:
        number = card_number(rng, True)
        return kind, rng.choice((number, cut(number, (4, 4, 4), rng.choice((" ", "-", ".")))))
    if kind == IBAN:
        number = iban_number(rng, True)
        return kind, rng.choice((number, cut(number, (4,) * 4, " ") if len(number) <= 20 else cut(number, (4,) * 5, " ")))
    if kind == SSN:
        return kind, cut(digits_of(rng, 9), (3, 2), "-")
    area, near, last = digits_of(rng, 3), digits_of(rng, 3), digits_of(rng, 4)
    return kind, rng.choice((f"+{rng.randrange(1, 99)} ({area}) {near}-{last}", f"+{rng.randrange(1, 99)} {area} {near} {last}",
                             f"({area}) {near}-{last}", f"{area}-{near}-{last}", f"{area}.{near}.{last}", f"00{rng.randrange(30, 50)} {area} {near}{last}",
                             f"({area}) {near} {last}"))


def look_alike(rng: random.Random) -> str:
    """Something of digits that is no personal data."""
    n = rng.randrange
    hour = f"{n(24):02d}:{n(60):02d}:{n(60):02d}"
    return rng.choice((
        lambda: f"{1900 + n(130)}-{1 + n(12):02d}-{1 + n(28):02d}", lambda: f"{1 + n(28):02d}.{1 + n(12):02d}.{1900 + n(130)}",
        lambda: f"{1 + n(12)}/{1 + n(28)}/{1900 + n(130)}", lambda: hour, lambda: f"{1900 + n(130)}-{1 + n(12):02d}-{1 + n(28):02d} {hour}",
        lambda: f"version {n(20)}.{n(20)}.{n(300)}", lambda: f"version {n(20)}.{n(20)}.{n(300)}.{n(900)}", lambda: f"{n(999)},{n(1000):03d}.{n(100):02d}",
        lambda: f"$ {n(99999)}.{n(100):02d}", lambda: str(1900 + n(130)), lambda: f"{1800 + n(200)}-{1800 + n(200)}", lambda: card_number(rng, False),
        lambda: cut(card_number(rng, False), (4, 4, 4), rng.choice((" ", "-"))), lambda: digits_of(rng, 5 + n(30)), lambda: "isbn " + cut("978" + digits_of(rng, 10), (3, 1, 2, 6), "-"),
        lambda: iban_number(rng, False), lambda: ":".join(f"{n(256):02x}" for _ in range(6)), lambda: " ".join(str(n(100)) for _ in range(8)),
        lambda: f"{n(90)}.{n(10000):04d} {n(180)}.{n(10000):04d}", lambda: f"{digits_of(rng, 5)}-{digits_of(rng, 4)}", lambda: f"order {digits_of(rng, 4)}-{digits_of(rng, 6)}-{digits_of(rng, 2)}",
        lambda: ".".join(str(n(900)) for _ in range(4)) + "9", lambda: f"{n(100)}.{n(1000):03d}.{n(1000):03d}", lambda: f"{n(1000)}-{n(1000)}-{n(100)}"))()


def windows(text: str, reach: int = 48) -> Iterator[tuple[str, list[Span]]]:
    """Stretches of a text around its digits and signs, cut at blanks, with the
    base spans of the whole text that lie in them."""
    base = base_spans(text)
    done = 0
    for m in SEED.finditer(text):
        if m.start() < done:
            continue
        a, b = max(done, m.start() - reach), min(len(text), m.end() + 2 * reach)
        while a and a > done and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b < m.end() + 4 * reach and not text[b].isspace():
            b += 1
        yield text[a:b], [(s - a, k, e - a) for s, k, e in base if a <= s and e <= b]
        done = b


WORDS = ("the", "of", "and", "some", "user", "note", "field", "green", "river", "stone", "night", "paper")


def made_up(rng: random.Random, stretches: list[str], n: int) -> Iterator[tuple[str, list[Span]]]:
    """Stretches of words with an entity, or with something like one."""
    vocabulary = [w for s in stretches for w in re.findall(r"[a-z]{3,9}", s)] or list(WORDS)

    def word() -> str:
        return rng.choice(vocabulary)

    for _ in range(n):
        before, after = (" ".join(word() for _ in range(rng.randint(1, 5))) for _ in range(2))
        if rng.random() < 0.55:
            kind, said = entity(rng, word)
            cue = rng.choice(CUES[kind]) + rng.choice((": ", " ")) if rng.random() < 0.4 else ""
            head = before + " " + cue
            yield head + said + rng.choice((" ", ", ", ". ")) + after, [(len(head), kind, len(head) + len(said))]
        else:
            yield before + " " + look_alike(rng) + rng.choice((" ", ", ", ". ")) + after, []


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_docs: int = 400, max_windows: int = 600,
        seed: int = 11) -> Model:
    """The model trained on a bounded sample of ``docs`` and on rules."""
    place = F.xxhash64(F.col(id_col).cast("string"))
    ids = [r[0] for r in docs.select(F.col(id_col), place.alias("h")).filter(F.col(id_col).isNotNull()).distinct().orderBy("h").limit(max_docs).collect()]
    taken: list[tuple[str, list[Span]]] = []
    if ids:
        schema = arrow_schema("stretch string, spans array<bigint>")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                rows = [w for t in batch.column(0).to_pylist() for w in windows(t or "")]
                yield batch_of(schema, {"stretch": [w for w, _ in rows], "spans": [[x for s in spans for x in s] for _, spans in rows]})

        rows = docs.filter(F.col(id_col).isin(ids)).select(F.col(text_col).cast("string")).mapInArrow(run, "stretch string, spans array<bigint>")
        picked = rows.distinct().orderBy(F.xxhash64("stretch"), "stretch").limit(max_windows).collect()
        taken = [(r["stretch"], list(zip(*[iter(r["spans"])] * 3))) for r in picked]
    rng = random.Random(seed)
    made = list(made_up(rng, [s for s, _ in taken], max(max_windows, 1200)))
    return fit_model([x for x in (example(*e) for e in taken + made) if x], seed=seed)


# ---- over tables ----

def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCAN = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string"


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: base counts by kind, and the base and all spans as
    ``kind:start:end`` joined by commas, ordered by start and kind."""
    schema = arrow_schema(SCAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [all_spans(t or "", model) for t in batch.column(1).to_pylist()]
            yield batch_of(schema, {
                "doc_id": batch.column(0),
                **{f"n_{name}": [sum(s[1] == k for s in base) for base, _ in rows] for k, name in enumerate(KINDS[:4])},
                "base_spans": [named(base) for base, _ in rows], "spans": [named(spans) for _, spans in rows]})

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(run, SCAN)


def redact(docs: DataFrame, model: Model, text_col: str = "text", *, mark: str = "[{}]") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind; all rows
    and columns stay."""
    def cleaned(text: str) -> str:
        parts, at = [], 0
        for start, kind, end in all_spans(text, model)[1]:
            if start >= at:
                parts += [text[at:start], mark.format(KINDS[kind])]
            at = max(at, end)
        return "".join(parts) + text[at:]

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else cleaned(t))

    return docs.withColumn(text_col, clean(F.col(text_col)))


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
