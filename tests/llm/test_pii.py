from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest

from utxoflow.llm import pii


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.createDataFrame([], "doc_id bigint, text string"))


def plain_luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (2 if place % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def base_model(text):
    """The patterns as they are stated, searched plainly."""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    cards = [(m, re.sub("[^0-9]", "", m[0])) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)]
    found += [("card", m) for m, d in cards if 14 <= len(d) <= 19 and plain_luhn(d)]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted((m.start(), pii.KINDS.index(k), m.end()) for k, m in found)


def noise(rng, n):
    alphabet = "0123456789" * 3 + "+@..--() " * 3 + "ab.Z_%é\n"
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_base_spans_against_plain_patterns():
    rng = random.Random(1)
    texts = [noise(rng, rng.randint(0, 120)) for _ in range(1500)]
    texts += [pii.entity(rng, lambda: "ab.c")[1] + rng.choice(["", " ", ".", "@", "_x@d.e"]) + pii.card_number(rng, True) for _ in range(500)]
    texts += ["a@b.com_x@d.e", "a@b@c.d", "@a.b", "a@b", "x@1.2.3.4", "0000255.1.1.1", "256.1.1.1.1", "1.2.3.4.5.6.7.8", "+1 (017) 555-7713.", "4111 1111-1111 1111"]
    for t in texts:
        assert pii.base_spans(t) == base_model(t), t


def every_segmentation(runs, found):
    """All lists of candidates that do not overlap."""
    def grow(place, taken):
        if place == runs:
            yield list(taken)
            return
        yield from grow(place + 1, taken)
        for i, s in enumerate(found):
            if s.first == place:
                yield from grow(s.last + 1, taken + [i])
    yield from grow(0, [])


def worth(model, runs, found, taken):
    labels, p = [0], 0
    starts = {found[i].first: i for i in taken}
    total = sum(model.score(found[i]) for i in taken)
    while p < runs:
        i = starts.get(p)
        labels.append(0 if i is None else found[i].kind + 1)
        p = p + 1 if i is None else found[i].last + 1
    labels.append(0)
    return total + sum(model.between[a, b] for a, b in zip(labels, labels[1:]))


def small_cases(rng, n):
    words = ["call", "ip", "4111", "11", "017", "555", "7713", "1111", "10", "2", "a", "at", "ab", "com", "DE89", "fe80"]
    seps = [" ", "-", ".", " ", "@", ":", " (", ") ", " +", "::", "[at]", " dot "]
    out = []
    while len(out) < n:
        text = "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(3, 9)))
        runs, found = pii.segments(text, 0, len(text))
        if found and len(found) < 14:
            out.append((text, len(runs), found))
    return out


def random_model(rng, found):
    between = np.array([[rng.gauss(0, 0.7) for _ in range(7)] for _ in range(7)])
    between[0, 0] = 0
    return pii.Model({f: rng.gauss(0, 1) for s in found for f in s.features}, between)


def test_viterbi_against_all_segmentations():
    rng = random.Random(2)
    for text, runs, found in small_cases(rng, 150):
        model = random_model(rng, found)
        picked = [s for island in pii.islands(found) for s in pii.best(model, island)]
        best = max(worth(model, runs, found, t) for t in every_segmentation(runs, found))
        assert abs(worth(model, runs, found, [found.index(s) for s in picked]) - best) < 1e-9, text


def test_likelihood_against_all_segmentations():
    rng = random.Random(3)
    for _, runs, found in small_cases(rng, 40):
        model = random_model(rng, found)
        every = list(every_segmentation(runs, found))
        gold = set(rng.choice(every))
        worths = np.array([worth(model, runs, found, t) for t in every])
        value, grad, pairs = pii.likelihood(model, runs, found, gold)
        assert abs(value - (worth(model, runs, found, sorted(gold)) - np.logaddexp.reduce(worths))) < 1e-9
        name = rng.choice(sorted(grad))
        step = 1e-5
        model.weights[name] += step
        above = pii.likelihood(model, runs, found, gold)[0]
        model.weights[name] -= step
        assert abs((above - value) / step - grad[name]) < 1e-3
        a, b = rng.randrange(7), rng.randrange(7)
        model.between[a, b] += step
        assert abs((pii.likelihood(model, runs, found, gold)[0] - value) / step - pairs[a, b]) < 1e-3


def test_zones_hold_every_candidate():
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice(["word ", "é" * 40 + " ", noise(rng, 12), "john (at) ex (dot) com ", "x" * 90, pii.look_alike(rng), " " * 70]) for _ in range(9))
        whole = {(s.start, s.kind, s.end, tuple(s.features)) for s in pii.segments(text, 0, len(text))[1]}
        parts = [(s.start, s.kind, s.end, tuple(s.features)) for lo, hi in pii.zones(text) for s in pii.segments(text, lo, hi)[1]]
        assert len(parts) == len(set(parts)) and set(parts) == whole


def test_finds_what_patterns_miss(model):
    def kinds(text):
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.all_spans(text, model)[1]]

    assert kinds("write to john (at) example (dot) com today") == [("email", "john (at) example (dot) com")]
    assert kinds("call (017) 555-7713 or 0049 30 1234567") == [("phone", "(017) 555-7713"), ("phone", "0049 30 1234567")]
    assert kinds("ip 10[.]2[.]3[.]4 and fe80::1ff:fe23:4567:890a") == [("ip", "10[.]2[.]3[.]4"), ("ip", "fe80::1ff:fe23:4567:890a")]
    assert kinds("card 4111.1111.1111.1111 not 4111 1111 1111 1112") == [("card", "4111.1111.1111.1111")]
    assert kinds("iban DE89 3704 0044 0532 0130 00, ssn 078-05-1120") == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "078-05-1120")]
    assert kinds("on 2024-05-17 at 12:30:45 for $ 1299.00, 1984-1999, 17.05.2024, isbn 978-3-16-148410-0") == []
    assert kinds("made in 1999 with 100 000 000 parts, version 1.2.3, 12 34 56 78 90 12 34 56") == []


def test_held_out_entities(model):
    rng = random.Random(77)
    rows = list(pii.made_up(rng, ["some other words stand here", "nothing else matters now"], 600))
    found = [(set(spans), set(pii.chosen(t, model))) for t, spans in rows]
    right = sum(len(a & b) for a, b in found)
    assert right >= 0.93 * sum(len(a) for a, _ in found) and right >= 0.93 * sum(len(b) for _, b in found)


def test_edge_documents(spark, docs, no_docs, model):
    got = pii.scan(docs, model).collect()
    want = sorted((str(r["doc_id"]), *base_counts(r["text"] or "")) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_spans"]) for r in got) == want
    assert all(set(filter(None, r["base_spans"].split(","))) <= set(r["spans"].split(",")) for r in got)
    assert pii.scan(no_docs, model).collect() == [] and pii.redact(no_docs, model).collect() == []
    kept = pii.redact(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def base_counts(text):
    spans = base_model(text)
    return (*[sum(k == kind for _, k, _ in spans) for kind in range(4)], pii.named(spans))


def test_redacts(spark, model):
    rows = [(1, "mail a.b@c.de, card 4111 1111 1111 1111 and +1 (017) 555-7713."), (2, None)]
    out = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert out == {1: "mail [email], card [card] and [phone].", 2: None}


def test_long_texts_take_linear_time(model):
    for unit in ("a", "1", "1 ", "1.", "a@", "+1 ", "@", "12-34 ", "+", "1:", "a.", "( "):
        started = time.time()
        pii.all_spans(unit * (60_000 // len(unit)), model)
        assert time.time() - started < 20, unit


def test_fit_takes_labels_from_documents(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["words", "here", pii.look_alike(rng), "mail a@b.com", "stand", pii.card_number(rng, True), "+1 (017) 555-7713"]), "x") for i in range(30)]
    frame = spark.createDataFrame(rows + [(None, None, None), (3, "", None)], "doc_id bigint, text string, h string")
    one, two = pii.fit(frame, max_docs=20, max_windows=30), pii.fit(frame.repartition(5), max_docs=20, max_windows=30)
    assert one.weights == two.weights and (one.between == two.between).all()
