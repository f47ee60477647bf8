from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from utxoflow.llm import packing, warc
from utxoflow.llm.common import shared_path

PAGES = "page_id bigint, url string, html string, record_id string, best int"


def warc_model(rows):
    groups = {}
    for i, (page, _, html, *_) in enumerate(rows):
        groups.setdefault(html or "", []).append((page is not None, page or 0, i))
    out = []
    for html, members in groups.items():
        raw = html.encode()
        first = max(members)
        for has, page, i in members:
            again = len(raw) >= 1000 and i != first[2] and (has, page) != first[:2]
            same = len(raw) >= 1000 and i != first[2] and (has, page) == first[:2]
            revisit = again or same
            out.append((page if has else None, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                        (first[1] if first[0] else None) if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    big, tricky = "é" * 600, "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, None), (4, "u\r\nX-Page-ID: 9", ""), (5, "h", tricky), (6, "h", tricky),
            (7, "s", "short"), (8, "s", "short"), (None, "n", big), (9, "l", "y" * 300_000), (10, "e", "z" * 999), (11, "e", "z" * 999),
            (12, "e", "q" * 1000), (12, "e", "q" * 1000), (13, "e", "q" * 1000), (14, "d", "w" * 2000), (14, "d", "w" * 2000)]
    rows = [(*r, "x", 1) for r in rows]
    got = warc.archive_pages(spark.createDataFrame(rows, PAGES).repartition(3), records_per_file=2).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in names) for r in got), key=str) == warc_model(rows)


def test_warc_files_hold_payloads_once(spark):
    rows = [(i, f"http://h/{i}", "p" * 5000 if i % 3 else f"own {i} " * 300, None, None) for i in range(30)]
    raw, out = shared_path(spark, "t"), shared_path(spark, "t")
    warc.write_archives(spark.createDataFrame(rows, PAGES), raw)
    warc.dedupe_archives(spark, raw, out)
    records = warc.read_archives(spark, out, contents=True).collect()
    full = {r["record_id"]: r for r in records if r["warc_type"] == "response"}
    assert len(records) == 30 and len(full) == 11
    for r in records:
        if r["warc_type"] == "revisit":
            assert r["content_bytes"] == 0 and full[r["refers_id"]]["payload_digest"] == r["payload_digest"]
        else:
            assert hashlib.sha1(r["content"]).hexdigest() == r["payload_digest"] and bytes(r["content"]).decode() == rows[r["page_id"]][2]


def test_warc_empty(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_parse_rejects_broken_archives():
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nabc"))


def best_fit_model(lengths, opening):
    """Best fit by a plain search; ``opening`` gives the size of a new bin."""
    rooms, bins = [], []
    for i, size in enumerate(lengths):
        fits = [(room, -k) for k, room in enumerate(rooms) if room >= size]
        if fits:
            room = min(fits)[0]
            k = max(k for k, r in enumerate(rooms) if r == room)
        else:
            k = len(rooms)
            rooms.append(opening(size))
            bins.append([])
        rooms[k] -= size
        bins[k].append(i)
    return rooms, bins


def test_pack_against_plain_search():
    rng = random.Random(4)
    sizes, costs = [8, 16, 32], [9.0, 17.0, 33.0]
    for _ in range(200):
        lengths = sorted((rng.randint(1, 32) for _ in range(rng.randint(1, 40))), reverse=True)
        for opening in sizes:
            def opened(size, o=opening):
                return next(c for c in sizes if c >= max(size, o))

            rooms, want = best_fit_model(lengths, opened)
            got = packing.pack_once(lengths, sizes, costs, opening)  # bins with equal room may swap contents
            assert len(got) == len(want) and sorted(opened(lengths[b[0]]) - sum(lengths[i] for i in b) for b in got) == sorted(rooms)
        best = packing.pack(lengths, sizes, costs)
        assert sorted(i for _, b in best for i in b) == list(range(len(lengths)))
        for capacity, b in best:
            used = sum(lengths[i] for i in b)
            assert used <= capacity and (capacity == 8 or used > sizes[sizes.index(capacity) - 1])
        cost = sum(costs[sizes.index(c)] for c, _ in best)
        for opening in (None, *sizes):
            bins = packing.pack_once(lengths, sizes, costs, opening)
            assert cost <= sum(costs[next(k for k, c in enumerate(sizes) if c >= sum(lengths[i] for i in b))] for b in bins)


@pytest.mark.parametrize("options", [{}, {"capacities": (16, 64), "shard_rows": 4}, {"length_col": "n_chars", "capacities": (4,)}])
def test_packing_is_whole(docs, options):
    got = packing.pack_documents(docs, **options).collect()
    largest = max(options.get("capacities", packing.CAPACITIES))
    want = {}
    for r in docs.collect():
        n = max(0, r["n_chars"] or 0) if "length_col" in options else len((r["text"] or "").encode().split())
        want.setdefault(r["doc_id"], []).append(n)
    have, bins = {}, {}
    for r in got:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + r["n_tokens"]
        assert r["n_tokens"] <= largest and r["piece_start"] == r["piece"] * largest
        assert (r["bin_id"] is None) == (r["n_tokens"] == 0)
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append(r)
    assert have == {k: sum(v) for k, v in want.items()}
    for rows in bins.values():
        rows.sort(key=lambda r: r["bin_offset"])
        assert len({(r["bin_capacity"], r["bin_used"]) for r in rows}) == 1
        assert [r["bin_offset"] for r in rows] == [sum(r["n_tokens"] for r in rows[:k]) for k in range(len(rows))]
        assert sum(r["n_tokens"] for r in rows) == rows[0]["bin_used"] <= rows[0]["bin_capacity"]


def test_bins_do_not_depend_on_the_layout(spark):
    rng = random.Random(5)
    rows = [(i % 400, "w " * rng.randint(1, 900)) for i in range(900)] + [(None, "n " * 50)] * 60 + [(None, "m " * 50)] * 40
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [sorted(map(str, packing.pack_documents(f, shard_rows=128).collect())) for f in (frame.coalesce(1), frame.repartition(5).orderBy(F.rand(3)))]
    assert got[0] == got[1] and len(got[0]) == len(rows)
    numbered = packing.numbered_copies(spark.createDataFrame([("a",)] * 9000 + [("b",)], "x string")).collect()
    assert sorted(r["copy"] for r in numbered if r["x"] == "a") == list(range(9000))


def plain_joint(lengths, capacities, costs):
    """Joint opening as stated, by search over all bins: best fit, else the length
    whose cost per token that can be hoped for is least."""
    bins = []
    for at, size in enumerate(lengths):
        fit = [b for b in bins if b[0] >= size]
        if fit:  # of equal rooms the one that was filled last
            best = min(fit, key=lambda b: (b[0], -b[2]))
            best[0], best[2] = best[0] - size, at
            best[1].append(at)
            continue

        def rate(i):
            spare = capacities[i] - size
            rest = [x for x in lengths[at + 1:] if x <= spare]
            return costs[i] / (size + min(spare, sum(rest)))
        pick = min((i for i, c in enumerate(capacities) if c >= size), key=lambda i: (rate(i), i))
        bins.append([capacities[pick] - size, [at], at])
    return [b for _, b, _ in bins]


def test_joint_opening_against_a_search():
    rng = random.Random(8)
    for _ in range(150):
        capacities = sorted(rng.sample(range(5, 60), rng.randint(1, 4)))
        costs = [c + rng.randint(0, 9) for c in capacities]
        lengths = sorted((rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 40))), reverse=True)
        got = packing.pack_once(lengths, capacities, costs, None)
        want = plain_joint(lengths, capacities, costs)
        assert sorted(sorted(lengths[i] for i in b) for b in got) == sorted(sorted(lengths[i] for i in b) for b in want)


def test_packing_empty(no_docs):
    assert packing.pack_documents(no_docs).collect() == []


# ---- archives of others ----

def record(kind, content, **headers):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k.replace('_', '-')}: {v}" for k, v in headers.items()), f"Content-Length: {len(content)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def foreign():
    """Five records as other tools write them: a warcinfo without URI or digest,
    a request, two responses with HTTP headers, one without a digest."""
    page = b"\xff\x00raw " * 400
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    ids = [f"<urn:uuid:0000000{i}-0000-4000-8000-000000000000>" for i in range(5)]
    return page, [
        record("warcinfo", b"software: x\r\n", WARC_Record_ID=ids[0], WARC_Date="2024-01-01T00:00:00Z", Content_Type="application/warc-fields"),
        record("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Record_ID=ids[1], WARC_Target_URI="http://a/", Content_Type="application/http; msgtype=request"),
        record("response", http + page, WARC_Record_ID=ids[2], WARC_Target_URI="http://a/", Content_Type="application/http; msgtype=response"),
        record("response", http + b"\r\n" + b"tail", WARC_Record_ID=ids[3], WARC_Target_URI="http://b/", Content_Type="application/http; msgtype=response"),
        record("response", http.replace(b"html", b"plain") + page, WARC_Record_ID=ids[4], WARC_Target_URI="http://c/", WARC_Payload_Digest="sha1:ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
               Content_Type="application/http; msgtype=response")]


def write_archive(spark, name, data):
    from pathlib import Path

    folder = shared_path(spark, "foreign")
    local = Path(folder.removeprefix("file:"))
    local.mkdir(parents=True)
    (local / name).write_bytes(data)
    return folder


@pytest.mark.parametrize("packed", ["members", "one", "plain"])
def test_archives_of_others_keep_every_record(spark, packed):
    import gzip

    page, records = foreign()
    data = {"members": b"".join(map(gzip.compress, records)), "one": gzip.compress(b"".join(records)), "plain": b"".join(records)}[packed]
    source, target = write_archive(spark, "a.warc" + ("" if packed == "plain" else ".gz"), data), shared_path(spark, "t")
    rows = {r["record_id"][7]: r for r in warc.read_archives(spark, source, contents=True).collect()}
    assert {k: r["warc_type"] for k, r in rows.items()} == {"0": "warcinfo", "1": "request", "2": "response", "3": "response", "4": "response"}
    assert rows["2"]["payload_digest"] == rows["4"]["payload_digest"] == hashlib.sha1(page).hexdigest()
    assert (rows["3"]["payload_bytes"], rows["0"]["payload_bytes"]) == (6, None)
    warc.dedupe_archives(spark, source, target)
    out = {r["record_id"][7]: r for r in warc.read_archives(spark, target, contents=True).collect()}
    assert {k: r["warc_type"] for k, r in out.items()} == {"0": "warcinfo", "1": "request", "2": "revisit", "3": "response", "4": "response"}
    assert out["2"]["refers_id"] == rows["4"]["record_id"] and bytes(out["2"]["content"]) == b""
    assert all(bytes(out[k]["content"]) == bytes(rows[k]["content"]) and out[k]["content_type"] == rows[k]["content_type"] for k in "0134")
    again = shared_path(spark, "t")  # archives that hold revisits already
    warc.dedupe_archives(spark, target, again)
    kept = {r["record_id"][7]: (r["warc_type"], r["refers_id"]) for r in warc.read_archives(spark, again).collect()}
    assert kept == {k: (r["warc_type"], r["refers_id"]) for k, r in out.items()}
    assert {(r["record_type"], r["payload_bytes"]) for r in warc.read_resolved(spark, again).collect()} == {("revisit", len(page)), ("response", len(page)), ("response", 6)}


def test_broken_archives_are_errors(spark):
    import gzip

    _, records = foreign()
    whole = b"".join(map(gzip.compress, records))
    for data in (whole[:-30], gzip.compress(b"".join(records)[:-60]), gzip.compress(b"no archive\r\n\r\n")):
        with pytest.raises(Exception):
            warc.read_archives(spark, write_archive(spark, "a.warc.gz", data)).collect()


def test_unpacking_in_steps():
    import gzip

    rng = random.Random(2)
    parts = [bytes(rng.randrange(256) for _ in range(1000)) * rng.choice([1, 3000]) for _ in range(4)] + [b""]
    data = b"".join(map(gzip.compress, parts))
    got = list(warc.unpacked(data + b"\0" * 20))
    assert b"".join(got) == b"".join(parts) and max(map(len, got)) <= warc.STEP


def test_large_pages_make_small_files(spark):
    rows = [(i, f"u{i}", chr(97 + i) * 1_000_000, None, None) for i in range(20)]
    raw = shared_path(spark, "t")
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), raw, bytes_per_file=4_000_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw).count()
    assert files == 5 and warc.read_archives(spark, raw).count() == 20
