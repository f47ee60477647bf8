"""WARC archives with revisit records.

``write_archives`` writes one WARC/1.1 record per page with Spark's text writer:
a record is its header block, a blank line and the payload, and the writer's
line separator is the CRLF CRLF that ends a record, so a file is the plain
concatenation of its records, compressed with gzip.  The files are committed by
Spark like any table, to any store; a lost executor only repeats its files.  Files
hold up to ``records_per_file`` records, fewer where these are large
(``bytes_per_file`` at the mean size).  ``read_archives`` unpacks all gzip members of
a file (or a plain ``.warc``) a step at a time and follows each record's
Content-Length; nothing in a payload can end a record, and of a file unpacked no
more than one record is held.

Archives of others are read as well: a record may lack any header but the length
(a digest is computed then), ``application/http`` contents count from behind their
HTTP headers, and records that are neither responses nor revisits (``warcinfo``,
``request``, ...) go into the deduplicated archives as they are.  A file that breaks
off inside a record is an error, not a shorter archive.

``resolve_revisits`` shuffles headers, not payloads: per payload digest the
record with the largest page_id is the original, found by partial aggregation
before the shuffle, and every header is joined to it.  ``dedupe_archives`` writes
the archives again with fresh headers, payloads only for originals and for
payloads below ``least_bytes``; a revisit names its original by record id, URI
and date.  ``read_resolved`` reads those and joins each revisit to its original
for the size of the full payload.

Payload: html in UTF-8, null counts as empty.  Digests compare SHA-256 and size;
the SHA-1 is what headers carry.
Defined results: a null page_id is written without that header and read as
null, and is the original only if all its group's ids are null; of records with
equal payload and page_id exactly one is the original; a null url is an empty
target; line breaks in a url are percent-encoded; an empty table gives no
records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, shared_path, staged, text_bytes
from utxoflow.session import pickle_by_value

CRLF = "\r\n"
HTML = "text/html; charset=utf-8"
HEADERS = ("record_id string, page_id bigint, target string, warc_type string, warc_date string, payload_bytes bigint, "
           "payload_digest string, refers_id string, refers_target string, refers_date string, refers_page bigint, "
           "content_type string, content_bytes bigint, content_key string, content binary")
STEP = 1 << 20


def _line(name: str, value: Column) -> Column:
    """One header line, none when the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def records(rows: DataFrame) -> DataFrame:
    """The text of one WARC record per row, without the final CRLF CRLF.
    Columns: record_id, warc_type, warc_date, target, page_id, payload (null
    for copies), payload_sha1, refers_id, refers_target, refers_date,
    refers_page, content_type."""
    revisit = F.col("warc_type") == "revisit"
    body = F.coalesce(F.col("payload"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF), _line("WARC-Type", F.col("warc_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Date", F.col("warc_date")), _line("WARC-Target-URI", F.col("target")),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_sha1"))),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), F.col("refers_id"), F.lit(">"))),
            _line("WARC-Refers-To-Target-URI", F.col("refers_target")), _line("WARC-Refers-To-Date", F.col("refers_date")),
            _line("X-Refers-To-Page-ID", F.col("refers_page").cast("string")))).otherwise(F.lit("")),
        _line("Content-Type", F.col("content_type")), _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF))
    return rows.select(F.concat(head, body).alias("value"))


def file_rows(sizes: DataFrame, size: str, records_per_file: int, bytes_per_file: int) -> int:
    """Records for a file, so that it has about ``bytes_per_file`` at most."""
    n, total = sizes.agg(F.count(F.lit(1)), F.sum(size)).first()
    return max(1, min(records_per_file, bytes_per_file * n // max(1, total or 0)))


def write_records(rows: DataFrame, path: str, records_per_file: int, level: str = "DEFAULT_COMPRESSION") -> None:
    (records(rows).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("zlib.compress.level", level)
     .option("maxRecordsPerFile", records_per_file).text(path))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
                   date: str = "1970-01-01T00:00:00Z", records_per_file: int = 2000, bytes_per_file: int = 1 << 26,
                   level: str = "BEST_SPEED") -> None:
    """One ``response`` record per page (compressed for speed: these archives
    are read once, to be deduplicated)."""
    target = F.replace(F.replace(F.coalesce(F.col(url_col), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    payload = F.coalesce(F.col(html_col), F.lit(""))
    none = F.lit(None).cast("string")
    records_per_file = file_rows(pages.select(F.octet_length(payload).alias("size")), "size", records_per_file, bytes_per_file)
    write_records(pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), target.alias("target"), payload.alias("payload"),
        F.sha1(payload).alias("payload_sha1"), F.uuid().alias("record_id"), F.lit("response").alias("warc_type"),
        F.lit(date).alias("warc_date"), none.alias("refers_id"), none.alias("refers_target"), none.alias("refers_date"),
        F.lit(None).cast("bigint").alias("refers_page"), F.lit(HTML).alias("content_type")), path, records_per_file, level)


def unpacked(data: bytes):
    """The bytes of a plain archive, or of all members of a gzip file one after
    the other, at most ``STEP`` at a time."""
    if data[:2] != b"\x1f\x8b":
        yield from (data[at:at + STEP] for at in range(0, len(data), STEP))
        return
    inflate, view, inside = zlib.decompressobj(wbits=31), memoryview(data), False
    for at in range(0, len(data), STEP):
        piece = bytes(view[at:at + STEP])
        while True:
            out = inflate.decompress(piece, STEP)
            inside = True
            if out:
                yield out
            if inflate.eof:
                piece = inflate.unused_data.lstrip(b"\0")  # the next member, or padding
                inflate, inside = zlib.decompressobj(wbits=31), False
            else:
                piece = inflate.unconsumed_tail
            if not piece and (len(out) < STEP or not inside):
                break
    if inside:
        raise ValueError("archive ends inside a gzip member")


class Bytes:
    """Bytes taken from the front of a stream of pieces."""

    def __init__(self, pieces):
        self.pieces, self.held, self.at = iter(pieces), bytearray(), 0

    def fill(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.fill():
            pass
        if len(self.held) < n:
            raise ValueError(f"archive ends inside a record, at byte {self.at + len(self.held)}")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.at += n
        return out

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before ``mark``, which is taken too; None at the end."""
        seen = 0
        while (end := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.fill():
                if self.held.strip():
                    raise ValueError(f"archive ends inside a record, at byte {self.at + len(self.held)}")
                return None
        return self.take(end + len(mark))[:-len(mark)]


def parse(data: bytes):
    """(headers, content) of every record of an archive's bytes."""
    for _, headers, content in parse_pieces([data]):
        yield headers, content


def parse_pieces(pieces):
    """(place, headers, content) of every record of an archive whose bytes come
    in pieces."""
    stream = Bytes(pieces)
    while True:
        at = stream.at
        block = stream.until(b"\r\n\r\n")
        if block is None:
            return
        first, *lines = block.decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers: dict[str, str] = {}
        for line in lines:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        content = stream.take(int(headers["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end after its content")
        yield at, headers, content


def plain_id(value: str | None) -> str | None:
    """A record id without its angle brackets, and without ``urn:uuid:``."""
    return None if value is None else value.strip("<>").removeprefix("urn:uuid:")


def http_body(content_type: str, content: bytes) -> bytes:
    """What the payload of a record is: the content, or what follows its HTTP headers."""
    return content.partition(b"\r\n\r\n")[2] if content_type.startswith("application/http") else content


def header_row(path: str, at: int, headers: dict[str, str], content: bytes, contents: bool) -> tuple:
    """A record as a row of ``HEADERS``."""
    kind, content_type = headers.get("warc-type", "resource"), headers.get("content-type", "application/octet-stream")
    page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    payload = http_body(content_type, content) if kind == "response" else content
    digest = headers.get("warc-payload-digest", "")
    if not digest.startswith("sha1:") or not (kind == "revisit" or re.fullmatch("[0-9a-f]{40}", digest[5:])):
        digest = "sha1:" + hashlib.sha1(payload).hexdigest()  # none, or in another form
    return (plain_id(headers.get("warc-record-id")) or f"{path}#{at}", None if page is None else int(page), headers.get("warc-target-uri", ""),
            kind, headers.get("warc-date", ""), len(payload) if kind == "response" else None, digest.removeprefix("sha1:"),
            plain_id(headers.get("warc-refers-to")), headers.get("warc-refers-to-target-uri"), headers.get("warc-refers-to-date"),
            None if refers is None else int(refers), content_type, len(content), hashlib.sha256(payload).hexdigest(),
            content if contents else None)


def read_archives(spark: SparkSession, path: str, contents: bool = False) -> DataFrame:
    """One row per record of all archives below ``path``; the content itself
    only on demand."""
    schema = arrow_schema(HEADERS)

    def run(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for at, headers, content in parse_pieces(unpacked(text_bytes(raw))):
                    rows.append(header_row(name, at, headers, content, contents))
                    size += len(content) if contents else 0
                    if len(rows) >= 256 or size >= 16 * STEP:
                        yield batch_of(schema, dict(zip(schema.names, map(list, zip(*rows)))))
                        rows, size = [], 0
                if rows:
                    yield batch_of(schema, dict(zip(schema.names, map(list, zip(*rows)))))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").load(path)
    return files.select("path", "content").mapInArrow(run, HEADERS)


def resolve_revisits(headers: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``headers`` (as read, without contents) with record_type and the
    original's refers_id, refers_target, refers_date and refers_page; null for
    responses.  Records of other types stay as they are."""
    mine = ["record_id", "page_id", "target", "warc_date", "payload_bytes", "payload_digest", "content_key", "content_type", "content_bytes"]
    refers = ["refers_id", "refers_target", "refers_date", "refers_page"]
    small = (F.col("warc_type") != "response") | (F.col("payload_bytes") < least_bytes)
    rows = headers.select(*mine, *refers, "warc_type")
    best = F.max(F.struct("page_id", "record_id", "target", "warc_date"))
    originals = rows.filter(~small).groupBy("content_key", "payload_bytes").agg(best.alias("best"))
    joined = rows.filter(~small).join(originals, ["content_key", "payload_bytes"])
    own = F.col("record_id") == F.col("best.record_id")

    def of(name: str, kind: str = "string") -> Column:
        return F.when(~own, F.col(f"best.{name}")).otherwise(F.lit(None).cast(kind))

    large = joined.select(*mine, F.when(own, "response").otherwise("revisit").alias("record_type"), of("record_id").alias("refers_id"),
                          of("target").alias("refers_target"), of("warc_date").alias("refers_date"),
                          of("page_id", "bigint").alias("refers_page"))
    alone = rows.filter(small).select(*mine, F.col("warc_type").alias("record_type"), *refers)
    return large.unionByName(alone)


def dedupe_archives(spark: SparkSession, source: str, target: str, *, least_bytes: int = 1000, records_per_file: int = 2000,
                    bytes_per_file: int = 1 << 26) -> None:
    """Read the archives below ``source`` and write them below ``target`` with
    fresh headers: originals in full, copies as revisit records."""
    resolved = staged(resolve_revisits(read_archives(spark, source), least_bytes), "revisits")
    fresh = {"record_id": F.col("record_id"), "warc_type": F.col("record_type")}
    names = ("warc_date", "target", "page_id", "refers_id", "refers_target", "refers_date", "refers_page", "content_type")
    bodies = read_archives(spark, source, contents=True).select("record_id", F.col("content").cast("string").alias("payload"))
    copy = (F.col("record_type") == "revisit") & F.col("payload_bytes").isNotNull()  # a response until now
    head = resolved.select(*(c.alias(k) for k, c in fresh.items()), *names, F.col("payload_digest").alias("payload_sha1"), copy.alias("copy"))
    full = bodies.join(head.filter("not copy"), "record_id").drop("copy")
    records_per_file = file_rows(resolved.filter(~copy), "content_bytes", records_per_file, bytes_per_file)
    empty = head.filter("copy").drop("copy").withColumn("payload", F.lit(None).cast("string"))
    write_records(full.unionByName(empty), target, records_per_file)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes (of the full payload, for revisits their
    original's, null when that is in none of the archives), payload_digest, record_type, refers_to of deduplicated archives."""
    rows = read_archives(spark, path).select("record_id", "page_id", "warc_type", "payload_bytes", "payload_digest", "refers_id", "refers_page")
    rows = staged(rows, "records")
    originals = rows.filter("warc_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("payload_bytes").alias("full_bytes"))
    revisits = rows.filter("warc_type = 'revisit'").join(originals, "refers_id", "left")
    plain = ["page_id", "payload_digest", F.col("warc_type").alias("record_type"), F.col("refers_page").alias("refers_to")]
    return (rows.filter("warc_type = 'response'").select("payload_bytes", *plain)
            .unionByName(revisits.select(F.col("full_bytes").alias("payload_bytes"), *plain)))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
                  least_bytes: int = 1000, records_per_file: int = 2000) -> DataFrame:
    """Write ``pages`` as archives, deduplicate these by revisit records and
    read the result back."""
    spark = pages.sparkSession
    raw, deduped = shared_path(spark, "warc"), shared_path(spark, "warc-deduped")
    write_archives(pages, raw, id_col, url_col, html_col, records_per_file=records_per_file)
    dedupe_archives(spark, raw, deduped, least_bytes=least_bytes, records_per_file=records_per_file)
    return read_resolved(spark, deduped)


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
