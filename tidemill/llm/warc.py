"""WARC archives: records with segments, revisits and chunked bodies, written and read back with Spark."""

from __future__ import annotations

import hashlib
import itertools
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import map_batches
from tidemill.session import stored

# Fixed strings of the WARC 1.1 format.
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_CHUNK = 16_384


def record_id(page_id, digest: str, *more) -> str:
    """The record identifier of a page and payload: the same in every run; ``more`` tells repeated rows and segments apart."""
    name = ":".join(map(str, ("page", page_id, digest, *more)))
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def chunked(payload: bytes, size: int = _CHUNK) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body; chunk extensions and trailers are passed over; a broken frame is an error."""
    parts, at = [], 0
    while True:
        line_end = body.index(b"\r\n", at)
        size = int(body[at:line_end].split(b";")[0].strip(), 16)
        at = line_end + 2
        if size == 0:
            return b"".join(parts)
        piece = body[at:at + size]
        if len(piece) < size or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk shorter than announced")
        parts.append(piece)
        at += size + 2


def _header(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields] + [b"Content-Length: %d" % length]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def _clean(value) -> str:
    """A header value on one line."""
    return " ".join(str(value if value is not None else "").split())


def records_of(page_id, url, payload: bytes, refers_to, segment: int, row: tuple = ()) -> Iterator[bytes]:
    """The records of a page without their final blank lines: a revisit, or a response and its continuations.

    ``row`` names the row where others have the same page id and payload.
    """
    digest = hashlib.sha1(payload).hexdigest()
    own = record_id(page_id, digest, *row, *(["revisit"] if refers_to is not None else []))
    head = [("WARC-Record-ID", own), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url)),
            ("X-Page-ID", str(page_id)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        block = _HTTP.replace(b"Transfer-Encoding: chunked\r\n", b"")
        yield _header([("WARC-Type", "revisit"), *head, ("WARC-Refers-To", record_id(refers_to, digest)),
                       ("X-Refers-To-Page", str(refers_to)), ("WARC-Profile", IDENTICAL),
                       ("Content-Type", "application/http; msgtype=response")], len(block)) + block
        return
    block = _HTTP + chunked(payload)
    if len(block) <= segment:
        yield _header([("WARC-Type", "response"), *head,
                       ("Content-Type", "application/http; msgtype=response")], len(block)) + block
        return
    pieces = range(0, len(block), segment)
    for number, at in enumerate(pieces, 1):
        piece = block[at:at + segment]
        if number == 1:
            fields = [("WARC-Type", "response"), *head, ("Content-Type", "application/http; msgtype=response"),
                      ("WARC-Segment-Number", "1")]
        else:
            fields = [("WARC-Type", "continuation"),
                      ("WARC-Record-ID", record_id(page_id, digest, *row, "segment", number)),
                      ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url)),
                      ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(number))]
        if number == len(pieces):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _header(fields, len(piece)) + piece


def assign_types(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to`` and ``repeated``.

    ``refers_to`` is null for a response, else the page to refer to; ``repeated``
    says that other rows have the same page id and payload.

    Of equal payloads of at least ``least`` bytes the largest page_id responds.
    Payloads are told apart by length, SHA-1 and a second hash.  Groups are
    formed from keys alone and reduce before the shuffle; a third of all pages
    may share a payload.
    """
    body = F.coalesce("html", F.lit(""))
    pages = pages.withColumn("x", F.xxhash64(body))
    key = F.when(F.octet_length(body) >= least,
                 F.struct(F.octet_length(body).alias("n"), F.sha1(body.cast("binary")).alias("s"), "x"))
    keyed = pages.select("page_id", "x", key.alias("k"))
    twice = (keyed.where("k is not null and page_id is not null").groupBy("k")
             .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").select("k", "keeper"))
    refers = keyed.join(twice, "k").where("page_id < keeper").select("page_id", "x", F.col("keeper").alias("refers_to"), F.lit(False).alias("repeated"))
    again = (keyed.groupBy("page_id", "x").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("page_id", "x", F.lit(None).cast("long").alias("refers_to"), F.lit(True).alias("repeated")))
    marks = refers.unionByName(again).groupBy(F.col("page_id").alias("p"), F.col("x").alias("y")).agg(
        F.max("refers_to").alias("refers_to"), F.max("repeated").alias("repeated"))
    return (pages.join(marks, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("x") == F.col("y")), "left")
            .select("page_id", "url", "html", "refers_to", F.coalesce("repeated", F.lit(False)).alias("repeated")))


def write_archives(pages: DataFrame, path: str, least: int = 1000, segment: int = 65_536, per_file: int = 1000,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a folder of archives at ``path``, a record (or its segments) per row.

    A file has at most ``per_file`` records of at most ``segment`` bytes and
    their headers, which bounds what a reader holds.  Files go through Spark's
    writer, so a lost executor's part is written again and never twice; the
    blank lines that end a record are the writer's line end.  Whole files are
    compressed.  A null html is an empty payload; a row with a null id is
    written as a response of its own.  Rows that repeat a page id and payload
    have identifiers of their own, by task and place; then a revisit's
    WARC-Refers-To names their page and payload.
    """
    named = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                         F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batch: pa.RecordBatch, places: Iterator[int]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for i in range(batch.num_rows):
            pid, url, html, refers, repeated = (batch.column(k)[i].as_py() for k in range(5))
            row = (TaskContext.get().partitionId(), next(places)) if repeated else ()
            for record in records_of(pid, url, (html or "").encode("utf-8", "surrogatepass"), refers, segment, row):
                out.append(record)
                held += len(record)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    lines = map_batches(assign_types(named, least), run, "record binary", itertools.count)
    (lines.select(F.col("record").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of an archive, plain or gzip of one or many members."""
    if content[:2] == b"\x1f\x8b":
        parts = []
        while content:
            unzip = zlib.decompressobj(31)
            parts.append(unzip.decompress(content))
            content = unzip.unused_data
        content = b"".join(parts)
    at = 0
    while True:
        while content[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(content):
            return
        if content[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        stop = content.index(b"\r\n\r\n", at)
        fields: dict[str, str] = {}
        last = None
        for line in content[at:stop].split(b"\r\n")[1:]:
            if line[:1] in (b" ", b"\t") and last:  # folded line
                fields[last] += " " + line.decode("utf-8", "replace").strip()
                continue
            name, _, value = line.decode("utf-8", "replace").partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
        size = int(fields["content-length"])
        block = content[stop + 4:stop + 4 + size]
        if len(block) < size:
            raise ValueError("record shorter than its Content-Length")
        yield fields, block
        at = stop + 4 + size


RECORD = ("record_id string, record_type string, origin string, segment int, total long, page_id long, refers_to long, "
          "refers_id string, digest string, url string, block binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in a folder, one file at a time per task."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            rows = []
            held = 0
            for f, block in parse_records(batch.column(0)[i].as_py()):
                number = lambda name: int(f[name]) if f.get(name, "").lstrip("-").isdigit() else None
                rows.append((f.get("warc-record-id"), f.get("warc-type"),
                             f.get("warc-segment-origin-id") or f.get("warc-record-id"),
                             number("warc-segment-number"), number("warc-segment-total-length"), number("x-page-id"),
                             number("x-refers-to-page"), f.get("warc-refers-to"),
                             f.get("warc-payload-digest", "").removeprefix("sha1:") or None, f.get("warc-target-uri"), block))
                held += len(block)
                if held > 8_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return map_batches(files, run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response block, its chunked framing taken off."""
    head, _, body = block.partition(b"\r\n\r\n")
    if any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")[1:]):
        return dechunked(body)
    return body


def reassemble(records: DataFrame) -> DataFrame:
    """Logical records of ``read_records``, segments joined and bodies decoded.

    (record_id, record_type, page_id, refers_to, refers_id, url, payload,
    payload_bytes, payload_digest, damage).  Only segments are shuffled: they
    are grouped by origin identifier and put in order of their numbers, which
    must run from 1 without a gap or a repeat up to the one that names the
    total length, and the lengths must add up to it.  Then chunked framing is
    taken off and the payload compared with the digest in the header.  A record
    that fails keeps its row: ``damage`` says why and its payload is null.
    Revisits have no payload; their digest is the header's.
    """
    names = ("record_type", "page_id", "refers_to", "refers_id", "digest", "url")
    parts = F.struct("segment", "total", "block")
    whole = records.where("segment is null").select("record_id", *names, F.array(parts).alias("parts"))
    split = records.where("segment is not null").groupBy("origin").agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in names],
        F.array_sort(F.collect_list(parts)).alias("parts")).withColumnRenamed("origin", "record_id")

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        payloads, sizes, digests, damage = [], [], [], []
        for kind, stated, pieces in zip(*(batch.column(k).to_pylist() for k in (1, 5, 7))):
            payload, wrong, digest = None, None, stated
            try:
                block = joined(pieces)
                if kind != "revisit":
                    payload = http_payload(block)
                    digest = hashlib.sha1(payload).hexdigest()
                    if stated and stated != digest:
                        raise ValueError("payload digest differs from the header's")
            except ValueError as e:
                payload, wrong = None, str(e)
            payloads.append(payload)
            sizes.append(None if payload is None else len(payload))
            digests.append(digest)
            damage.append(wrong)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in (0, 1, 2, 3, 4, 6)), pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(digests, pa.string()), pa.array(damage, pa.string())],
            ["record_id", "record_type", "page_id", "refers_to", "refers_id", "url", "payload", "payload_bytes",
             "payload_digest", "damage"])

    return map_batches(whole.unionByName(split).select("record_id", *names, "parts"), decode,
                       "record_id string, record_type string, page_id long, refers_to long, refers_id string, url string, "
                       "payload binary, payload_bytes long, payload_digest string, damage string")


def joined(pieces: list[dict]) -> bytes:
    """Block of a record from its ordered segments; an error if they are not all there."""
    if len(pieces) == 1 and pieces[0]["segment"] is None:
        return pieces[0]["block"]
    if [p["segment"] for p in pieces] != list(range(1, len(pieces) + 1)):
        raise ValueError("segment numbers have a gap or repeat")
    block = b"".join(p["block"] for p in pieces)
    if pieces[-1]["total"] != len(block) or any(p["total"] is not None for p in pieces[:-1]):
        raise ValueError("segments do not add up to the total length")
    return block


def page_table(logical: DataFrame) -> DataFrame:
    """A row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit takes its length from the response that it refers to, found by page and digest.
    """
    # Both sides below need these columns: the archives are read for them once.
    own = stored(logical.select("record_type", "page_id", "refers_to", "payload_bytes", "payload_digest"))
    answers = own.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("full_bytes"))
    again = own.where("record_type = 'revisit'").join(answers, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return own.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(again)
