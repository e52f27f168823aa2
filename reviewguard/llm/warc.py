"""WARC archives: pages are written as response, revisit and continuation records, and read back by segment reassembly.

Spark's text writer makes the archive files (a record a line, the blank lines between records as line end) and its
binary reader fetches them, so they can lie in any store. The number of records a file bounds a file, and the
segment length bounds a record; a longer block goes on in continuation records."""

from __future__ import annotations

import gzip
import hashlib
import io
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SALTS, saved, shared_path, small_batches

#: Bytes of a record's block, bytes of a chunk of the transfer framing, records of a file.
SEGMENT, CHUNK, PER_FILE = 64 << 10, 8 << 10, 2000
#: Shorter payloads are never revisits.
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD = ("record string, type string, origin string, number int, total long, page_id long, url string, digest string, refers string, "
          "block binary, problem string")
PAGE = "record string, record_type string, page_id long, url string, refers string, payload_bytes long, payload_digest string, payload binary, problem string"


# ---- writing ----
def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n".encode() for k, v in fields if v is not None]
    tail = f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    return b"".join([VERSION, *lines, tail, block])


def framed(payload: bytes, chunk: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    out = []
    for i in range(0, len(payload), chunk):
        part = payload[i:i + chunk]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def page_records(record: str, page_id, url, payload: bytes, digest: str, refers: str | None, segment: int, chunk: int):
    """The records of one page: a revisit, or a response with its continuations."""
    name = url if url is not None else f"urn:page:{page_id}"
    fields = [("WARC-Record-ID", f"<{record}>"), ("WARC-Date", DATE), ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", name)),
              ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers is not None:
        yield _record([("WARC-Type", "revisit"), *fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers}>")], HEAD)
        return
    block = HEAD + framed(payload, chunk)
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), *fields], block)
        return
    for number, at in enumerate(range(0, len(block), segment), 1):
        part, last = block[at:at + segment], at + segment >= len(block)
        if number == 1:
            yield _record([("WARC-Type", "response"), *fields, ("WARC-Segment-Number", 1)], part)
        else:
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record}:{number}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", f"<{record}>"),
                           ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if last else None)], part)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   segment: int = SEGMENT, chunk: int = CHUNK, per_file: int = PER_FILE) -> None:
    """Write one response or revisit per page (and continuations of long ones) as gzipped archives under ``path``.

    Of equal payloads of at least LEAST bytes the rows with the smallest page_id are responses (several, where that
    id repeats), the others revisits of it; null ids come after all others. A null html is an empty payload.
    Control characters in a url are percent-encoded, a null one becomes urn:page:<id>. Rows that repeat in id, url and
    payload give equal records, as many. Other columns aren't written. An empty table gives no record."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    record = F.regexp_replace(F.md5(F.to_json(F.struct("page_id", "url", "digest"))), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "urn:uuid:$1-$2-$3-$4-$5")
    rows = rows.withColumn("record", record)
    firsts = rows.where(F.octet_length("body") >= LEAST).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record")).alias("first"), F.count("*").alias("c")).where("c > 1")
    # rows of one payload may be a third of all: they are dealt to SALTS tasks, its one fact goes to each
    facts = firsts.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.record").alias("first_record"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).join(facts, ["digest", "salt"], "left")
    again = F.col("first_record").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.select("record", "page_id", "url", F.when(~again, F.col("body")).alias("body"), "digest", F.when(again, F.col("first_record")).alias("refers"))

    def run(batches):
        for b in batches:
            out, held = [], 0
            for i in range(b.num_rows):
                one = [c[i].as_py() for c in b.columns]
                for r in page_records(one[0], one[1], one[2], one[3] or b"", one[4], one[5], segment, chunk):
                    out.append(r)
                    held += len(r)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


# ---- reading ----
def parse_archive(content: bytes):
    """The records of one archive, gzipped (one member or one per record) or not, as (fields, block, problem).

    Reading stops at the first place that is no record, with a last row that says so."""
    raw = io.BytesIO(content)
    f = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    while True:
        try:
            line = f.readline()
            while line == b"\r\n":
                line = f.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                yield {}, b"", "no record where one should begin"
                return
            fields = {}
            while (line := f.readline()) not in (b"\r\n", b""):
                k, _, v = line.decode("utf-8", "replace").partition(":")
                fields[k.strip().lower()] = v.strip()
            size = int(fields.get("content-length", ""))
            block = f.read(size)
        except (EOFError, ValueError, OSError) as e:
            yield {}, b"", f"broken archive: {type(e).__name__}"
            return
        problem = None
        if len(block) < size:
            problem = "truncated record"
        elif (want := fields.get("warc-block-digest", "")).startswith("sha256:") and want[7:] != hashlib.sha256(block).hexdigest():
            problem = "block digest differs"
        yield fields, block, problem


def read_records(spark: SparkSession, path: str, files: str = "part-*") -> DataFrame:
    """The records of all archives under ``path`` (columns as in RECORD); damaged places come back as rows with a problem."""
    def bare(v):
        return v.strip("<>") if v else None

    def number(v):
        return int(v) if v and re.fullmatch(r"-?\d{1,18}", v) else None

    def run(batches):
        kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
        names = [x.split()[0] for x in RECORD.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            for content in b.column(0):
                rows, held = [], 0
                for f, block, problem in parse_archive(content.as_py()):
                    record, digest = bare(f.get("warc-record-id")), f.get("warc-payload-digest", "")
                    at = number(f.get("warc-segment-number"))
                    rows.append((record, f.get("warc-type"), bare(f.get("warc-segment-origin-id")) or (record if at is not None else None), at, number(f.get("warc-segment-total-length")),
                                 number(f.get("warc-page-id")), f.get("warc-target-uri"), digest[7:] if digest.startswith("sha256:") else None, bare(f.get("warc-refers-to")), block, problem))
                    held += len(block)
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)
    return spark.read.format("binaryFile").option("pathGlobFilter", files).load(path).select("content").mapInArrow(run, RECORD)


def unframed(body: bytes) -> bytes:
    """The payload out of chunked transfer framing; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if size < 0 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk")
        out.append(body[at:at + size])
        at += size + 2


def join_segments(parts: list[dict]) -> tuple[bytes, str | None, int]:
    """(block, problem, copies) of one record's segments: dicts number, copies, total, block, problem.

    Segments are put in order of their number; equal copies count as one, and as so many records if every segment has
    them. Numbers must run from 1 without a gap to the one that states the total length, which must be the sum."""
    parts = sorted(parts, key=lambda p: p["number"])
    block, copies = b"".join(p["block"] for p in parts), min(p["copies"] for p in parts)
    problem = next((p["problem"] for p in parts if p["problem"]), None)
    if problem is None:
        numbers = [p["number"] for p in parts]
        if len(set(numbers)) < len(numbers):
            problem = "segments of one number differ"
        elif numbers != list(range(1, len(numbers) + 1)) or parts[-1]["total"] is None:
            problem = "segment missing"
        elif parts[-1]["total"] != len(block):
            problem = "total length differs"
        elif copies != max(p["copies"] for p in parts):
            problem = "segment missing"
    return block, problem, copies


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: those without a segment number as they are, segments joined by origin identifier.

    Equal copies of a segment are counted before the shuffle, so that a record written many times doesn't gather in one
    task. Continuations without a first segment come back with a problem."""
    meta = ["type", "page_id", "url", "digest", "refers"]
    segments = records.where(F.col("number").isNotNull())
    once = segments.groupBy("origin", "number", "total", F.sha2("block", 256).alias("same")).agg(
        F.count("*").cast("int").alias("copies"), F.first("block").alias("block"), F.max("problem").alias("problem"),
        F.max(F.when(F.col("type") != "continuation", F.struct(*meta))).alias("meta"))
    groups = once.groupBy("origin").agg(F.max("meta").alias("meta"), F.collect_list(F.struct("number", "copies", "total", "block", "problem")).alias("parts"))
    groups = groups.select("origin", *[F.col(f"meta.{c}").alias(c) for c in meta], "parts")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                origin, *facts, parts = [c[i].as_py() for c in b.columns]
                block, problem, copies = join_segments(parts)
                one = [pa.array([v], t) for v, t in zip([origin, *facts, block, problem], kinds)]
                for _ in range(copies):
                    yield pa.RecordBatch.from_arrays(one, names)
    names = ["record", *meta, "block", "problem"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
    joined = groups.mapInArrow(run, "record string, type string, page_id long, url string, digest string, refers string, block binary, problem string")
    return records.where(F.col("number").isNull()).select(*names).unionByName(joined)


def read_pages(spark: SparkSession, path: str, files: str = "part-*", payloads: bool = True) -> DataFrame:
    """Pages out of archives (columns as in PAGE): payloads taken out of their HTTP message and checked against their digest.

    Revisits have no payload, and their payload_digest is the one that their header states. ``problem`` says what is
    wrong with a row: a digest, framing, length or segment. Records of other types are left out."""
    def decode(kind, block, want):
        head, _, body = block.partition(b"\r\n\r\n")
        if kind != "response":
            return None, want, None
        if re.search(rb"^transfer-encoding:[ \t]*chunked[ \t]*$", head, re.I | re.M):
            try:
                body = unframed(body)
            except ValueError:
                return None, None, "broken chunk framing"
        digest = hashlib.sha256(body).hexdigest()
        return body, digest, None if want in (None, digest) else "payload digest differs"

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                rows = []
                for record, kind, page_id, url, want, refers, block, problem in zip(*(c.to_pylist() for c in part.columns)):
                    body, digest, wrong = (None, None, None) if problem else decode(kind, block, want)
                    rows.append((record, kind, page_id, url, refers, None if body is None else len(body), digest, body if payloads else None, problem or wrong))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in PAGE.split(", ")])
    whole = reassemble(read_records(spark, path, files))
    return whole.where("type in ('response', 'revisit') or problem is not null").mapInArrow(run, PAGE)


def resolve(pages: DataFrame) -> DataFrame:
    """``pages`` of read_pages with refers_to (the page_id of the response that a revisit stands for) and that response's payload_bytes.

    A revisit whose response is missing or has another digest gets a problem. Revisits of one response are dealt to SALTS tasks."""
    revisits = pages.where("record_type = 'revisit'").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    asked = revisits.select(F.col("refers").alias("record")).distinct()
    facts = pages.where("record_type = 'response' and problem is null").join(asked, "record", "left_semi").groupBy("record").agg(
        F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("bytes"), F.min("payload_digest").alias("found"))
    facts = facts.withColumnRenamed("record", "refers").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    found = revisits.join(facts, ["refers", "salt"], "left").withColumn("payload_bytes", F.col("bytes")).withColumn(
        "problem", F.coalesce("problem", F.when(F.col("found").isNull(), "response missing").when(F.col("found") != F.col("payload_digest"), "response has another digest")))
    return found.drop("salt", "bytes", "found").unionByName(
        pages.where("record_type is distinct from 'revisit'").withColumn("refers_to", F.lit(None).cast("long")))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per input row, repeated rows included; a problem in any record fails the job. Column names other than
    page_id, url and html have no meaning here."""
    small_batches(pages.sparkSession)
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    got = resolve(saved(read_pages(pages.sparkSession, path, payloads=False).drop("payload"), "warc-pages"))
    checked = F.when(F.col("problem").isNull(), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("archive: "), "problem")).cast("long"))
    return got.select("page_id", checked.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= {LEAST} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS origin FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN origin IS NULL OR page_id IS NOT DISTINCT FROM origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM origin THEN origin END AS refers_to
FROM q"""
