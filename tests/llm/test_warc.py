import gzip
import hashlib
import random
import tempfile

import pytest

from reviewguard.llm import warc
from reviewguard.llm.common import shared_path
from reviewguard.llm.queries import QUERIES

from .conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, record string, payload string, digest string, salt int"


def expected(rows):
    """Per row (page_id, bytes, digest, type, refers_to), sorted."""
    bodies = [((r[2] or "").encode()) for r in rows]
    least = {}
    for r, b in zip(rows, bodies):
        if len(b) >= 100:
            least[b] = min(least.get(b, (True, 0)), (r[0] is None, r[0] or 0))
    out = []
    for r, b in zip(rows, bodies):
        first = least.get(b)
        again = first is not None and first != (r[0] is None, r[0] or 0)
        out.append((r[0], len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[1] if again else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert got(QUERIES["op11_warc"](spark, SF_SMALL)) == expected(rows)


HARD = ["", None, "x" * 99, "x" * 100, "é" * 50, "WARC/1.1\r\nContent-Length: 5\r\n\r\nhallo\r\n\r\n" * 9, "0\r\n\r\n" * 60, "\r\n\r\n" * 100, "日本" * 90_000, "a" * 70_000, "\x00\n\x0b" * 100]


def test_edge_rows(spark):
    rows = [(i, f"http://h/{i % 3}\r\nX: y", x, "r", "p", "d", 1) for i, x in enumerate(HARD * 2)]
    rows += [rows[7], rows[8], rows[8], (None, None, HARD[8], None, None, None, None), (3, None, "other", "r", "p", "d", 1), (-5, "u", "x" * 100, "r", "p", "d", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(warc.round_trip(df)) == expected(rows)
    assert got(warc.round_trip(df.limit(0))) == []


def test_payloads_come_back_through_small_segments(spark):
    r = random.Random(4)
    rows = [(i, f"http://h/{i}", "".join(r.choices("ab\r\n é😀0", k=r.randrange(0, 900))), None, None, None, None) for i in range(60)]
    path = shared_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, segment=37, chunk=11, per_file=50)
    records = warc.read_records(spark, path)
    assert records.where("type = 'continuation'").count() > 500 and records.where("length(block) > 37").count() == records.where("type = 'revisit' and length(block) > 37").count()
    pages = warc.read_pages(spark, path)
    back = {p.page_id: (p.url, bytes(p.payload), p.problem) for p in pages.where("record_type = 'response'").collect()}
    least = {t[2]: t[0] for t in reversed(rows)}
    assert back == {t[0]: (t[1], t[2].encode(), None) for t in rows if len(t[2].encode()) < 100 or least[t[2]] == t[0]}


def parts(*sizes, total=None):
    out = [{"number": i, "copies": 1, "total": None, "block": bytes([64 + i]) * s, "problem": None} for i, s in enumerate(sizes, 1)]
    out[-1]["total"] = sum(sizes) if total is None else total
    return out


def test_join_segments():
    assert warc.join_segments(parts(3, 2, 1)[::-1]) == (b"AAABBC", None, 1)
    assert warc.join_segments(parts(3, 2, total=6))[1] == "total length differs"
    assert warc.join_segments(parts(3, 2, 1)[:2])[1] == "segment missing"
    assert warc.join_segments(parts(3, 2, 1)[1:])[1] == "segment missing"
    a = parts(3, 2)
    assert warc.join_segments([*a, {**a[0], "block": b"zzz"}])[1] == "segments of one number differ"
    assert warc.join_segments([{**p, "copies": 4} for p in a]) == (b"AAABB", None, 4)


def test_framing():
    assert warc.unframed(b"4;ext=1\r\nWiki\r\n5\r\npedia\r\n0\r\nTrailer: x\r\n\r\n") == b"Wikipedia"
    for x in (b"", b"5\r\nab", b"zz\r\n", b"2\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unframed(x)
    assert all(warc.unframed(warc.framed(b"x" * n, 7)) == b"x" * n for n in range(40))


def test_foreign_and_damaged_archives(spark):
    """Members per record, no compression, bodies without framing; cut and altered archives say so."""
    def record(fields, block):
        return warc._record(fields, block) + b"\r\n\r\n"
    plain = b"HTTP/1.0 200 OK\r\nContent-Type: text/plain\r\n\r\nbody one"
    a = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<i>")], b"software: x\r\n")
    b = record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("WARC-Target-URI", "http://a/")], plain)
    c = record([("WARC-Type", "response"), ("WARC-Record-ID", "<b>"), ("WARC-Payload-Digest", "sha256:" + "0" * 64)], plain)
    d = record([("WARC-Type", "continuation"), ("WARC-Record-ID", "<c2>"), ("WARC-Segment-Origin-ID", "<c>"), ("WARC-Segment-Number", 2), ("WARC-Segment-Total-Length", 9)], b"tail")
    folder = tempfile.mkdtemp(prefix="warc-")
    for name, data in {"part-1": a + b, "part-2": gzip.compress(a) + gzip.compress(b) + gzip.compress(c), "part-3": d, "part-4": (a + b)[:-20], "part-5": b + b"junk", "part-6": gzip.compress(a + b)[:-9],
                       "part-7": b.replace(b"body", b"BODY"), "part-8": b""}.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    rows = warc.read_pages(spark, f"file://{folder}").collect()
    good = [r for r in rows if r.problem is None]
    assert len(good) >= 3 and all(bytes(r.payload) == b"body one" and r.url == "http://a/" for r in good)
    problems = sorted(r.problem for r in rows if r.problem)
    assert {"payload digest differs", "segment missing", "truncated record", "no record where one should begin", "block digest differs"} <= set(problems)
    assert any(p.startswith("broken archive") for p in problems)
    # a revisit without its response
    lone = spark.createDataFrame([("x", "revisit", 5, "u", "nowhere", None, "d", None, None)], warc.PAGE)
    assert warc.resolve(lone).first().problem == "response missing"
