import hashlib
import io

import zstandard as zstd

from rxcast.llm.warc import DICTIONARY_MAGIC, parsed, read_archive, read_archives, record, write_archive, write_archives


def test_round_trip_with_dictionary():
    bodies = [f"<html><p>page {i} of a site with much in common</p><p>{'text ' * 20}{i * 7919}</p></html>".encode() for i in range(300)]
    records = [record(i, f"http://x/{i}\r\n", b, hashlib.sha256(b).hexdigest(), None) for i, b in enumerate(bodies)]
    out = io.BytesIO()
    n, size = write_archive(out, iter(records))
    data = out.getvalue()
    assert n == 300 and size == len(data) and data[:4] == DICTIONARY_MAGIC
    back = list(read_archive(io.BytesIO(data)))
    assert back == records and [parsed(x)["payload"] for x in back] == bodies
    plain = sum(len(zstd.ZstdCompressor(level=6).compress(r)) for r in records)
    assert len(data) < plain  # the dictionary pays


def test_few_records_need_no_dictionary():
    out = io.BytesIO()
    write_archive(out, iter([record(None, None, b"", hashlib.sha256(b"").hexdigest(), None)]))
    (x,) = read_archive(io.BytesIO(out.getvalue()))
    assert parsed(x) | {"digest": ""} == {"page": None, "type": "response", "refers_to": None, "url": None, "digest": "", "bytes": 0, "payload": b""}


def test_revisits_and_odd_rows(spark):
    big = "<p>" + "é" * 60 + "</p>"
    rows = [(5, "u5", big, "x"), (3, "u3", big, "y"), (9, None, big, None), (None, "n", big, None), (1, "u1", "short", None),
            (2, "u2", "short", None), (4, "u4", None, None), (6, "u6", "", None), (3, "u3", big, "y"), (7, "a\r\nb: c", "x" * 200000, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(4)
    manifest = write_archives(pages)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = sorted(((r.page, r.type, r.refers_to, r.bytes, r.digest) for r in read_archives(spark, manifest).collect()), key=str)
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        revisit = html == big and page != 3
        want.append((page, "revisit" if revisit else "response", 3 if revisit else None, len(data), hashlib.sha256(data).hexdigest()))
    assert got == sorted(want, key=str)
    assert read_archives(spark, write_archives(pages.limit(0))).count() == 0
