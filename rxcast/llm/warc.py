"""WARC archives with a Zstandard dictionary.

Each task writes one archive: it trains a dictionary on the first records of
the archive, puts it into a leading skippable frame (magic 0x184D2A5D) and
compresses every record as a frame of its own, so a reader needs nothing but
the file and can start at any record. Pages with an equal payload are written
once; later ones become revisit records.

Archives go to a folder that the cluster shares, through ``pyarrow.fs``, under
a name that is unique to the attempt; the manifest, a Parquet table, lists
those of the attempts that succeeded, and only these are read. A lost executor
costs a rewrite of its archives.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcast.llm.tables import shared_path, stored

#: Little-endian magic of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = struct.pack("<I", 0x184D2A5D)
#: Bytes of records that a dictionary is trained on, of the dictionary, and of a read.
SAMPLE_BYTES, DICTIONARY_BYTES, READ_BYTES = 4 << 20, 64 << 10, 64 << 10
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP header only."""
    block = HTTP % len(payload) + (payload if refers is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
             f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers}>", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Fields of one record; the payload of a response."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    page, refers = (fields.get(k, "<urn:x-page:>")[12:-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
    kind = fields["WARC-Type"]
    if kind == "response" and len(payload) != size:
        raise ValueError(f"page {page}: {len(payload)} bytes of {size}")
    return {"page": int(page) if page else None, "type": kind, "refers_to": int(refers) if refers else None,
            "url": fields.get("WARC-Target-URI"), "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
            "bytes": size, "payload": payload if kind == "response" else None}


def dictionary(records: list[bytes]) -> zstd.ZstdCompressionDict | None:
    """A dictionary for these records, None where they are too few for one."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    try:
        return zstd.train_dictionary(size, records, k=512, d=8, level=3) if len(records) >= 8 and size >= 1024 else None
    except zstd.ZstdError:
        return None


def write_archive(out, records: Iterator[bytes]) -> tuple[int, int]:
    """Write records to an open file: (records, bytes written)."""
    sample, held = [], 0
    for r in records:
        sample.append(r)
        held += len(r)
        if held >= SAMPLE_BYTES:
            break
    trained, n, size = dictionary(sample), 0, 0
    if trained is not None:
        data = trained.as_bytes()
        size += out.write(DICTIONARY_MAGIC + struct.pack("<I", len(data)) + data)
    packer = zstd.ZstdCompressor(level=6, dict_data=trained, write_checksum=True)
    for r in chain(sample, records):
        size += out.write(packer.compress(r))
        n += 1
    return n, size


def read_archive(stream) -> Iterator[bytes]:
    """The records of an open archive, one frame after the other."""
    head = stream.read(8)
    trained, rest = None, head
    if head[:4] == DICTIONARY_MAGIC:
        trained, rest = zstd.ZstdCompressionDict(stream.read(struct.unpack("<I", head[4:])[0])), b""
    unpacker = zstd.ZstdDecompressor(dict_data=trained) if trained else zstd.ZstdDecompressor()
    while rest or (rest := stream.read(READ_BYTES)):
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            if not (rest := stream.read(READ_BYTES)):
                raise ValueError("the archive ends inside a record")
        yield b"".join(parts)


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for x in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "html", "digest", "refers")), strict=True):
                    yield record(x[0], x[1], x[2].encode("utf-8"), x[3], x[4])

        rows = records()
        first = next(rows, None)
        if first is None:
            return
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        with store.open_output_stream(f"{root}/{name}.part", compression=None) as out:
            n, size = write_archive(out, chain([first], rows))
        store.move(f"{root}/{name}.part", f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"archive": pa.array([f"{folder}/{name}"]), "records": pa.array([n], pa.int64()),
                                          "bytes": pa.array([size], pa.int64())})
    return run


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page", pa.int64()), ("type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                        ("digest", pa.string()), ("bytes", pa.int64()), ("payload", pa.binary())])
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_stream(name, compression=None) as stream:
                held, size = [], 0
                for data in read_archive(stream):
                    held.append(parsed(data))
                    size += len(data)
                    if size >= SAMPLE_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)


def write_archives(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 100, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per page and return the manifest (archive, records,
    bytes), itself a table in the shared folder.

    Of pages with equal payloads of at least ``revisit_bytes`` bytes that with
    the smallest id is the response and the others revisit it; smaller ones
    are all responses. A null html is empty; a null url has no target line;
    a null id revisits like any other but is never referred to. Rows that
    repeat an id and its payload are each a record of the same type. An empty
    table writes no archive. Other columns are ignored."""
    spark = pages.sparkSession
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("page"), pages[url_col].alias("url"), html.alias("html"),
                        F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"))
    first = rows.where(F.octet_length("html") >= revisit_bytes).groupBy("digest").agg(F.min("page").alias("first"))
    # a frequent payload is a skewed join key, which Spark splits; its copies shrink to a header each
    typed = rows.join(first, "digest", "left").select(
        "page", "url", "html", "digest", F.when(F.col("first") != F.col("page"), F.col("first"))
        .when(F.col("page").isNull(), F.col("first")).alias("refers"))
    folder = folder or shared_path(spark, "warc")
    return stored(typed.mapInArrow(_writer(folder), "archive string, records long, bytes long"), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(page, type, refers_to, url, digest, bytes, payload) of every record of
    the manifest's archives; the payload of a revisit is null."""
    schema = "page long, type string, refers_to long, url string, digest string, bytes long, payload binary"
    n = max(1, manifest.count())
    return manifest.select("archive").repartition(n).mapInArrow(_reader, schema)
