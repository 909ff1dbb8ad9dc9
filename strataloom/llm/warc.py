"""WARC: dictionary-compressed archives.

``write_warc`` stores records in ``.warc.zst`` files: a Zstandard dictionary is
built from the first records of each archive, put in a leading skippable frame
(magic 184D2A5D, as readers of such archives expect), and every record is a
frame of its own, compressed with that dictionary. ``read_warc`` reads archives
back, record by record.

Records with equal payloads: the one with the largest id is a ``response``, the
others ``revisit`` it, from ``min_revisit_bytes`` of payload on.

Defined cases: a null payload is the empty one; a null url leaves out the target
header, a null id the id headers, and such a record is always a response and
never referred to; repeated rows with the largest id are all responses; an empty
table gives no archives and no records; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, read_file, shared_dir, write_file

MAGIC = 0x184D2A5D
#: Bytes of records from which an archive's dictionary is built; bytes of records in one archive.
SAMPLE, ARCHIVE = 2 << 20, 64 << 20
DICTIONARY = 32 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CTRL = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header but no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    head.append(f"WARC-Record-ID: {_urn(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}")
    if url is not None:
        head.append("WARC-Target-URI: " + _CTRL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]):
    """Trained on the samples; where they are too few for that, their own last bytes."""
    import zstandard as zstd

    try:
        return zstd.train_dictionary(DICTIONARY, samples, k=256, d=8)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(samples)[-DICTIONARY:], dict_type=zstd.DICT_TYPE_RAWCONTENT)


def archive(samples: list[bytes], rest: Iterator[bytes], level: int = 3) -> Iterator[bytes]:
    """Bytes of one archive, piece by piece."""
    import zstandard as zstd

    d = _dictionary(samples)
    raw = d.as_bytes()
    yield struct.pack("<II", MAGIC, len(raw)) + raw
    d.precompute_compress(level=level)
    c = zstd.ZstdCompressor(level=level, dict_data=d, write_content_size=True)
    for some in (samples, rest):
        for r in some:
            yield c.compress(r)


def read_archive(buf) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    import zstandard as zstd

    view, at = memoryview(buf), 0
    d = None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == MAGIC:
        (n,) = struct.unpack_from("<I", view, 4)
        raw, at = bytes(view[8 : 8 + n]), 8 + n
        if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may be compressed itself
            raw = zstd.ZstdDecompressor().decompress(raw)
        d = zstd.ZstdCompressionDict(raw)
    z = zstd.ZstdDecompressor(dict_data=d) if d else zstd.ZstdDecompressor()
    while at < len(view):
        frame, out, step = z.decompressobj(), [], 4096
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            chunk = view[at : at + step]
            out.append(frame.decompress(chunk))
            at += len(chunk) - (len(frame.unused_data) if frame.eof else 0)
            step = min(step * 4, 1 << 20)
        text = b"".join(out)
        head, _, body = text.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        yield headers, body[: int(headers["content-length"])]


def revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of records that revisit another. Only ids and
    digests are grouped and joined, with a partial aggregate before the shuffle."""
    keys = pages.select("page_id", F.sha1(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    keys = keys.filter((F.col("n") >= min_revisit_bytes) & F.col("page_id").isNotNull())
    top = keys.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c")).filter("c > 1").drop("c")
    return keys.join(top, ["digest", "n"]).filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write ``pages`` (page_id, url, html); returns the table of archives (path, n_records, n_bytes)."""
    out = shared_dir(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for k in range(0, len(batch), 256):
                    some = batch.slice(k, 256)
                    for row in zip(*(some[c].to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                        yield record(row[0], row[1], row[2].encode(), row[3], date)

        source, left = records(), True
        while left:
            count, held = 0, 0
            samples: list[bytes] = []

            def upto(limit: int) -> Iterator[bytes]:
                nonlocal count, held, left
                while held < limit:
                    r = next(source, None)
                    if r is None:
                        left = False
                        return
                    count, held = count + 1, held + len(r)
                    yield r

            samples += upto(SAMPLE)
            if samples:
                path = f"{out}/{uuid.uuid4().hex}.warc.zst"
                size = write_file(path, archive(samples, upto(archive_bytes)))
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["path", "n_records", "n_bytes"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    found = revisits(rows, min_revisit_bytes)
    rows = rows.withColumn("digest", F.sha1("html")).join(found, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")
    return materialize(rows.mapInArrow(write, "path string, n_records long, n_bytes long"), "archives")


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, intact boolean, payload binary"


def read_warc(archives: DataFrame) -> DataFrame:
    """Records of the archives, columns ``READ``. ``payload`` is null for
    revisits; their length and digest come from their headers. ``intact``: the
    stored payload has the length and digest that the headers name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(urn: str | None) -> int | None:
            return int(urn[12:-1]) if urn and urn.startswith("<urn:x-page:") else None

        def rows(path: str) -> Iterator[tuple]:
            for h, block in read_archive(read_file(path)):
                http, _, payload = block.partition(b"\r\n\r\n")
                said = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
                named = h["warc-payload-digest"].removeprefix("sha1:")
                if h["warc-type"] == "revisit":
                    yield number(h["warc-record-id"]), h.get("warc-target-uri"), "revisit", number(h["warc-refers-to"]), said, named, True, None
                else:
                    own = payload_digest(payload)
                    yield number(h["warc-record-id"]), h.get("warc-target-uri"), "response", None, len(payload), own, own == named and said == len(payload), payload

        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary())
        names = [x.split()[0] for x in READ.split(", ")]
        for batch in batches:
            for path in batch["path"].to_pylist():
                held: list[tuple] = []
                for row in rows(path):
                    held.append(row)
                    if len(held) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(n, "path").mapInArrow(read, READ)
