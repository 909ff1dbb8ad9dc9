"""Media columns: Ogg containers.

``ogg_encode`` turns a binary column into a column of complete Ogg files: the
bytes are unsigned 8-bit samples of ``channels`` interleaved channels, each a
logical stream of its own with an OggPCM header packet, all multiplexed into one
physical stream. ``ogg_decode`` takes such a column apart again: it verifies
every page's checksum, reassembles packets from lacing values (also across
pages), demultiplexes the logical streams by serial number, derives every
packet's start from the granule positions, and puts the samples where their
timestamps say.

Defined cases: a null payload or media value gives nulls; an empty payload gives
header pages only; a page with a wrong checksum is left out and counted, its
samples read as zero and ``ok`` is false; bytes that are no Ogg at all give an
empty payload, ``ok`` false. Equal payloads give equal files. Rows are
independent: nothing is shuffled, repeated rows and extra columns pass through
(columns of the names made here are replaced).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_PAGE = struct.Struct("<4sBBqIIIB")
_PCM = struct.Struct(">8sHHIIBBHI")
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))
CONTINUED, FIRST, LAST = 1, 2, 4
#: Rows whose files are held at a time.
_ROWS = 256


def ogg_crc(data: bytes) -> int:
    """Ogg's checksum (polynomial 04C11DB7, not reflected, zero start): zlib's
    is the same on bit-reversed bytes, apart from its start and end masks."""
    r = zlib.crc32(data.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(r.to_bytes(4, "little").translate(_REVERSED), "big")


def _pages(serial: int, packets: list[tuple[bytes, int]]) -> list[tuple[int, bytes]]:
    """(granule to sort by, page) of one logical stream; the first packet, its
    header, has a page of its own."""
    out: list[tuple[int, bytes]] = []
    lacing, body, granule, flags, reached = bytearray(), [], -1, FIRST, 0

    def flush(last: bool, more: bool) -> None:
        nonlocal lacing, body, granule, flags
        head = _PAGE.pack(b"OggS", 0, flags | LAST * last, granule, serial, len(out), 0, len(lacing)) + bytes(lacing)
        data = b"".join(body)
        crc = ogg_crc(head + data)
        out.append((reached, head[:22] + struct.pack("<I", crc) + head[26:] + data))
        lacing, body, granule, flags = bytearray(), [], -1, CONTINUED * more

    for i, (packet, end) in enumerate(packets):
        full, rest = divmod(len(packet), 255)
        laces, at = [255] * full + [rest], 0
        while laces:
            room = 255 - len(lacing)
            now, laces = laces[:room], laces[room:]
            n = sum(now)
            lacing += bytes(now)
            body.append(packet[at : at + n])
            at += n
            if not laces:
                granule, reached = end, end
            final = i == len(packets) - 1 and not laces
            if len(lacing) == 255 or i == 0 and not laces or final:
                flush(final, bool(laces))
    return out


def encode(payload: bytes, channels: int = 2, rate: int = 48_000, frames: int = 3_072) -> bytes:
    """One Ogg file. ``len(payload)`` must be a multiple of ``channels``."""
    if len(payload) % channels:
        raise ValueError("the payload is not a whole number of frames")
    samples, seed = np.frombuffer(payload, np.uint8), zlib.crc32(payload)
    pages = []
    for c in range(channels):
        own = samples[c::channels].tobytes()
        header = _PCM.pack(b"PCM     ", 0, 0, 1, rate, 8, 1, frames, 0)
        packets = [(header, 0)] + [(own[k : k + frames], min(k + frames, len(own))) for k in range(0, len(own), frames)]
        pages += [(at, k > 0, c, k, page) for k, (at, page) in enumerate(_pages((seed + c) & 0xFFFFFFFF, packets))]
    pages.sort(key=lambda x: (x[1], x[0], x[2], x[3]))
    return b"".join(x[-1] for x in pages)


def decode(media: bytes) -> dict:
    """payload, ok, streams, pages, bad_pages, packets, rate, frames, packet_starts (frame numbers by stream, in order of appearance)."""
    at, n, bad, pages = 0, len(media), 0, 0
    streams: dict[int, dict] = {}
    while (at := media.find(b"OggS", at)) >= 0 and at + _PAGE.size <= n:
        _, version, flags, granule, serial, number, crc, n_laces = _PAGE.unpack_from(media, at)
        lacing = media[at + _PAGE.size : at + _PAGE.size + n_laces]
        start = at + _PAGE.size + n_laces
        end = start + sum(lacing)
        page = media[at:end]
        if version or end > n or ogg_crc(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            bad += 1
            at += 4
            continue
        at, pages = end, pages + 1
        s = streams.setdefault(serial, {"header": None, "packets": [], "open": None, "number": -1, "whole": True, "ended": False})
        if number != s["number"] + 1:
            s["whole"], s["open"] = False, None
        s["number"], s["ended"] = number, bool(flags & LAST)
        carried = s["open"] if flags & CONTINUED else None
        lost = bool(flags & CONTINUED) and carried is None
        parts, done, k = [carried] if carried else [], [], start
        for lace in lacing:
            parts.append(media[k : k + lace])
            k += lace
            if lace < 255:
                if not lost:
                    done.append(b"".join(parts))
                parts, lost = [], False
        s["open"] = b"".join(parts) if parts else None
        if s["header"] is None and done:
            s["header"] = done.pop(0)
        for packet in reversed(done):  # the page's granule is the end of its last packet
            s["packets"].append((granule - len(packet), packet))
            granule -= len(packet)
        if done:
            s["packets"][-len(done) :] = s["packets"][: -len(done) - 1 : -1]
    made = [s for s in streams.values() if s["header"] is not None and s["header"][:8] == b"PCM     " and len(s["header"]) == _PCM.size]
    frames = max((a + len(p) for s in made for a, p in s["packets"]), default=0)
    out = np.zeros((frames, len(made)), np.uint8)
    filled = 0
    for c, s in enumerate(made):
        for a, p in s["packets"]:
            if a >= 0:
                out[a : a + len(p), c] = np.frombuffer(p, np.uint8)
                filled += len(p)
    ok = bool(made) and not bad and filled == out.size and all(s["whole"] and s["ended"] and s["open"] is None for s in made)
    return {"payload": out.tobytes(), "ok": ok, "streams": len(streams), "pages": pages, "bad_pages": bad, "packets": sum(len(s["packets"]) for s in made), "rate": _PCM.unpack(made[0]["header"])[4] if made else 0, "frames": frames, "packet_starts": [[a for a, _ in s["packets"]] for s in made]}


def _with(df: DataFrame, name: str, kind: T.DataType, source: str, f) -> DataFrame:
    """``df`` with column ``name`` made of column ``source``, a few rows at a time."""
    kept = [x for x in df.schema.fields if x.name != name]
    schema = T.StructType([*kept, T.StructField(name, kind)])
    arrow = {"binary": pa.binary()}.get(kind.typeName())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), _ROWS):
                some = batch.slice(k, _ROWS)
                made = pa.array([None if x is None else f(x) for x in some[source].to_pylist()], arrow)
                yield pa.RecordBatch.from_arrays([*(some[x.name] for x in kept), made], schema.names)

    return df.mapInArrow(run, schema)


def ogg_encode(df: DataFrame, payload: str, media: str = "media", channels: int = 2, rate: int = 48_000) -> DataFrame:
    """``df`` with the column ``media``: Ogg files that hold the bytes of ``payload``."""
    return _with(df, media, T.BinaryType(), payload, lambda x: encode(x, channels, rate))


DECODED = T.StructType([
    T.StructField("payload", T.BinaryType()), T.StructField("ok", T.BooleanType()), T.StructField("streams", T.IntegerType()),
    T.StructField("pages", T.LongType()), T.StructField("bad_pages", T.LongType()), T.StructField("packets", T.LongType()),
    T.StructField("rate", T.LongType()), T.StructField("frames", T.LongType()), T.StructField("feature", T.StringType()),
])


def feature(d: dict) -> str:
    """Stream layout, duration, last packet's start, and level of the samples."""
    x = np.frombuffer(d["payload"], np.uint8)
    total, squares = int(x.sum(dtype=np.int64)), int(np.square(x, dtype=np.int64).sum()) if len(x) else 0
    last = max((s[-1] for s in d["packet_starts"] if s), default=0)
    rate = d["rate"] or 1
    return f"streams={d['streams']} pages={d['pages']} packets={d['packets']} us={d['frames'] * 1_000_000 // rate} last_us={last * 1_000_000 // rate} sum={total} squares={squares}"


def ogg_decode(df: DataFrame, media: str = "media", into: str = "decoded") -> DataFrame:
    """``df`` with a struct column of ``DECODED``: samples and stream facts."""

    def one(x: bytes) -> dict:
        d = decode(x)
        return {f.name: feature(d) if f.name == "feature" else d[f.name] for f in DECODED.fields}

    kept = [x for x in df.schema.fields if x.name != into]
    schema = T.StructType([*kept, T.StructField(into, DECODED)])
    kind = pa.struct([("payload", pa.binary()), ("ok", pa.bool_()), ("streams", pa.int32()), *((x, pa.int64()) for x in ("pages", "bad_pages", "packets", "rate", "frames")), ("feature", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), _ROWS):
                some = batch.slice(k, _ROWS)
                made = pa.array([None if x is None else one(x) for x in some[media].to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*(some[x.name] for x in kept), made], schema.names)

    return df.mapInArrow(run, schema)
