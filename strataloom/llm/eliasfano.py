"""Token shards: a concatenated id array with Elias-Fano document boundaries.

File layout (little-endian)::

    magic "SLEF0001" | u4 id width | u4 flags | u8 n_docs | u8 n_ids
    EF(document ends)  EF or raw (document keys)  null bitmap of keys  ids

An Elias-Fano list of n non-decreasing values below u keeps the low
``l = floor(log2(u / n))`` bits of each value packed, and the high parts in unary:
value i sets bit ``(v_i >> l) + i``. That is at most ``2 + l`` bits a value.
``select`` finds the i-th set bit from a sample for every 64th one and a
population count over the words between; no table of 64-bit offsets exists, in
the file or in memory.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"SLEF0001"
_EVERY = 64
_HEAD = struct.Struct("<8sIIQQ")
_LIST = struct.Struct("<QQBxxxxxxxQQ")


def ef_encode(values: np.ndarray) -> bytes:
    """Encode a non-decreasing array of non-negative integers."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    u = int(v[-1]) + 1 if n else 1
    low = max(0, (u // max(n, 1)).bit_length() - 1)
    high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    n_bits = (int(high[-1]) if n else 0) + 1
    bits = np.zeros(-(-n_bits // 64) * 64, np.uint8)
    bits[high] = 1
    unary = np.packbits(bits, bitorder="little").tobytes()
    if low:
        part = (v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        lows = np.packbits(part.astype(np.uint8).ravel(), bitorder="little").tobytes()
    else:
        lows = b""
    samples = high[::_EVERY].astype("<u4").tobytes() if n_bits < 1 << 32 else high[::_EVERY].astype("<u8").tobytes()
    body = samples + b"\0" * (-len(samples) % 8) + unary + lows
    body += b"\0" * (-len(body) % 8)
    return _LIST.pack(n, n_bits, low, len(unary), len(body)) + body


class EliasFano:
    """Random access to an encoded list."""

    def __init__(self, buf: memoryview):
        self.n, self.n_bits, self.low, n_unary, n_body = _LIST.unpack_from(buf)
        self.size = _LIST.size + n_body
        wide = self.n_bits >= 1 << 32
        n_samples = -(-self.n // _EVERY)
        at = _LIST.size
        self.samples = np.frombuffer(buf, "<u8" if wide else "<u4", n_samples, at)
        at += -(-n_samples * (8 if wide else 4) // 8) * 8
        self.words = np.frombuffer(buf, "<u8", n_unary // 8, at)
        at += n_unary
        self.lows = np.frombuffer(buf, np.uint8, -(-self.n * self.low // 8), at)

    def _low(self, i: int) -> int:
        if not self.low:
            return 0
        a = i * self.low
        z = -(-(a + self.low) // 8)
        return (int.from_bytes(self.lows[a // 8 : z].tobytes(), "little") >> (a % 8)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """Position of the i-th set bit of the unary part."""
        start = int(self.samples[i // _EVERY])
        need = i % _EVERY
        w = start // 64
        word = int(self.words[w]) >> (start % 64) << (start % 64)
        while (ones := word.bit_count()) <= need:
            need -= ones
            w += 1
            word = int(self.words[w])
        for _ in range(need):
            word &= word - 1
        return w * 64 + (word & -word).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return (self.select(i) - i) << self.low | self._low(i)

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Values lo .. hi - 1, scanning only the words that hold them."""
        if hi <= lo:
            return np.zeros(0, np.int64)
        first = self.select(lo)
        last = self.select(hi - 1)
        w = first // 64
        bits = np.unpackbits(self.words[w : last // 64 + 1].view(np.uint8), bitorder="little")
        pos = np.flatnonzero(bits) + w * 64
        pos = pos[(pos >= first) & (pos <= last)]
        high = (pos - np.arange(lo, hi)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high.astype(np.int64)
        a, z = lo * self.low, hi * self.low
        part = np.unpackbits(self.lows[a // 8 : -(-z // 8)], bitorder="little")[a % 8 : a % 8 + z - a]
        weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
        return (high + (part.reshape(-1, self.low).astype(np.uint64) * weights).sum(1, dtype=np.uint64)).astype(np.int64)


def shard_encode(keys: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    """One shard. ``keys`` name the documents; non-decreasing non-negative keys
    are Elias-Fano encoded relative to the first, any others are kept raw."""
    ends = np.cumsum(np.asarray(lengths, np.int64))
    null = np.array([k is None for k in keys], bool)
    k = np.array([0 if x is None else x for x in keys], np.int64)
    known = k[~null]
    rising = len(known) == 0 or bool((np.diff(known) >= 0).all() and int(known[-1]) - int(known[0]) < 1 << 62)
    if rising:
        base = int(known[0]) if len(known) else 0
        names = struct.pack("<q", base) + ef_encode(known - base)
    else:
        names = k.astype("<i8").tobytes()
    nulls = np.packbits(null, bitorder="little").tobytes()
    nulls += b"\0" * (-len(nulls) % 8)
    return b"".join((_HEAD.pack(MAGIC, width, int(rising), len(keys), len(ids) // width), ef_encode(ends), names, nulls, ids))


class Shard:
    """A shard read back; documents are located by ``ends.slice`` / ``ends[i]``."""

    def __init__(self, buf):
        view = memoryview(buf)
        magic, self.width, rising, self.n_docs, self.n_ids = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.ends = EliasFano(view[at:])
        at += self.ends.size
        n_null = -(-self.n_docs // 8)
        if rising:
            (self._base,) = struct.unpack_from("<q", view, at)
            self._keys = EliasFano(view[at + 8 :])
            at += 8 + self._keys.size
        else:
            self._keys = np.frombuffer(view, "<i8", self.n_docs, at)
            at += 8 * self.n_docs
        self._null = np.unpackbits(np.frombuffer(view, np.uint8, n_null, at), bitorder="little")[: self.n_docs].astype(bool)
        at += -(-n_null // 8) * 8
        self.ids = np.frombuffer(view, f"<u{self.width}", self.n_ids, at)

    def keys(self) -> list[int | None]:
        if isinstance(self._keys, EliasFano):
            known = iter((self._keys.slice(0, self._keys.n) + self._base).tolist())
            return [None if x else next(known) for x in self._null]
        return [None if x else k for x, k in zip(self._null.tolist(), self._keys.tolist())]

    def document(self, i: int) -> np.ndarray:
        """ids of document i by two selects."""
        return self.ids[self.ends[i - 1] if i else 0 : self.ends[i]]
