"""SimHash near-duplicates: tiles of fingerprints compared exactly by exclusive-or and bit counts.

A document's fingerprint has a bit set where over half of the hashes (XXH64, seed 42) of its
shingles have it. Shingles are runs of ``k`` words (``[^\\x20\\x09-\\x0D]+``, A-Z in lower case), repeats
included, joined by blanks; fewer words are one shingle; without words the fingerprint is zero, a
fingerprint like any other. Fingerprints link at ``radius`` or fewer differing bits.

Copies are one node: only distinct fingerprints are compared. A tile holds nodes of equal population
counts of the fingerprint's parts (halves or quarters of 64 bits, finer where there are more nodes); tile pairs whose counts
differ by more than the radius in sum are never made, since each differing bit moves a count by one. All others are
compared in full, so no link is lost. Work is quadratic in the number of distinct fingerprints, times the
share of tile pairs left (0.4 with halves, 0.1 with quarters); what is moved is that divided by ``TILE``.

A pair of tiles is a key of its own in the shuffle, so that no count, however common, meets in one task. Rows
hold ``CHUNK`` nodes; a task holds one tile and streams the other. Of the links of a tile pair, a spanning forest goes on, at most
a row a node, so that a group of near copies never gives all its pairs.

Defined cases: null text counts as empty; rows of equal text, or stated twice, have one fingerprint and component; a
null doc_id is no component's least id, and a component without any id has a null ``component_id``; an
empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .store import drop, materialize, scope

#: Nodes in a row of a tile, nodes in a tile at most (about), nodes compared with a row at once.
CHUNK, TILE, STEP = 1024, 65536, 128
#: Parts of a fingerprint, and how many of all nodes the commonest combination of their counts has when bits are even.
PARTS = ((1, 0.0994), (2, 0.0196), (4, 0.00149))
SEED = 42


def fingerprint(text: str, k: int = 4) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    words = text.encode().lower().split()  # bytes know A-Z and ASCII white space only
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= k:
        h = np.array([xxhash.xxh64_intdigest(whole, SEED)], np.uint64)
        return int(h[0])
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start, end = (end - length)[: len(words) - k + 1], end[k - 1 :]
    votes, n, digest = np.zeros(64, np.int64), len(start), xxhash.xxh64_intdigest
    for at in range(0, n, 16384):
        some = zip(start[at : at + 16384].tolist(), end[at : at + 16384].tolist())
        h = np.fromiter((digest(whole[a:b], SEED) for a, b in some), "<u8", min(16384, n - at))
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", k: int = 4) -> DataFrame:
    """(doc_id, fp) of every row, without any shuffle; fp is the fingerprint as a long of the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.coalesce(F.col(text), F.lit(""))).alias("fp"))


def settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (of each node the least node of its group so far) with the links i-j taken in."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up


class _Pair:
    """One tile held, another streamed past it; the links as a forest."""

    def __init__(self, radius: int):
        self.radius, self.held, self.own, self.more, self.links, self.waiting = radius, [], None, [], [], 0
        self.label = np.zeros(0, np.int64)

    def compare(self, fps: np.ndarray) -> None:
        if self.own is None:
            self.own = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
            self.label = np.arange(len(self.own))
        base = len(self.label)
        self.label = np.append(self.label, np.arange(base, base + len(fps)))
        self.more.append(fps)
        for at in range(0, len(self.own), STEP):
            near = np.bitwise_count(self.own[at : at + STEP, None] ^ fps[None, :]) <= self.radius
            if near.any():
                i, j = np.nonzero(near)
                self.links.append((i + at, j + base))
                self.waiting += len(i)
                if self.waiting > 1 << 20:
                    self.take()

    def take(self) -> None:
        if self.links:
            self.label = settle(self.label, *(np.concatenate(x) for x in zip(*self.links)))
        self.links, self.waiting = [], 0

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        self.take()
        if self.own is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        every = np.concatenate([self.own, *self.more]).view(np.int64)
        a, b = every, every[self.label]
        return a[a != b], b[a != b]


def _forests(radius: int):
    """Rows (ka, ia, kb, ib, side, fps) sorted by these, to links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pair = None, _Pair(radius)

        def told(p: _Pair) -> Iterator[pa.RecordBatch]:
            a, b = p.forest()
            for at in range(0, len(a), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 65536]), pa.array(b[at : at + 65536])], ["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch[c].to_pylist() for c in ("ka", "ia", "kb", "ib"))))
            side, lists = batch["side"].to_pylist(), batch["fps"]
            flat, cut = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            for r, now in enumerate(keys):
                if now != key:
                    yield from told(pair)
                    key, pair = now, _Pair(radius)
                fps = flat[cut[r] : cut[r + 1]]
                if side[r] == 0:
                    pair.held.append(fps.copy())
                else:
                    pair.compare(fps.copy())
        yield from told(pair)

    return run


def _counts(fp: str, parts: int, radius: int) -> Column:
    """Population counts of the parts of a fingerprint, a byte each, raised by the radius so that neighbours never borrow."""
    width = 64 // parts
    out = F.lit(0).cast("long")
    for p in range(parts):
        mask = ((1 << width) - 1) << (p * width)
        count = F.bit_count(F.col(fp).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))) + radius
        out = out + count.cast("long") * (1 << (8 * p))
    return out


def _grid(n: int, tile: int | None, parts: int | None) -> tuple[int, int]:
    """Parts of a fingerprint and nodes of a tile for ``n`` nodes; both change what is skipped, never what is found."""
    tile = tile or min(TILE, max(CHUNK, n // 48))
    return parts or next((p for p, share in PARTS if n * share <= tile), PARTS[-1][0]), tile


def links(nodes: DataFrame, radius: int = 4, tile: int | None = None, parts: int | None = None) -> DataFrame:
    """Links (a, b) among ``nodes`` (fp, distinct) that connect all fingerprints within ``radius`` of each other, written."""
    with scope(nodes.sparkSession) as results:
        parts, tile = _grid(nodes.count(), tile, parts)
        keyed = nodes.select("fp", _counts("fp", parts, radius).alias("key"))
        # a row for each combination of counts: (64 / parts + 1) ** parts, 83,521 at most
        sizes = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")), "sizes")
        chunk = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / min(CHUNK, tile)))
        per_tile = max(1, tile // CHUNK)
        rows = keyed.join(F.broadcast(sizes), "key").select("fp", "key", chunk.alias("chunk"))
        chunks = rows.groupBy("key", "chunk").agg(F.collect_list("fp").alias("fps")).select("key", F.floor(F.col("chunk") / per_tile).alias("i"), "fps")
        chunks = materialize(chunks, "tiles")
        near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
        steps = F.array(*(F.lit(sum(x << (8 * p) for p, x in enumerate(d))).cast("long") for d in near))
        n_tiles = F.ceil(F.ceil(F.col("n") / min(CHUNK, tile)) / per_tile).cast("long")
        others = F.broadcast(sizes.select(F.col("key").alias("other"), n_tiles.alias("tiles")))
        met = chunks.select("key", "i", "fps", F.explode(F.transform(steps, lambda d: F.col("key") + d)).alias("other")).join(others, "other")
        met = met.select("key", "i", "fps", "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("j"))
        own, far = F.struct("key", "i"), F.struct(F.col("other").alias("key"), F.col("j").alias("i"))
        as_first = met.filter(own <= far).select(F.col("key").alias("ka"), F.col("i").alias("ia"), F.col("other").alias("kb"), F.col("j").alias("ib"), F.lit(0).alias("side"), "fps")
        as_second = met.filter(far <= own).select(F.col("other").alias("ka"), F.col("j").alias("ia"), F.col("key").alias("kb"), F.col("i").alias("ib"), F.lit(1).alias("side"), "fps")
        pair = ["ka", "ia", "kb", "ib"]
        dealt = as_first.unionByName(as_second).repartition(*pair).sortWithinPartitions(*pair, "side")
        results.append(out := materialize(dealt.mapInArrow(_forests(radius), "a long, b long"), "links"))
        drop(chunks)
    return out


def near_classes(docs: DataFrame, text: str = "text", k: int = 4, radius: int = 4, tile: int | None = None, parts: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``: the least doc_id reachable by links, itself included."""
    with scope(docs.sparkSession) as results:
        fps = materialize(fingerprints(docs, text, k), "fingerprints")
        nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
        classes = connected_components(links(nodes.select("fp"), radius, tile, parts))
        linked = materialize(nodes.join(classes.withColumnRenamed("node", "fp"), "fp"), "linked")
        least = linked.groupBy("component").agg(F.min("least").alias("first"))
        of_linked = linked.join(least, "component").select("fp", "first")
        of_node = materialize(nodes.join(of_linked, "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id")), "classes")
        results.append(out := fps.join(of_node, "fp").select("doc_id", "fp", "component_id"))
    return out


def to_hex(fp: Column) -> Column:
    """16 lowercase digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
