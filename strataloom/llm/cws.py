"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: its words (runs of ``[^\\x20\\x09-\\x0D]``) with
their counts. For each of ``k`` samples every term draws r, c ~ Gamma(2, 1) and
b ~ U(0, 1) from a hash of the term and the sample's number, so that all documents
share the draws; with weight w

    t = floor(ln w / r + b),   y = exp(r (t - b)),   a = c / (y exp r)

and the sample is the pair (term, t) of least a (Ioffe 2010). Two documents have
the same pair with probability sum(min) / sum(max) of their weights, the
generalised Jaccard similarity. A pair is kept as 16 bits, so a fingerprint is
``4 k`` hex digits and unequal pairs agree by chance once in 65,536.

Defined cases: null text counts as empty; documents without words have the
fingerprint of zeros, whose likeness is 1 to each other and 0 to any other's.
Very long texts are sampled whole. Of terms of equal a the first counts, those that occur once before others, each in the text's order. ``edited_likeness`` gives each row one row: rows of equal
doc_id go by a hash of their texts and then the texts, so a row stated twice is its own next; rows without
doc_id come first, in one place with the least long; a single row is its own next; an empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 64
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Terms whose draws a worker keeps; for others they are made anew.
_KEPT_ONCE, _KEPT_MORE = 500_000, 40_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """Fingerprints of texts; the draws of frequent terms are kept."""

    def __init__(self, k: int = K):
        self.k = k
        self._steps = (np.arange(-(-5 * k // 2), dtype=np.uint64) + np.uint64(1)) * _GOLDEN
        #: Of terms that occur once in a document only ln a is needed, of others r, ln c and b.
        self._once: dict[str, int] = {}
        self._more: dict[str, int] = {}
        self._ln_a, self._n_once = np.empty((4096, k), np.float32), 0
        self._rcb, self._n_more = np.empty((1024, 3, k), np.float32), 0

    @staticmethod
    def _hash(words: list[str]) -> np.ndarray:
        import xxhash

        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

    def _draws(self, words: list[str]) -> np.ndarray:
        """(words, 3, k): r, ln c and b."""
        out = np.empty((len(words), 3, self.k), np.float32)
        for i in range(0, len(words), 512):
            h = self._hash(words[i : i + 512])
            bits = _mix(h[:, None] + self._steps).view(np.uint32)[:, : 5 * self.k]  # two numbers of each word
            u = ((bits >> np.uint32(8)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)
            u = u.reshape(len(h), 5, self.k)
            out[i : i + 512, 0] = -np.log(u[:, 0] * u[:, 1])
            out[i : i + 512, 1] = np.log(-np.log(u[:, 2] * u[:, 3]))
            out[i : i + 512, 2] = u[:, 4]
        return out

    def _rows_once(self, words: list[str]) -> np.ndarray:
        """ln a of terms of weight 1, where t = 0: ln c + r b - r."""
        once, extra = self._once, None
        new = [w for w in words if w not in once]
        if new:
            d = self._draws(new)
            made = d[:, 1] + d[:, 0] * d[:, 2] - d[:, 0]
            room = _KEPT_ONCE - self._n_once
            if len(new) <= room:
                need = self._n_once + len(new)
                if need > len(self._ln_a):
                    self._ln_a = np.concatenate([self._ln_a[: self._n_once], np.empty((max(need, len(self._ln_a)), self.k), np.float32)])
                self._ln_a[self._n_once : need] = made
                self._once.update(zip(new, range(self._n_once, need)))
                self._n_once = need
            else:
                extra = made
        if extra is None:
            return self._ln_a[np.fromiter(map(self._once.__getitem__, words), np.int64, len(words))]
        at = {w: -1 - i for i, w in enumerate(new)}
        ids = np.fromiter((self._once[w] if w in self._once else at[w] for w in words), np.int64, len(words))
        out = np.empty((len(words), self.k), np.float32)
        out[ids >= 0] = self._ln_a[ids[ids >= 0]]
        out[ids < 0] = extra[-1 - ids[ids < 0]]
        return out

    def _rows_more(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self._more]
        if new:
            if self._n_more + len(new) > _KEPT_MORE:
                if len(words) > _KEPT_MORE // 2:
                    return self._draws(words)
                self._more, self._n_more, new = {}, 0, list(words)
            need = self._n_more + len(new)
            if need > len(self._rcb):
                self._rcb = np.concatenate([self._rcb[: self._n_more], np.empty((max(need, len(self._rcb)), 3, self.k), np.float32)])
            self._rcb[self._n_more : need] = self._draws(new)
            self._more.update(zip(new, range(self._n_more, need)))
            self._n_more = need
        return self._rcb[np.fromiter(map(self._more.__getitem__, words), np.int64, len(words))]

    def samples(self, weights: dict[str, int]) -> np.ndarray:
        """k 16-bit samples of a weighted set; zeros for the empty one."""
        if not weights:
            return np.zeros(self.k, np.uint16)
        once = [w for w, n in weights.items() if n == 1]
        more = [w for w, n in weights.items() if n != 1]
        best = np.full(self.k, np.inf, np.float32)
        pick = np.zeros(self.k, np.int64)
        level = np.zeros(self.k, np.int64)
        every, cols = once + more, np.arange(self.k)
        for i in range(0, len(once), 4096):
            a = self._rows_once(once[i : i + 4096])
            j = a.argmin(0)
            least = a[j, cols]
            win = least < best
            best[win], pick[win] = least[win], i + j[win]
        ln_w = np.log(np.fromiter(map(weights.__getitem__, more), np.float64, len(more))).astype(np.float32)
        for i in range(0, len(more), 4096):
            d = self._rows_more(more[i : i + 4096])
            r, ln_c, b = d[:, 0], d[:, 1], d[:, 2]
            t = np.floor(ln_w[i : i + 4096, None] / r + b)
            a = ln_c - r * (t - b) - r
            j = a.argmin(0)
            least = a[j, cols]
            win = least < best
            best[win], pick[win], level[win] = least[win], len(once) + i + j[win], t[j, cols][win].astype(np.int64)
        h = self._hash([every[p] for p in pick.tolist()])
        out = (_mix(h + level.astype(np.uint64) * _GOLDEN) & np.uint64(0xFFFF)).astype(np.uint16)
        out[out == 0] = 1  # zeros are the empty set's
        return out

    def fingerprint(self, text: str) -> np.ndarray:
        return self.samples(Counter(_WORDS.findall(text)))


_samplers: dict[int, Sampler] = {}


def sampler(k: int) -> Sampler:
    """One sampler with its draws for all tasks of a worker process."""
    if k not in _samplers:
        _samplers[k] = Sampler(k)
    return _samplers[k]


def to_hex(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimate of the generalised Jaccard similarity."""
    return float((a == b).mean())


def cws_fingerprints(df: DataFrame, text: str = "text", into: str = "fingerprint", k: int = K) -> DataFrame:
    """``df`` with a fingerprint column, without any shuffle."""

    @F.pandas_udf("string")
    def f(texts: pd.Series) -> pd.Series:
        s = sampler(k)
        return pd.Series([to_hex(s.fingerprint(x)) for x in texts])

    return df.withColumn(into, f(F.coalesce(F.col(text), F.lit(""))))


def with_neighbour(docs: DataFrame, per_pair, schema: str) -> DataFrame:
    """Apply ``per_pair`` to each document and the next one in ascending
    (doc_id, hash of text, text), nulls first; the last one's next is the first.

    Documents are dealt to ranges of doc_id, each sorted on its own; the first
    document of the next range is added to each range. The driver sees quantiles
    and one id for each range. ``per_pair(rows)`` gets an iterator of
    (doc_id, text, last?) with the added document flagged, and yields tuples.
    """
    spark = docs.sparkSession
    low = -(1 << 63)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.coalesce("doc_id", F.lit(low)))
    # an error below a range's share, so that more partitions are more ranges
    bounds = np.unique(np.array(rows.approxQuantile("key", [i / n for i in range(1, n)], min(0.002, 0.25 / n)) if n > 1 else [], np.float64))

    @F.pandas_udf("int")
    def part(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.float64), "right").astype(np.int32))

    firsts = sorted(rows.select("key").withColumn("part", part("key")).groupBy("part").agg(F.min("key").alias("key")).collect())
    nexts = [(p.part, q.key) for p, q in zip(firsts, firsts[1:] + firsts[:1])]
    # one row for each range: as many as shuffle partitions
    halo = F.broadcast(spark.createDataFrame(nexts, "part int, key long"))
    first_text = rows.withColumn("h", F.xxhash64("text")).join(halo, "key").groupBy("part", "key").agg(F.min_by(F.struct("doc_id", "text"), F.struct("h", "text")).alias("d"))
    added = first_text.select("part", F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text"), "key", F.lit(True).alias("added"))
    own = rows.select(part("key").alias("part"), "doc_id", "text", "key", F.lit(False).alias("added"))
    dealt = own.unionByName(added).repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "added", "key", F.xxhash64("text"), "text")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.types import StructType  # noqa: F401

        def each():
            for batch in batches:
                for i in range(0, len(batch), 256):
                    some = batch.slice(i, 256)
                    yield from zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), some["added"].to_pylist())

        held = []
        for row in per_pair(each()):
            held.append(row)
            if len(held) >= 512:
                yield _batch(held, names, types)
                held = []
        if held:
            yield _batch(held, names, types)

    types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[x.split()[1]] for x in schema.split(", ")]
    return dealt.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_likeness(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of documents and of edited ones: the last quarter of the code
    points gives way to the beginning of the next document. Columns ``EDITED``."""

    def per_pair(rows):
        s, before = sampler(k), None
        for doc_id, text, added in rows:
            own = s.fingerprint(text)
            if before is not None:
                a_id, a_text, a = before
                q = len(a_text) // 4
                edited = a_text[: len(a_text) - q] + text[:q]
                e = s.fingerprint(edited)
                yield a_id, len(a_text), hashlib.sha256(edited.encode()).hexdigest(), to_hex(a), to_hex(e), likeness(a, e), likeness(a, own)
            before = None if added else (doc_id, text, own)

    return with_neighbour(docs, per_pair, EDITED)
