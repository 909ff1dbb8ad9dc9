"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Statistics of the whole text (lengths, character classes, repetition, how well
it compresses) are standardised and mapped to random Fourier features, which
approximate a Gaussian kernel. Partitions sum the normal equations of a ridge
regression on the labels; scores of a part of the labelled rows that the
regression has not seen are calibrated by isotonic regression.

Fitting uses at most ``max_train`` labelled rows, those whose ids have the least
hashes; this is the one bound, and everything fitted is of fixed size. Scoring
passes over all documents without a shuffle.

Defined cases: a null or empty text has statistics of its own (zeros) and a score
like any; labels without a document, with a null id or a null label are left out,
several labels of an id are averaged; with no labelled row every score is 1, so that
nothing is rejected unseen; repeated rows score alike; other columns pass by.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import materialize, scope

THRESHOLD = 0.7
#: Byte classes: 0 lower, 1 upper, 2 digit, 3 blank, 4 newline, 5 sentence marks, 6 other marks, 7 beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:'\"?()-"]] = 5
_CLASS[128:] = 7
N_FEATURES = 24


def statistics(text: str) -> np.ndarray:
    """The features of one text."""
    out = np.zeros(N_FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return out
    b = np.frombuffer(raw, np.uint8)
    out[0] = np.log1p(n)
    out[1:9] = np.bincount(_CLASS[b], minlength=8) / n
    p = np.bincount(b, minlength=256) / n
    p = p[p > 0]
    out[9] = -(p * np.log(p)).sum()
    out[10] = len(zlib.compress(raw, 1)) / (n + 16)
    words = text.split()
    if words:
        m = len(words)
        counts = Counter(words)
        lengths = np.fromiter(map(len, words), np.float64, m)
        out[11] = np.log1p(m)
        out[12], out[13] = np.log(lengths.mean()), np.log1p(lengths.std())
        out[14] = len(counts) / m
        out[15] = max(counts.values()) / m
        out[16] = sum(map(str.__eq__, words, words[1:])) / m
        out[17] = sum(map(str.isalpha, words)) / m
        out[18] = sum(map(str.isupper, words)) / m
        out[19] = sum(map(str.istitle, words)) / m
    lines = text.split("\n")
    out[20] = np.log1p(len(lines))
    out[21] = len(set(lines)) / len(lines)
    out[22] = np.log1p(max(map(len, lines)))
    out[23] = sum(1 for x in lines if x and x[-1] in ".!?:;\"'") / len(lines)
    return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit (pool adjacent violators), a knot at the middle of each pool."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, sum of y, sum of x
    xs, first = np.unique(x[order], return_index=True)
    ys, n = np.add.reduceat(y[order], first), np.diff(np.append(first, len(x)))
    for a, s, w in zip(xs, ys, n):
        pools.append([float(w), float(s), float(a * w)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], last)]
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


@dataclass
class Model:
    """All that scoring needs; some tens of kB."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.w + self.phase)
        return np.concatenate([f, np.ones((len(x), 1))], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.beta):
            return np.ones(len(x))
        return np.clip(np.interp(self.fourier(x) @ self.beta, *self.knots), 0, 1)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4: 2 marks rows held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, n_fourier: int = 256, ridge: float = 1e-4, seed: int = 7, partitions: int = 16) -> Model:
    """Fit on labelled documents whose remainder is not 2: the regression on
    remainders 0 and 1, the calibration on 3 (on all, where that has none)."""
    with scope(docs.sparkSession):  # the table of features goes at the end
        return _fit(docs, labels, max_train, n_fourier, ridge, seed, partitions)


def _fit(docs: DataFrame, labels: DataFrame, max_train: int, n_fourier: int, ridge: float, seed: int, partitions: int) -> Model:
    own = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder(F.col("doc_id")) != 2))
    own = own.groupBy("doc_id").agg(F.avg("quality").alias("y"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).withColumn("fold", remainder(F.col("doc_id")))
    # broadcast: max_train rows of three numbers at most; of repeated documents the one of the least hash counts, so that no more come out
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(own.withColumnRenamed("doc_id", "label_id")), F.col("doc_id") == F.col("label_id"))
    rows = rows.groupBy("label_id").agg(F.min_by(F.struct("text", "y", "fold"), F.struct(F.xxhash64("text"), "text")).alias("row")).select("row.*")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["y"], batch["fold"].cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["y", "fold", "x"])

    seen = materialize(rows.select("text", "y", "fold").mapInArrow(featurise, "y double, fold int, x array<double>").repartition(partitions), "quality-features")

    def summed(f, n: int) -> np.ndarray:
        """The sum over partitions of ``f(y, fold, x)``, a vector of n numbers."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n)
            for batch in batches:
                if len(batch):
                    total += f(batch["y"].to_numpy(zero_copy_only=False), batch["fold"].to_numpy(), np.array(batch["x"].to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["s"])

        parts = seen.mapInArrow(run, "s binary").collect()  # at most ``partitions`` rows
        return sum((np.frombuffer(p.s) for p in parts), np.zeros(n))

    d = N_FEATURES
    s = summed(lambda y, fold, x: np.concatenate([[len(y), (fold == 3).sum(), (fold != 3).sum()], x.sum(0), (x * x).sum(0)]), 3 + 2 * d)
    if not s[0]:
        return Model(*(np.zeros(0) for _ in range(5)), (np.zeros(0), np.zeros(0)))
    mean = s[3 : 3 + d] / s[0]
    scale = np.sqrt(np.maximum(s[3 + d :] / s[0] - mean**2, 0))
    scale[scale < 1e-6 * (1 + np.abs(mean))] = 1  # constant, up to the rounding of the sums
    rng = np.random.default_rng(seed)
    w, phase = rng.normal(0, 1 / np.sqrt(d), (d, n_fourier)), rng.uniform(0, 2 * np.pi, n_fourier)
    model = Model(mean, scale, w, phase, np.zeros(0), (np.zeros(0), np.zeros(0)))
    k, apart = n_fourier + 1, s[1] > 0 and s[2] > 0

    def equations(y, fold, x):
        use = fold != 3 if apart else fold >= 0
        z = model.fourier(x[use])
        return np.concatenate([(z.T @ z).ravel(), z.T @ y[use]])

    e = summed(equations, k * k + k)
    a = e[: k * k].reshape(k, k) + ridge * s[0] * np.eye(k)
    model.beta = np.linalg.solve(a, e[k * k :])
    held = seen.filter("fold = 3") if apart else seen
    pairs = [(float(model.fourier(np.array([r.x]))[0] @ model.beta), r.y) for r in held.select("x", "y").collect()]  # max_train rows at most
    model.knots = isotonic(*(np.array(c) for c in zip(*pairs)))
    return model


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with the column ``into``; needs a column ``text``."""
    kept = [f for f in docs.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                some = batch.slice(i, 512)
                x = np.array([statistics(t or "") for t in some["text"].to_pylist()]).reshape(-1, N_FEATURES)
                yield pa.RecordBatch.from_arrays([*(some[f.name] for f in kept), pa.array(model.score(x))], schema.names)

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
