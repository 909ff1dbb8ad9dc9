"""Hard-negative mining over k-means inverted lists with exact bounds.

Vectors become integers (``floor(scale * x)``), so that scores (inner products) are exact. Centroids are
fitted on a bounded sample (``SAMPLE`` rows and ``SAMPLED_VALUES`` numbers at most, the least by a hash); every vector is put in the list
of its nearest centroid, and each list's radius is stored. By Cauchy and Schwarz a vector of a list scores within
``a.m - |a| r`` and ``a.m + |a| r`` with an anchor a, for centroid m and radius r. An anchor visits lists by descending upper bound, in rounds
that visit ever more lists; lists whose bounds lie outside of all its windows are skipped, and it stops where
the bound falls strictly below its k-th score so far. So results are those of a full search, whatever the centroids;
they only change what is skipped.

First the positives: the best other rows of the anchor's label. Then, for each positive, the best rows of
other labels in the window of scores that it opens.

Lists are cut into parts of bounded size, and anchors dealt into groups; a part and a group meet in a
task, the part held, the anchors streamed. So neither a common label, a common vector nor a wide list meets in one task.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; shorter vectors count as
filled up with zeros; rows stated twice are two rows, and an anchor stated twice is mined twice; rows with the anchor's own
vec_id are never its positives or negatives; rows without a vec_id are never anchors, and come after others of equal score; equal scores go by vec_id;
an empty table gives no rows; further columns are ignored. A component beyond 31 bits or a score beyond 56 is an error, never a wrong result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, scope

#: Rows and numbers that centroids are fitted on; iterations; rows of a list (about); lists at most.
SAMPLE, SAMPLED_VALUES, ITERATIONS, LIST_ROWS, LISTS = 16384, 1 << 21, 8, 1000, 512
#: Rows and numbers of a part of a list; anchors of a group; anchors multiplied at once; bytes of a packed row.
PART_ROWS, PART_VALUES, GROUP, AT_ONCE, PACKED = 8192, 1 << 21, 8192, 128, 8192
#: Growth of the number of lists visited, from round to round.
GROWTH = 6
_VISIT = "cluster int, part int, grp int, side int, ids binary, none binary, labels binary, vecs binary, lo binary, hi binary"
_FOUND = "key long, w int, score long, none int, id long"


def usable(vector: str, label: str) -> Column:
    v = F.col(vector)
    return F.col(label).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """(id, label, q) of the rows that take part."""
    floor = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    checked = lambda x: F.when(F.abs(x) < 2**31, x).otherwise(F.raise_error(F.lit("a scaled component is beyond 31 bits")).cast("long")).cast("int")
    q = F.transform(F.transform(vector, floor), checked)
    return rows.filter(usable(vector, label)).select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), q.alias("q"))


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    cut = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    n = len(lists)
    if (np.diff(cut) == dims).all():
        return flat[cut[0] : cut[-1]].reshape(n, dims)
    out = np.zeros((n, dims), flat.dtype)
    for i in range(n):
        out[i, : cut[i + 1] - cut[i]] = flat[cut[i] : cut[i + 1]]
    return out


def _fit(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd iterations from evenly spread rows of a bounded sample."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(ITERATIONS):
        near = _nearest(x, centroids)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        some = np.flatnonzero(n)
        sums = np.add.reduceat(x[order], (np.cumsum(n) - n)[some], axis=0)
        centroids[some] = sums / n[some, None]
    return centroids


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (centroids**2).sum(1) / 2
    for at in range(0, len(x), 2048):
        out[at : at + 2048] = (x[at : at + 2048] @ centroids.T - half).argmax(1)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of integer matrices, as 64-bit integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        out = a.astype(np.int64) @ b.T.astype(np.int64)
    else:
        out = a.astype(object) @ b.T.astype(object)
    if np.abs(out).max(initial=0) >= 1 << 56:
        raise ArithmeticError("a score is beyond 56 bits")
    return out.astype(np.int64)


@dataclass
class Index:
    """Inverted lists, written, and what the driver keeps of them: a row a list."""

    lists: DataFrame
    dims: int
    centroids: np.ndarray
    radius: np.ndarray
    parts: np.ndarray


def build_index(vectors: DataFrame, lists: int | None = None) -> Index | None:
    """Inverted lists of ``vectors`` (id, label, q); None without any rows."""
    spark = vectors.sparkSession
    n, dims = vectors.agg(F.count("*"), F.max(F.size("q"))).first()
    if not n:
        return None
    m = max(1, min(SAMPLE, SAMPLED_VALUES // max(dims, 1)))
    sample = vectors.select("q").orderBy(F.xxhash64("q", "id")).limit(m).toArrow()["q"].combine_chunks()
    x = _matrix(sample, dims).astype(np.float64)
    k = min(len(x), lists or max(1, min(LISTS, n // LIST_ROWS)))
    centroids = _fit(x, k)
    told = spark.sparkContext.broadcast(centroids)  # LISTS vectors at most
    each = max(1, PACKED // (4 * max(dims, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, none, labels, q, near, far = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(near, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(near[order])) + 1, len(order))
            rows, begin = [], 0
            for end in ends:
                for at in range(begin, end, each):
                    o = order[at : min(at + each, end)]
                    rows.append((int(near[o[0]]), float(far[o].max()), len(o), ids[o].tobytes(), none[o].tobytes(), labels[o].tobytes(), q[o].astype(np.int32).tobytes()))
                begin = end
            for at in range(0, len(rows), 256):
                c = list(zip(*rows[at : at + 256]))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int32()), pa.array(c[1], pa.float64()), pa.array(c[2], pa.int32()), *(pa.array(v, pa.binary()) for v in c[3:])], ["cluster", "far", "n", "ids", "none", "labels", "vecs"])

        for batch in batches:
            for at in range(0, len(batch), 2048):
                b = batch.slice(at, 2048)
                q = _matrix(b["q"], dims)
                near = _nearest(q.astype(np.float64), told.value)
                far = np.sqrt(((q - told.value[near]) ** 2).sum(1))
                none = b["id"].is_null().to_numpy(zero_copy_only=False)
                held.append((b["id"].fill_null(0).to_numpy(), none.astype(np.uint8), b["label"].to_numpy(), q, near, far))
                total += len(b)
                if total * max(dims, 1) > 1 << 22:
                    yield from flush()
                    held, total = [], 0
        if held:
            yield from flush()

    out = materialize(vectors.mapInArrow(run, "cluster int, far double, n int, ids binary, none binary, labels binary, vecs binary"), "lists")
    radius, parts = np.zeros(k), np.zeros(k, np.int64)
    most = min(PART_ROWS, max(1, PART_VALUES // max(dims, 1)))
    for r in out.groupBy("cluster").agg(F.max("far").alias("far"), F.sum("n").alias("n")).collect():  # a row a list
        radius[r.cluster], parts[r.cluster] = r.far, -(-r.n // most)
    return Index(out, dims, centroids, radius, parts)


def _visits(index: Index, groups: int, begin: int, end: int) -> Callable:
    """Anchors (key, id, label, q, lo, hi) to a row for each part of the lists with ranks ``begin`` to ``end`` that their bounds leave."""
    dims, told = index.dims, (index.centroids, index.radius, index.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, radius, parts = told
        size = np.sqrt((centroids**2).sum(1))
        for batch in batches:
            for at in range(0, len(batch), 256):
                b = batch.slice(at, 256)
                q, rows = _matrix(b["q"], dims), []
                keys, ids, labels, lo, hi = (b[c].to_pylist() for c in ("key", "id", "label", "lo", "hi"))
                mid = q @ centroids.T
                norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))[:, None]
                room = norm * radius + 1e-9 * (1 + norm * (size + radius))
                up, down = mid + room, mid - room
                order = np.argsort(-up, axis=1, kind="stable")[:, begin:end]
                for i, key in enumerate(keys):
                    low, high = np.array(lo[i], np.int64), np.array(hi[i], np.int64)
                    o = order[i]
                    meets = (up[i, o][:, None] >= low) & (down[i, o][:, None] <= high) & (low <= high)
                    for c in o[meets.any(1)]:
                        for p in range(parts[c]):
                            own = np.array([key, ids[i]], np.int64).tobytes(), b"", np.array([labels[i]], np.int64).tobytes(), q[i].astype(np.int32).tobytes(), low.tobytes(), high.tobytes()
                            rows.append((int(c), p, key % groups, 1, *own))
                    if len(rows) >= 512:
                        yield _packed(rows)
                        rows = []
                if rows:
                    yield _packed(rows)

    return run


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    c = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for v in c[:4]), *(pa.array(v, pa.binary()) for v in c[4:])], [x.split()[0] for x in _VISIT.split(", ")])


def _scores(dims: int, same: bool, best: int) -> Callable:
    """Rows of ``_VISIT`` sorted by their first four columns, to each anchor's best rows a window and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, part, waiting = None, [], None, []

        def take(kind: type, values: list[bytes]) -> np.ndarray:
            return np.frombuffer(b"".join(values), kind)

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal part
            if part is None:
                part = (take(np.int64, [h[0] for h in held]), take(np.uint8, [h[1] for h in held]), take(np.int64, [h[2] for h in held]), take(np.int32, [h[3] for h in held]).reshape(-1, dims))
            ids, none, labels, q = part
            own = take(np.int64, [x[0] for x in waiting]).reshape(-1, 2)
            scores = products(take(np.int32, [x[3] for x in waiting]).reshape(-1, dims), q)
            fits = (labels[None, :] == take(np.int64, [x[2] for x in waiting])[:, None]) == same
            fits &= (none[None, :] == 1) | (ids[None, :] != own[:, 1:])
            windows = [(np.frombuffer(x[4], np.int64), np.frombuffer(x[5], np.int64)) for x in waiting]
            width = max(len(lo) for lo, _ in windows)
            lo, hi = np.full((len(waiting), width), 1, np.int64), np.zeros((len(waiting), width), np.int64)  # empty windows
            for i, (a, b) in enumerate(windows):
                lo[i, : len(a)], hi[i, : len(b)] = a, b
            open_ = lo <= hi
            least = np.where(open_, lo, np.iinfo(np.int64).max).min(1)
            most = np.where(open_, hi, np.iinfo(np.int64).min).max(1)
            row, col = np.nonzero(fits & (scores >= least[:, None]) & (scores <= most[:, None]))
            s = scores[row, col]
            order = np.lexsort((ids[col], none[col], -s, row))
            row, col, s = row[order], col[order], s[order]
            for w in range(width):
                inside = (s >= lo[row, w]) & (s <= hi[row, w])
                r, c, v = row[inside], col[inside], s[inside]
                first = np.searchsorted(r, r)  # sorted by row: the place of its first
                keep = np.arange(len(r)) - first < best
                r, c, v = r[keep], c[keep], v[keep]
                if len(r):
                    yield pa.RecordBatch.from_arrays([pa.array(own[r, 0]), pa.array(np.full(len(r), w, np.int32)), pa.array(v), pa.array(none[c].astype(np.int32)), pa.array(ids[c])], ["key", "w", "score", "none", "id"])

        for batch in batches:
            for at in range(0, len(batch), 1024):
                b = batch.slice(at, 1024)
                for row in zip(*(b[c].to_pylist() for c in ("cluster", "part", "grp", "side", "ids", "none", "labels", "vecs", "lo", "hi"))):
                    if row[:3] != key or len(waiting) == AT_ONCE:
                        if waiting and held:
                            yield from told()
                        waiting = []
                    if row[:3] != key:
                        key, held, part = row[:3], [], None
                    (waiting if row[3] else held).append(row[4:])
        if waiting and held:
            yield from told()

    return run


def search(index: Index, anchors: DataFrame, n_anchors: int, same: bool, best: int) -> DataFrame:
    """(key, w, rank, score, none, id), written: the ``best`` rows within each window w of each of ``anchors`` (key, id, label, q,
    lo, hi: arrays of the windows' ends), of its label or of others."""
    spark = index.lists.sparkSession
    groups, k = max(1, -(-n_anchors // GROUP)), len(index.centroids)
    parts = F.broadcast(spark.createDataFrame([(c, int(p)) for c, p in enumerate(index.parts)], "cluster int, parts int"))  # a row a list
    held = index.lists.join(parts, "cluster").select("cluster", F.pmod(F.xxhash64("ids", "vecs"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(0).alias("side"), "ids", "none", "labels", "vecs", F.lit(b"").alias("lo"), F.lit(b"").alias("hi"))
    order = Window.partitionBy("key", "w").orderBy(F.desc("score"), "none", "id")
    found, begin, end = None, 0, max(2, k // GROWTH**2)
    with scope(spark) as results:
        while begin < k:
            state = anchors
            if found is not None:
                kth = found.filter(F.col("rank") == best).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth"))
                raised = F.transform("lo", lambda x, i: F.greatest(x, F.try_element_at("kth", i)))  # a null is no bound
                state = anchors.join(kth, "key", "left").select("key", "id", "label", "q", raised.alias("lo"), "hi")
            visits = state.mapInArrow(_visits(index, groups, begin, end), _VISIT)
            dealt = held.unionByName(visits).repartition("cluster", "part", "grp").sortWithinPartitions("cluster", "part", "grp", "side")
            hits = dealt.mapInArrow(_scores(index.dims, same, best), _FOUND)
            if found is not None:
                hits = hits.unionByName(found.drop("rank"))
            found = materialize(hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best), "found")
            begin, end = end, end * GROWTH
        results.append(found)
    return found


def _floor_div(a: Column, by: int) -> Column:
    return F.call_function("div", a - F.pmod(a, F.lit(by)), F.lit(by))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, lists: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` (vec_id, embedding, label).

    ``is_anchor`` is a condition on ``id``. A negative scores from ``low`` to ``high`` hundredths of its positive."""
    spark = rows.sparkSession
    with scope(spark) as results:
        vectors = quantised(rows)
        index = build_index(vectors, lists)
        if index is None:
            return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        anchors = materialize(vectors.filter(is_anchor & F.col("id").isNotNull()).withColumn("key", F.monotonically_increasing_id()), "anchors")
        n = anchors.count()
        ends = lambda x: F.array(F.lit(x).cast("long"))
        best = search(index, anchors.withColumns({"lo": ends(-(1 << 62)), "hi": ends(1 << 62)}), n, True, positives)
        scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
        windows = best.groupBy("key").agg(scores.alias("s"))
        # whole numbers within the window: ceiling below, floor above
        bounds = windows.select("key", F.transform("s", lambda s: -_floor_div(-(s * low), 100)).alias("lo"), F.transform("s", lambda s: _floor_div(s * high, 100)).alias("hi"))
        mined = search(index, anchors.join(bounds, "key"), n, False, negatives)
        told = lambda c: F.when(F.col("none") == 0, F.col("id")).alias(c)
        pairs = best.select("key", (F.col("rank") - 1).alias("w"), told("positive_id"), F.col("score").alias("positive_score"))
        out = mined.select("key", "w", "rank", told("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["key", "w"]).join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
        results.append(out := out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    return out


ORACLE = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM usable a, usable r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
