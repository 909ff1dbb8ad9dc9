"""Hard negatives against a full search."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, key string"


def full(rows, low=80, high=100, k=5):
    """The contract, row by row."""
    good = [(v, label, [math.floor(256 * float(x)) for x in e]) for v, e, label, *_ in rows if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for v, label, q in good:
        if v is None or v % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), w is None, w or 0, m) for w, m, p in good if w != v), key=lambda x: x[:3])
        show = lambda x: None if x[1] else x[2]
        for pos in [x for x in scored if x[3] == label][:k]:
            window = [x for x in scored if x[3] != label and low * -pos[0] <= 100 * -x[0] <= high * -pos[0]]
            out += [(v, show(pos), i + 1, show(x), -pos[0], -x[0]) for i, x in enumerate(window[:k])]
    return sorted(out, key=str)


def told(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def table(seed: int, n: int = 900, dims: int = 6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dims))
    rows = []
    for i in range(n):
        v = centres[i % 7] + rng.normal(size=dims) * 0.3
        rows.append((i * 10 - 300, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(0, 4)), "k"))
    same = rows[5][1]
    rows += [(9000 + i, same, i % 3, "k") for i in range(150)]  # a common vector
    rows += [(9300, same, 1, "k"), (None, same, 1, "k"), (None, same, 2, "k"), (10_000, None, 1, "k"), (10_100, same, None, "k"), (10_200, [None] + same[1:], 1, "k"), (10_300, [math.nan] + same[1:], 1, "k"), (10_400, [math.inf] + same[1:], 1, "k"), (10_500, [0.0] * dims, 1, "k"), (10_600, same[:2], 2, "k"), (10_700, [], 2, "k"), (10_801, same, 2, "k"), (10_801, same, 2, "k")]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize(("lists", "part", "group", "at_once", "packed"), [(1, 8192, 8192, 128, 8192), (23, 7, 5, 3, 64), (60, 50, 8192, 1, 24)])
def test_equals_a_full_search(spark, monkeypatch, lists, part, group, at_once, packed):
    for name, v in (("PART_ROWS", part), ("GROUP", group), ("AT_ONCE", at_once), ("PACKED", packed)):
        monkeypatch.setattr(negatives, name, v)
    rows = table(lists)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("id") % 100 == 0, lists=lists)
    assert told(got) == full(rows)


def test_anchor_stated_twice_and_negative_scores(spark):
    rows = [(0, [1.0, 0.5], 1, "k"), (0, [1.0, 0.5], 1, "k"), (1, [-1.0, 0.0], 1, "k"), (2, [-0.9, 0.0], 2, "k"), (3, [0.004, 0.0], 1, "k"), (4, [0.0035, 0.0], 2, "k")]
    assert told(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0)) == full(rows)


def test_lists_are_skipped(spark):
    """Far clusters are not visited once the k-th score is known."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.eye(16)[i % 16] + rng.normal(size=16) * 0.01], 0, "k") for i in range(1600)]
    index = negatives.build_index(negatives.quantised(spark.createDataFrame(rows, SCHEMA)), 16)
    lows = np.array([50_000], np.int64)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"key": [0], "id": [0], "label": [0], "q": [[256] + [0] * 15], "lo": [lows.tolist()], "hi": [[1 << 62]]})
    seen = [b.num_rows for b in negatives._visits(index, 1, 0, 16)(iter([batch]))]
    assert 0 < sum(seen) <= 4


def test_large_scores_are_exact_or_an_error(spark):
    a, b = np.array([[2**31 - 1, -5]], np.int32), np.array([[2**20, 7]], np.int32)
    assert negatives.products(a, b).tolist() == [[(2**31 - 1) * 2**20 - 35]]
    with pytest.raises(ArithmeticError):
        negatives.products(a, a)
    with pytest.raises(Exception, match="31 bits"):
        negatives.hard_negatives(spark.createDataFrame([(0, [1e30], 1, "k")], SCHEMA), F.col("id") % 100 == 0)


def test_no_rows(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("id") % 100 == 0).count() == 0
    only = spark.createDataFrame([(5, [1.0], 1, "k")], SCHEMA)
    assert negatives.hard_negatives(only, F.col("id") % 100 == 0).count() == 0
