"""SimHash classes against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strataloom.llm import queries, simhash

WORDS = [f"w{i:x}" for i in range(3000)]


def plain(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids: list[int | None], fps: list[int], radius: int) -> list[int | None]:
    n, root = len(fps), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(n)]


def corpus() -> list[str | None]:
    rng = random.Random(1)
    base = [rng.choices(WORDS, k=rng.randint(1, 300)) for _ in range(60)]
    out: list[str | None] = [" ".join(b) for b in base]
    for _ in range(120):  # drifting copies, so that groups are chains
        own = list(rng.choice(base[:20]))
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        out.append(rng.choice([" ", "\n", "\t \r"]).join(own))
    out += ["", None, " \n\t", "One", "ONE", "one two three", "one  two three four", "É a b c d", "é a b c d", " x y z w v", out[0], out[0], " ".join(rng.choices(WORDS, k=40_000))]
    return out


@pytest.mark.parametrize(("parts", "tile"), [(1, None), (2, 8), (4, 3), (None, None)])
def test_classes_equal_brute_force(spark, monkeypatch, parts, tile):
    monkeypatch.setattr(simhash, "STEP", 7)
    texts = corpus()
    ids = [None if i % 37 == 5 else i * 3 - 40 for i in range(len(texts))]
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in zip(ids, texts)], "doc_id long, text string, fp string, key int").repartition(5)
    want_fp = [plain(t) for t in texts]
    want = sorted(zip(map(str, ids), (f"{x:016x}" for x in want_fp), map(str, classes(ids, want_fp, 4))))
    got = simhash.near_classes(df, parts=parts, tile=tile).select("doc_id", simhash.to_hex(F.col("fp")).alias("fp"), "component_id").collect()
    assert sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_links_of_planted_fingerprints(spark, parts):
    """Bits flipped one after the other: chains, dense groups, and numbers at the ends of the range."""
    rng = np.random.default_rng(2)
    own = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    fps = {0, (1 << 64) - 1, 1, 31, 63, (1 << 64) - 2, *map(int, own)}
    for x in own[:15]:
        for _ in range(30):
            fps.add(int(x))
            x = x ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 6), dtype=np.uint64))
    fps |= {int(own[39]) ^ (1 << i) for i in range(64)}
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    from strataloom.llm.graph import connected_components

    edges = simhash.links(df, parts=parts, tile=16)
    of = {r.node % (1 << 64): r.component % (1 << 64) for r in connected_components(edges).collect()}
    want = classes(list(range(len(fps))), fps, 4)
    groups: dict = {}
    for f, c in zip(fps, want):
        groups.setdefault(c, set()).add(f)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(f for f in of if of[f] == c) for c in set(of.values())}
    assert edges.count() <= len(fps) * 2 * 41 * (1 + len(fps) // 16)


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_simhash(spark, str(tmp_path)).count() == 0


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [r.doc_id for r in docs], [plain(r.text) for r in docs]
    want = sorted(zip(ids, (f"{x:016x}" for x in fps), classes(ids, fps, 4)))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op12_simhash(spark, sf).collect()) == want
