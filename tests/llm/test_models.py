"""Mixing, quality, fingerprints and the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from strataloom.llm import cws, mixing, quality, queries


def python_targets(sizes: dict, weights, share, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > cap * sizes[s]}
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([0, 1, 7, 40, 200]), rng.choice(["a", "b", "hot", "hot", "hot", "é", None])) for i in range(2500)]
    rows += [(None, "one two", "a"), (7, "x y z", "b"), (7, "x y z", "b"), (8000, None, "only empty")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, size int").repartition(6)
    out = mixing.mix(df, [3, 1, 2]).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = python_targets(sizes, [3, 1, 2], 1.5, 2)
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 400 for s in sizes)
    again = mixing.mix(df.repartition(2), [3, 1, 2]).collect()
    key = lambda r: (str(r.doc_id), r.size, str(r.source), r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.mix(df.limit(0), [3, 1, 2]).count() == 0


def test_multipliers_equal_a_dense_solution(spark):
    """Rates of documents against Newton's method on the whole problem in numpy; no constant ratio a source gives them."""
    rng = random.Random(8)
    sizes = {s: [rng.choice([1, 3, 10, 60, 700]) for _ in range(400)] for s in ("a", "b", "c")}
    aims = {"a": 0.3, "b": 1.7, "c": 1.0}
    rows = [(i, s, n, i) for s, ns in sizes.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, text_hash long").repartition(5)
    targets = spark.createDataFrame([(s, sum(sizes[s]), aims[s] * sum(sizes[s])) for s in sizes], "source string, source_size long, target double")
    solved = {r.source: r for r in mixing.multipliers(df, targets, 2.0).collect()}
    for s, ns in sizes.items():
        n, t, x = np.array(ns, float), aims[s] * sum(ns), 0.0
        z = n / n.mean()
        for _ in range(200):
            r = 2 / (1 + np.exp(-x * z))
            step = ((r * n).sum() - t) / (r * (1 - r / 2) * n * z).sum()
            x -= max(-0.5, min(0.5, step))
        assert abs(solved[s].l - x) <= 1e-5 * max(1, abs(x))
        r = 2 / (1 + np.exp(-x * z))
        assert abs((r * n).sum() - t) <= 1e-6 * t
    assert solved["a"].l < -0.1 and solved["b"].l > 0.1 and abs(solved["c"].l) < 1e-6
    got = mixing.mix(spark.createDataFrame([(i, "w " * n, s) for i, s, n, _ in rows], "doc_id long, text string, source string"), [3, 1, 2])
    spread = {(r.source, r.size): r.rate for r in got.collect()}
    assert len({round(v, 6) for (s, n), v in spread.items() if s == "b"}) > 1 and all(0 <= v <= 2 for v in spread.values())


def test_many_sources_are_joined_in_parts(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 23:02d}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: (r.doc_id, r.source, r.taken)
    few = sorted(map(key, mixing.mix(df, [3, 1, 2]).collect()))
    monkeypatch.setattr(mixing, "FEW", 3)
    assert sorted(map(key, mixing.mix(df, [3, 1, 2]).collect())) == few


def test_quality_on_held_out(spark, sf):
    sf = sf.replace("0.001", "0.01")
    scored = {r.doc_id: r for r in queries.op7_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(scored[d].held_out for d in held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())
    assert np.mean([scored[d].predicted == labels[d] for d in held]) >= 0.95


def test_quality_odd_tables(spark):
    docs = spark.createDataFrame([(1, "", "x"), (2, None, "x"), (2, "good text here.", "y"), (None, "abc", "z")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.predict(docs, quality.fit(docs, none)).collect()} == {1.0}
    some = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.predict(docs, quality.fit(docs, some)).count() == 4
    assert quality.predict(docs.limit(0), quality.fit(docs, some)).count() == 0


def test_isotonic():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 30, 200).astype(float), rng.integers(0, 2, 200).astype(float)
    knots, values = quality.isotonic(x, y)
    assert (np.diff(values) >= 0).all() and (np.diff(knots) > 0).all()
    fit = np.array([max(min(y[(x >= a) & (x <= b)].mean() for b in set(x) if b >= v) for a in set(x) if a <= v) for v in knots.round()])
    assert len(fit) == len(values)


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(2)
    s, errors = cws.Sampler(512), []
    for _ in range(30):
        a = Counter({f"t{i}": rng.randint(1, 9) for i in range(rng.randint(5, 60))})
        b = Counter({t: max(1, n + rng.randint(-3, 3)) for t, n in a.items() if rng.random() < 0.8}) + Counter({f"u{i}": rng.randint(1, 5) for i in range(rng.randint(0, 20))})
        errors.append(cws.likeness(s.samples(a), s.samples(b)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.abs(errors).max() < 0.1


def test_memo_does_not_change_samples(monkeypatch):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i + 1)) for i in range(60)]
    full = [cws.Sampler(16).fingerprint(t).tolist() for t in texts]
    monkeypatch.setattr(cws, "_KEPT_ONCE", 20)
    monkeypatch.setattr(cws, "_KEPT_MORE", 20)
    small = cws.Sampler(16)
    assert [small.fingerprint(t).tolist() for t in texts] == full


def test_edited_neighbours(spark):
    rows = [(3, "a b c d e f g h"), (1, None), (10, "x" * 50), (3, "q r s t"), (None, "first one here"), (7, ""), (20, "the last of all é")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(4)
    got = cws.edited_likeness(df, 32).collect()
    assert len(got) == len(rows)
    import hashlib

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = {}
    for d, t in order:
        texts.setdefault(d, []).append(t or "")
    nexts = {d: {x[1] or "" for x in order if x[0] == order[(max(i for i, y in enumerate(order) if y[0] == d) + 1) % len(order)][0]} for d, _ in order}
    for r in got:
        cands = [t for t in texts[r.doc_id] if len(t) == r.n_chars]
        follow = nexts[r.doc_id] | set(texts[r.doc_id])
        made = {hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest() for t in cands for n in follow}
        assert r.edited_sha256 in made and 0 <= r.near_edited <= 1
    assert cws.edited_likeness(df.limit(0)).count() == 0
    fp = cws.cws_fingerprints(df, k=32).collect()
    assert {r.fingerprint for r in fp} == {r.fingerprint for r in got}


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES][0].startswith("quality") and corpus_pipeline.ORACLE_SQL is None
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, kept[-1], sf).collect(), docs.schema)
        assert out.columns == columns and out.count() > 0, name
        kept.append(out)
    good, lines, near, mixed = ([r.asDict() for r in k.collect()] for k in kept[1:])
    assert {r["doc_id"] for r in lines} <= {r["doc_id"] for r in good} and {r["doc_id"] for r in near} <= {r["doc_id"] for r in lines}

    def shingled(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {r["doc_id"]: shingled(r["text"]) for r in lines}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in near) == [i for i in ids if find(i) == i]
    copies = Counter(r["doc_id"] for r in mixed)
    assert max(copies.values()) <= 2 and set(copies) <= {r["doc_id"] for r in near}
    pieces = corpus_pipeline.pack(spark, kept[-1], sf).collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == copies
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(pieces)
