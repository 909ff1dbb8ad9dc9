"""Empty tables, nulls, very long texts, clashing columns; values against plain recomputation."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

import corpus_pipeline
from strataloom.llm import cws, quality, queries, warc

WORDS = ["alpha", "beta", "gamma,", "delta.", "eps", "zeta"]


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choices(WORDS, k=n))


def test_op4_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "x" * 300_000, 7), (3, "é" * 96, 8), (3, "é" * 96, 8)], "doc_id long, text string, media int")
    docs.write.parquet(f"{tmp_path}/some/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op4_ogg_media(spark, f"{tmp_path}/none").count() == 0
    got = queries.op4_ogg_media(spark, f"{tmp_path}/some").collect()
    assert sorted((r.n_bytes, r.payload_bytes) for r in got) == [(0, 192), (0, 192), (192, 192), (192, 192), (300_000, 300_096)] and all(r.ok for r in got)
    assert len({(r.media_sha256, r.feature) for r in got if r.n_bytes == 0}) == 1


def test_likeness_is_recomputed_from_fingerprints(spark):
    """Ids are distinct, so the next document is known; one text is very long."""
    rng = random.Random(4)
    texts = [words(rng, rng.randint(0, 60)) for _ in range(40)] + [words(rng, 200_000), "", "word"]
    df = spark.createDataFrame([(i * 7 - 50, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(5)
    got = {r.doc_id: r for r in cws.edited_likeness(df).collect()}
    plain = {(r.doc_id): r.fingerprint for r in cws.cws_fingerprints(df).collect()}

    def alike(a: str, b: str) -> float:
        return float(np.mean([a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)]))

    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, follow = got[i * 7 - 50], (i + 1) % len(texts)
        q = len(t) // 4
        edited = t[: len(t) - q] + texts[follow][:q]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), plain[r.doc_id])
        assert r.edited_fingerprint == cws.to_hex(cws.Sampler().fingerprint(edited))
        assert abs(r.near_edited - alike(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - alike(r.fingerprint, plain[follow * 7 - 50])) < 1e-12


def test_warc_html_beyond_an_archive(spark):
    rng = random.Random(5)
    rows = [(i, "http://h/", words(rng, 30_000)) for i in range(4)] + [(9, "http://h/", "<p>")]
    archives = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1), archive_bytes=1000)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_warc(archives).collect()}
    assert got == {i: h for i, _, h in rows}


def test_isotonic_values():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 30, 200).astype(float)
    y = (rng.random(200) < x / 40 + 0.1).astype(float)
    least = [max(min(y[(x >= a) & (x <= b)].mean() for b in set(x) if b >= v) for a in set(x) if a <= v) for v in sorted(set(x))]
    assert np.allclose(quality.isotonic(x, y)[1], sorted({round(v, 12) for v in least}))


def test_quality_equals_dense_equations(spark):
    """Features, ridge solution and scores in numpy, from all training rows at once."""
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randint(1, 80)) if i % 2 else "# " * rng.randint(1, 80) + str(i)) for i in range(240)] + [(240, "long text. " * 60_000)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2, 0) for i in range(241)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, n_fourier=24)
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i, _ in rows}
    train = [(i, np.array(quality.statistics(t))) for i, t in rows if fold[i] != 2]
    x = np.array([v for _, v in train])
    spread = np.where(x.std(0) < 1e-9, 1, x.std(0))
    off = ~np.isclose(model.scale, spread, rtol=1e-5)
    assert np.allclose(model.mean, x.mean(0)) and not off.any(), list(zip(np.flatnonzero(off), model.scale[off], spread[off], x.mean(0)[off]))

    def features(v):
        z = np.clip((v - model.mean) / model.scale, -8, 8)
        return np.append(np.sqrt(2 / 24) * np.cos(z @ model.w + model.phase), 1.0)

    z = np.array([features(v) for i, v in train if fold[i] != 3])
    y = np.array([i % 2 for i, _ in train if fold[i] != 3], float)
    assert np.allclose(model.beta, np.linalg.solve(z.T @ z + 1e-4 * len(train) * np.eye(25), z.T @ y), atol=1e-6)
    knots = quality.isotonic(np.array([features(v) @ model.beta for i, v in train if fold[i] == 3]), np.array([i % 2 for i, _ in train if fold[i] == 3], float))
    got = {r.doc_id: r for r in quality.predict(docs, model).collect()}
    for i, t in rows:
        assert abs(got[i].score - np.clip(np.interp(features(np.array(quality.statistics(t))) @ model.beta, *knots), 0, 1)) < 1e-9
        assert got[i].held_out == (fold[i] == 2)


def test_pipeline_odd_tables(spark, tmp_path):
    rng = random.Random(7)
    long = words(rng, 30_000)
    good = [f"Sentence {i} of words that are all its own: {' '.join(str(rng.random()) for _ in range(20))}." for i in range(30)]
    rows = [(i, t, "en", f"s{i % 2}", len(t), 1, "a") for i, t in enumerate(good)]
    rows += rows[:3] + [(3, good[3], "de", None, None, 2, "b"), (None, None, None, None, None, None, None), (50, "", None, "s0", 0, 1, None), (51, long, "en", "s1", len(long), 1, "c"), (None, "text without an id, but with words", "en", "s1", 34, 1, "d")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, row string"
    for name, n in (("some", len(rows)), ("none", 0)):
        spark.createDataFrame(rows[:n], schema).repartition(3).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, f"{tmp_path}/some").collect(), schema)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
        if name.startswith("n-gram"):
            ids = [r.doc_id for r in docs.collect() if r.doc_id is not None]
            assert len(set(ids)) == len(ids) and set(range(30)) <= set(ids) and 51 in ids
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() >= docs.count() > 0
