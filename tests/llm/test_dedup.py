"""Line dedup and the n-gram join against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import line_dedup, ngram_join
from strataloom.llm.graph import connected_components

WORDS = [f"w{i:x}" for i in range(4000)]


def components(n: int, linked) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def near_copies(rng: random.Random) -> list[str | None]:
    base = [rng.choices(WORDS, k=rng.randint(20, 120)) for _ in range(40)]
    out: list[str | None] = [" ".join(b) for b in base]
    passage = " ".join(rng.choices(WORDS, k=60))
    for i in range(70):  # one group beyond the length of a column that is multiplied out
        own = list(base[0])
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        out.append(" ".join(own).upper() if i % 7 == 0 else " ".join(own))
    for _ in range(60):
        own = list(rng.choice(base))
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        out.append("\n".join(own))
    for _ in range(45):  # a passage that documents share, alike or not
        out.append(" ".join(rng.choices(WORDS, k=rng.randint(5, 80))) + "  " + passage)
    out += ["", None, "  \n", "one two", "ONE  two", "one two three", out[0], out[0], "Été a b c d e", "été a b c d e"]
    return out


@pytest.mark.parametrize(("stars", "tile"), [(3, 2048), (0, 16)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, stars, tile):
    monkeypatch.setattr(ngram_join, "STARS", stars)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    texts = near_copies(random.Random(5))
    df = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string").repartition(5)

    def shingled(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [shingled(t) for t in texts]
    expected = components(len(texts), lambda a, b: bool(sets[a] and sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df).collect()}
    assert got == {i * 3: (len(s), 3 * c) for i, (s, c) in enumerate(zip(sets, expected))}
    assert len(set(expected)) < len(texts) - 60


@pytest.mark.parametrize(("stars", "tile"), [(3, 2048), (0, 16)])
def test_ngram_join_of_unlike_sizes_equals_brute_force(spark, monkeypatch, stars, tile):
    """Copies with words added or cut at the end, in groups below and above the length of a long column."""
    monkeypatch.setattr(ngram_join, "STARS", stars)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rng = random.Random(17)
    texts = []
    for members in [2] * 12 + [4] * 8 + [10] * 4 + [ngram_join.LONG + 8] * 2:
        base = rng.choices(WORDS, k=rng.randint(60, 160))
        texts.append(" ".join(base))
        for _ in range(members - 1):
            n = round(len(base) * rng.choice([0.1, 0.15, 0.2, 0.24]))
            texts.append(" ".join(base + rng.choices(WORDS, k=n) if rng.random() < 0.5 else base[: len(base) - round(0.8 * n)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    expected = components(len(texts), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(df).collect()} == dict(enumerate(expected))


def test_ngram_join_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_classes(empty).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "x " * 3000)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df).collect()), key=repr)
    assert got == sorted([(None, 2, None), (4, 2, None), (4, 2, None), (9, 1, 9)], key=repr)


def distance(a, b):
    """Edit distance, a row of the table at a time."""
    y, row = np.array([ord(c) for c in b], np.int64), np.arange(len(b) + 1)
    at = np.arange(len(b) + 1)
    for i, c in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (y != ord(c)))
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def alike(a, b):
    """Edit similarity of 0.8 or more."""
    m = max(len(a), len(b))
    return 5 * abs(len(a) - len(b)) <= m and 5 * distance(a, b) <= m


def normalised(line):
    return " ".join(x for x in re.split(r"[ \t\r\x0b\x0c]+", line.lower()) if x)


def python_line_dedup(docs):
    """(doc_id, text) -> kept text, by the edit similarity of all pairs of distinct normalised lines, and no other test."""
    seen = {}
    for d, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            if normalised(line):
                seen.setdefault(normalised(line), []).append((d, i))
    norms = list(seen)
    group = dict(zip(norms, components(len(norms), lambda a, b: alike(norms[a], norms[b]))))
    keep = {}
    for x, g in group.items():
        keep[g] = min(keep.get(g, min(seen[x])), min(seen[x]))
    out = {}
    for d, text in docs:
        kept = [line for i, line in enumerate((text or "").split("\n")) if not normalised(line) or keep[group[normalised(line)]] == (d, i)]
        out[d] = None if text is None else "\n".join(kept)
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(11)
    pool = [" ".join(rng.choices(WORDS, k=rng.randint(3, 60))) for _ in range(50)]
    long = " ".join(rng.choices(WORDS, k=2500))

    def line():
        x = rng.choice(pool)
        if rng.random() < 0.4:
            w = x.split(" ")
            w[rng.randrange(len(w))] += rng.choice(["", "!", "x", ", y"])
            x = " ".join(w)
        return x.upper() if rng.random() < 0.1 else x

    docs = [(i, "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(70)]
    # variants of one line: a bucket with more hashes than are compared at first
    many = rng.choices(WORDS, k=80)
    for i in range(40):
        own = list(many)
        own[rng.randrange(80)] = rng.choice(WORDS)
        docs.append((100 + i, " ".join(own)))
    docs += [(200, None), (201, ""), (202, "\n\n \t \n"), (203, long), (204, "x " + long + "\ntail"), (205, long), (206, "  \n" + pool[0])]
    df = spark.createDataFrame([(d, t, 1, "a") for d, t in docs], "doc_id long, text string, h int, removed string").repartition(3)
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "h", "removed", "n_removed"]
    expected = python_line_dedup(docs)
    assert {r.doc_id: r.text for r in out.collect()} == expected
    assert sum(len(t or "") for _, t in docs) > 1.3 * sum(len(t or "") for t in expected.values())


def test_line_dedup_recall(spark):
    """Links found, of all with an edit similarity of 0.8 or more, by length of lines: one letter changed, and up to 5, 10 and 20 % of the words."""
    rng = random.Random(23)
    voc = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(5000)]
    lines, wanted = [], []
    for words in (3, 5, 8, 12, 20, 40, 80, 150):
        for share in (0, 0.05, 0.1, 0.2):
            for _ in range(30):
                w = rng.choices(voc, k=words)
                x = " ".join(w)
                if share:
                    for i in rng.sample(range(words), max(1, int(words * share))):
                        w[i] = rng.choice(voc)
                    y = " ".join(w)
                else:
                    i = rng.choice([i for i, c in enumerate(x) if c != " "])
                    y = x[:i] + "q" + x[i + 1 :]
                if x != y and alike(x, y):
                    wanted.append((words, share, len(lines), len(lines) + 1))
                    lines += [x, y]
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    gone = {r.doc_id for r in out.collect() if r.n_removed}
    assert gone <= {b for *_, b in wanted}  # unlike lines stay
    found = lambda test: np.mean([b in gone for words, share, _, b in wanted if test(words, share)])
    assert found(lambda w, s: True) >= 0.95
    assert all(found(lambda w, s: w == words) >= 0.9 for words in (5, 8, 12, 20, 40, 80, 150))
    assert found(lambda w, s: s == 0) >= 0.95 and found(lambda w, s: s == 0.1) >= 0.95
    assert found(lambda w, s: s == 0.2) >= 0.75  # at the very edge of similarity


def test_line_dedup_wide_buckets(spark, monkeypatch):
    """Buckets that are told apart beforehand give the same result; a group of many variants is one."""
    rng = random.Random(4)
    base = rng.choices(WORDS, k=40)
    texts = []
    for i in range(120):
        own = list(base)
        own[rng.randrange(40)] = rng.choice(WORDS)
        texts.append(" ".join(own))
    texts += [" ".join(rng.choices(WORDS, k=12) + base[:14]) for _ in range(60)]  # a passage they share, no more
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = python_line_dedup(list(enumerate(texts)))
    monkeypatch.setattr(line_dedup, "SAMPLED", 1)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == want
    monkeypatch.setattr(line_dedup, "SAMPLED", 1 << 40)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == want


def test_line_dedup_long_lines(spark):
    """Lines far beyond any window, with a passage put in early, are found; so are lines without a blank."""
    rng = random.Random(6)
    long = rng.choices(WORDS, k=4000)
    more = long[:3] + rng.choices(WORDS, k=50) + long[3:]
    solid = "".join(rng.choices("abcdef0123456789", k=6000))
    texts = [" ".join(long), " ".join(more), solid, "x" + solid[:3000] + solid[3010:], " ".join(rng.choices(WORDS, k=4000))]
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in out.collect()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0}


def test_line_dedup_leaves_no_tables(spark):
    """After a call only what its result reads is left of the intermediate tables."""
    import gc

    from strataloom import store

    before = set(store._made)
    df = spark.createDataFrame([(i, f"a b c d e f g h {i % 3}") for i in range(30)], "doc_id long, text string")
    out = line_dedup.dedup_lines(df)
    assert out.filter("n_removed > 0").count() == 29
    gc.collect()
    assert len(set(store._made) - before) <= 1


def test_line_dedup_without_punctuation(spark):
    """The registered query's lines are equal if they differ in ASCII punctuation only; lines of nothing else stay."""
    docs = [(1, "Hello, world.\n---"), (2, "hello world\n---"), (3, "(Hello) -- 'world'!\n* * *"), (4, "a_b c\n***"), (5, "A B C"), (6, "hello w\u00f6rld\n\u2014")]
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), line_dedup.PUNCT)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Hello, world.\n---", 2: "---", 3: "* * *", 4: "a_b c\n***", 5: "", 6: "hello w\u00f6rld\n\u2014"}


def test_query_of_lines_ignores_punctuation(spark, tmp_path):
    from strataloom.llm.queries import op1_line_dedup

    spark.createDataFrame([(1, "Hello, world."), (2, "hello world"), (3, "...")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_removed for r in op1_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 1, 3: 0}


def test_line_dedup_odd_tables(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, "a  B")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in line_dedup.dedup_lines(df).collect()) == [("1", ""), ("1", ""), ("2", ""), ("None", "a b")]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(50)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)] + [(5, 5)]
    nodes = sorted({x for a, b in pairs if a != b for x in (a, b)})
    at = {x: i for i, x in enumerate(nodes)}
    linked = {(max(at[a], at[b]), min(at[a], at[b])) for a, b in pairs if a != b}
    expected = components(len(nodes), lambda a, b: (a, b) in linked)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: nodes[c] for x, c in zip(nodes, expected)}


def test_unsettled_rounds_are_an_error(spark):
    from strataloom.operators.dedup import greedy_keep

    chain = spark.createDataFrame([(i, i + 1) for i in range(8)], "a long, b long")
    with pytest.raises(RuntimeError):
        greedy_keep(chain, rounds=2)
    with pytest.raises(RuntimeError):
        connected_components(chain, rounds=1)
    assert {(r.item, r["into"]) for r in greedy_keep(chain).collect()} == {(1, 0), (3, 2), (5, 4), (7, 6)}


def test_only_functions_on_the_main_path(spark, sf):
    plan = line_dedup.dedup_lines(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").withColumn("z", F.lit(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("cell", [512, 4])
def test_line_dedup_pairs_beside_unlike_leaders(spark, monkeypatch, cell):
    """Unlike lines share a passage, and so every bucket; each has one that is alike, which neither leader of a bucket is to most of them."""
    rng = random.Random(3)
    monkeypatch.setattr(line_dedup, "CELL", cell)
    passage = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(16))
    docs = []
    for i in range(20):
        own = ["".join(rng.choices("klmnopqrstuvwxyz", k=4)) for _ in range(60)]
        docs += [(2 * i, f"{passage} {' '.join(own)}"), (2 * i + 1, f"{passage} {' '.join(w[:1] + '0' + w[2:] for w in own)}")]
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id for r in out if r.n_removed} == {2 * i + 1 for i in range(20)}


def test_line_dedup_pairs_of_a_wide_bucket(spark, monkeypatch):
    """Lines that share a passage, and so every bucket, may be alike: no step compares a pair twice, and no link is lost."""
    rng = random.Random(8)
    passage = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(16))
    texts = [f"{passage} {' '.join(''.join(rng.choices('klmnopqrstuvwxyz', k=4)) for _ in range(11))}" for _ in range(70)]
    seen, compared = [], line_dedup.compared

    def counted(both, *args, **kwargs):
        seen.append(both.count())
        return compared(both, *args, **kwargs)

    monkeypatch.setattr(line_dedup, "compared", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == python_line_dedup(list(enumerate(texts)))
    assert max(seen) <= 70 * 69 // 2


def test_line_dedup_unlike_lines_of_frequent_short_words(spark):
    """Lines that share short frequent words alone, in any order, share hardly a bucket; near copies of such lines do."""
    rng = random.Random(12)
    short = ["the", "of", "and", "to", "in", "a", "is", "that", "was", "as", "on", "or", "are", "an"]
    long = lambda: "".join(rng.choices("bcdfghjklmnp", k=8))
    lines = [[long() if rng.random() < 0.25 else rng.choice(short) for _ in range(20)] for _ in range(400)]
    near = [w[:9] + [long()] + w[10:] for w in lines[:100]]
    rows = spark.createDataFrame([(i, 0, " ".join(w)) for i, w in enumerate(lines + near)], "key long, th long, text string")
    units = {r.key: set(r.blocks) for r in line_dedup.hashed_units(rows).select("key", "blocks").collect()}
    met = sum(bool(units[a] & units[b]) for a in range(400) for b in range(a))
    assert met < 400
    assert sum(bool(units[i] & units[400 + i]) for i in range(100)) >= 99


def test_line_dedup_a_common_line_is_one_node(spark, monkeypatch):
    """Buckets are made of different lines: one that is repeated is not in them once a row."""
    seen, shared = [], line_dedup._shared_buckets

    def counted(nodes):
        seen.append(nodes.count())
        return shared(nodes)

    monkeypatch.setattr(line_dedup, "_shared_buckets", counted)
    df = spark.createDataFrame([(i, f"one line that all documents have\nits own {i}") for i in range(300)], "doc_id long, text string")
    assert line_dedup.dedup_lines(df).agg(F.sum("n_removed")).first()[0] >= 299
    assert seen == [301]


def test_line_dedup_texts_travel_in_rounds(spark, monkeypatch):
    """However many pairs there are, texts are on their way with a bounded number at a time; no link is lost."""
    rng = random.Random(8)
    passage = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(16))
    texts = [f"{passage} {' '.join(''.join(rng.choices('klmnopqrstuvwxyz', k=4)) for _ in range(11))}" for _ in range(70)]
    seen, compared = [], line_dedup.compared

    def counted(both, *args, **kwargs):
        seen.append(both.count())
        return compared(both, *args, **kwargs)

    monkeypatch.setattr(line_dedup, "compared", counted)
    monkeypatch.setattr(line_dedup, "AT_ONCE", 64, raising=False)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == python_line_dedup(list(enumerate(texts)))
    # rounds are made by hash, so one may hold somewhat more than its share
    assert max(seen) <= 2 * 64 * 4


def test_line_dedup_blocks_go_when_buckets_are_made(spark, monkeypatch):
    """While pairs are compared, no table with blocks is on disk: they are most of what lines take."""
    from strataloom import store

    seen, compared = [], line_dedup.compared

    def listed(both, *args, **kwargs):
        seen.extend(u.rsplit("/", 1)[1].split("-")[0] for u in store._made)
        return compared(both, *args, **kwargs)

    monkeypatch.setattr(line_dedup, "compared", listed)
    df = spark.createDataFrame([(i, f"a line of which near copies are made number {i}\nits own {i}") for i in range(30)], "doc_id long, text string")
    before = {u.rsplit("/", 1)[1].split("-")[0] for u in store._made}
    line_dedup.dedup_lines(df).count()
    assert seen and not {"units", "nodes"} & (set(seen) - before)


def test_pipeline_keeps_one_stage_on_disk(spark, sf, monkeypatch):
    """A stage's table goes when the next one's is written; the first stage's input stays."""
    import corpus_pipeline
    from strataloom import store

    kept = lambda spark, docs, sf_dir: docs.filter("doc_id >= 0")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", kept), ("two", kept), ("three", kept), ("last", kept)])
    before = set(store._made)
    out = corpus_pipeline.run(spark, sf)
    left = set(store._made) - before
    assert len(left) == 1 and out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    for u in left:
        store._delete(u)
