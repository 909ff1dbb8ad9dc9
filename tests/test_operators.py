"""Operators by example and against sequential versions."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.functions import html, text
from strataloom.operators import chunking, classify, dedup, faq, relational
from strataloom.plans import medallion
from strataloom.sources import files


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path_factory):
    dedup.session_checkpoint_dir(spark, str(tmp_path_factory.getbasetemp() / "checkpoints"))


def test_chunk_context_and_table(spark):
    docs = [("d", "# A\n## B\nnội dung đủ dài để thành một đoạn văn bản hoàn chỉnh"), ("t", "# T\n" + "| a | b |\n|---|---|\n| 1 | 2 |\n" + "| 3 | 4 |" * 60)]
    rows = {r.doc_id: r for r in chunking.chunks(spark.createDataFrame(docs, "doc_id string, markdown string"), size=300).collect()}
    assert len(rows) == 2 and rows["d"].heading_context == "A > B" and rows["d"].content.startswith("[A > B]\n")


def plain_sections(markdown):
    """Line by line: a stack of headings, a fence, an open block."""
    import re

    out, stack, block, fenced, n = [], [], [], False, 0

    def end():
        if (t := "\n".join(block).strip()):
            out.append((n, [h for _, h in stack], t))
        block.clear()

    for line in markdown.split("\n"):
        t = line.strip()
        if t.startswith("```") or fenced:
            fenced ^= t.startswith("```")
            block.append(line)
            continue
        m = re.match(r"^(#{1,6})\s+(.+)$", t)
        legal = not m and len(t) < 80 and re.match(r"^(Chương\s+[IVXLCDM\d]+.*|Điều\s+\d+.*|Mục\s+\d+.*)$", t, re.I)
        if not m and not legal:
            block.append(line)
            continue
        end()
        n += 1
        level, title = (len(m[1]), m[2].strip()) if m else (2 if t.lower().startswith("chương") else 3, t)
        stack[:] = [h for h in stack if h[0] < level] + [(level, title)]
    end()
    return out


def test_sections_equal_a_loop(spark):
    rng = random.Random(9)
    lines = ["# A", "## B  c", "### ", "####### seven", "#none", "###### Six #", "```", "  ```py", "text", "", "  more text ", "Chương IV Chung", "điều 12. Phạm vi", "Điều x", "Mục 3" + " dài" * 30, "  Mục 2\tb", "\x01\x03 odd \x01", "| a | b |", "\u3000# wide", "a # b", "text ```"]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 25))) for _ in range(400)] + ["```\n" + "x\n" * 30_000 + "# in\n```\n# out\ny", "\n".join(f"{'#' * (i % 6 + 1)} h{i}\nbody {i}" for i in range(3000)), "x" * 300_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {}
    for r in chunking.sections(spark.createDataFrame([*rows, (-1, None)], "doc_id long, markdown string").repartition(4)).collect():
        got.setdefault(r.doc_id, []).append((r.section, list(r.heading_path), r.text))
    assert got == {i: s for i, t in rows if (s := plain_sections(t))}


def test_documents_of_one_name_are_chunked_apart_and_nothing_is_shuffled(spark, tmp_path):
    long = "câu này đủ dài để thành một đoạn văn bản hoàn chỉnh. " * 3
    rows = [("d", f"# A\n{long}", 1), ("d", f"# B\n{long}", 2), (None, f"# C\n{long}", 3), (None, f"{long}\n# D\n{long}", 4)]
    spark.createDataFrame(rows, "doc_id string, markdown string, ord int").write.parquet(str(tmp_path / "docs"))
    out = chunking.chunks(spark.read.parquet(str(tmp_path / "docs")), size=1000, keep=("ord",))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.ord, r.chunk_index, r.heading_context, str(r.doc_id)) for r in out.collect())
    assert got == [(1, 0, "A", "d"), (2, 0, "B", "d"), (3, 0, "C", "None"), (4, 0, "", "None"), (4, 1, "D", "None")]


def test_found_keywords_equal_contains(spark):
    from strataloom.functions import fixed
    from strataloom.functions import text as T

    rng = random.Random(4)
    for words in ([w for ws in fixed.TOPICS.values() for w in ws], ["ab", "abc", "b", "bca", "$$$", "|", "a|b", "(?", "ab", "x.y", "😀", "😀😀"]):
        bits = [*words, *"abcxy.$|(?", "😀", " "]
        texts = ["".join(rng.choices(bits, k=rng.randint(0, 8))) for _ in range(300)] + [None, "", "a" * 100_000 + words[0]]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r.i: r.f for r in df.select("i", T.found_keywords(F.col("t"), words).alias("f")).collect()}
        assert got == {i: None if t is None else [k for k, w in enumerate(words) if w in t] for i, t in enumerate(texts)}
    assert df.select(T.found_keywords(F.col("t"), []).alias("f")).first().f == []


def python_pack(sentences, size, overlap, least):
    out, cur, n = [], [], 0

    def emit():
        joined = " ".join(cur).strip()
        if len(joined) >= least:
            out.append(joined)

    for s in sentences:
        if cur and n + len(s) > size:
            emit()
            keep, total = 0, 0
            while keep < len(cur) and total + len(cur[-1 - keep]) <= overlap:
                total += len(cur[-1 - keep])
                keep += 1
            cur, n = cur[len(cur) - keep:], total
        cur.append(s)
        n += len(s)
    if cur:
        emit()
    return out


def test_pack_equals_a_loop(spark):
    rng = random.Random(2)
    values = [["x" * rng.randint(1, 60) for _ in range(rng.randint(0, 20))] for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s array<string>")
    got = [r.p for r in df.select("i", chunking.pack(F.col("s"), 80, 30, 20).alias("p")).orderBy("i").collect()]
    assert got == [python_pack(v, 80, 30, 20) for v in values]


def test_gold_rules(spark):
    rows = [("a", ["Nghi dinh 100 2019 NDCP"], "x"), ("Điều 9. Vượt xe: khi vượt xe phải có tín hiệu", ["Luật"], "x"), ("Giá xe lăn bánh và lệ phí trước bạ", ["Giá"], "thu_tuc_phap_ly")]
    df = spark.createDataFrame(rows, "content string, heading_path array<string>, category string")
    a, b, c = (r.v for r in df.select(classify.chunk_verdict(F.col("content"), F.col("heading_path"), F.col("category")).alias("v")).collect())
    assert not a.admitted and a.reason.startswith("Excluded") and not b.admitted and c.admitted and c.topic == "bao_gia_chi_phi" and c.score >= 0.8


def test_exact_and_near_duplicates(spark):
    t = "một hai ba bốn năm sáu bảy tám chín mười mười một mười hai mười ba"
    rows = [(0, "d1", ["a"], t, t, 0.8, "k"), (1, "d2", ["a", "b", "c"], "- " + t, "- " + t, 0.9, "k"), (2, "d3", ["a"], t + " thêm", t + " thêm", 0.5, "k"), (3, "d4", ["a"], "hoàn toàn khác hẳn so với những câu ở trên kia", "hoàn toàn khác hẳn so với những câu ở trên kia", 0.5, "k")]
    c = spark.createDataFrame(rows, "ord long, doc_id string, heading_path array<string>, content string, raw_chunk_text string, consultation_score double, topic string")
    e = dedup.exact_chunks(c)
    first = {r.ord: r for r in e.collect()}
    assert len(first) == 3 and first[0].doc_id == "d2" and first[0].duplicate_doc_sources == ["d1", "d2"] and first[0].duplicate_count == 1
    out = {r.ord: r for r in dedup.near_chunks(e, 0.85).collect()}
    assert set(out) == {0, 3} and out[0].duplicate_doc_sources == ["d1", "d2", "d3"] and out[0].near_duplicate_merged == 1


def test_greedy_equals_a_loop(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(words[:6] if i % 2 else words, k=rng.randint(7, 9))) for i in range(120)]
    texts += [t + " end" for t in texts[:40]]
    sets = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    kept, into = [], {}
    for i, s in enumerate(sets):
        hit = next((k for k in kept if len(s) >= 5 and len(sets[k]) >= 5 and min(len(s), len(sets[k])) / max(len(s), len(sets[k])) >= 0.8 and len(s & sets[k]) / len(s | sets[k]) >= 0.5), None)
        if hit is None:
            kept.append(i)
        else:
            into[i] = hit
    items = spark.createDataFrame([(i, "t", t) for i, t in enumerate(texts)], "item long, topic string, text string")
    got = {r.item: r["into"] for r in dedup.greedy_keep(dedup.similar_pairs(items, 0.5)).collect()}
    assert got == into and into


@pytest.mark.parametrize("bound", [1_000_000, 3_000, 40])
def test_greedy_of_long_chains_and_of_every_size(spark, bound):
    """Paths of 10,000 edges (as one, and as pieces that each fit), trees, hubs and random graphs, by struct items too."""
    rng = random.Random(bound)
    cut = 10_001 if bound > 10_000 else 2_500
    edges = {(i, i + 1) for i in range(10_000) if (i + 1) % cut} if bound > 40 else set()
    edges |= {(20_000 + rng.randrange(i), 20_000 + i) for i in range(1, 60)} | {(30_000, 30_000 + i) for i in range(1, 50)}
    edges |= {tuple(sorted(rng.sample(range(40_000, 40_080), 2))) for _ in range(200 if bound != 3_000 else 3_100)}
    edges = sorted(edges)
    earlier, gone, want = {}, set(), {}
    for a, b in edges:
        earlier.setdefault(b, []).append(a)
    for b in sorted(earlier):
        kept = [a for a in earlier[b] if a not in gone]
        if kept:
            gone.add(b)
            want[b] = min(kept)
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    assert {r.item: r["into"] for r in dedup.greedy_keep(df, bound=bound).collect()} == want
    if bound == 3_000:
        twin = lambda c: F.struct(F.floor(F.col(c) / 100).alias("doc"), (F.col(c) % 100).alias("index")).alias(c)
        got = dedup.greedy_keep(df.select(twin("a"), twin("b")), bound=1_000_000).collect()
        assert {r.item.doc * 100 + r.item["index"]: r["into"].doc * 100 + r["into"]["index"] for r in got} == want
    assert dedup.greedy_keep(df.limit(0)).count() == 0


def test_faq(spark):
    page = '<h2 class="cat-name">Pin</h2><h3 class="child-name x">Thuê</h3><div class="post"><h2 class="post-title">Hỏi <b>A1</b>?</h2><div class="post-content"><p>Đáp <b>một</b></p></div></div><div class="post"><h2 class="post-title">Không đáp</h2></div>'
    first = '<div class="post"><h2 class="post-title">Đầu</h2><div class="post-content">x</div></div>'
    items = faq.items(spark.createDataFrame([(1, first + page)], "page int, html string"), ["A1"], "Chung")
    a, b = sorted(items.collect(), key=lambda r: r.pos)
    assert (a.category, a.subcategory, b.category, b.subcategory) == ("Chung", "Hỏi đáp chung", "Pin", "Thuê")
    assert b.vehicle_tags == ["A1"] and b.answer == "Đáp một" and b.answer_markdown == "Đáp **một**"
    assert faq.documents(items).count() == 2


def test_article():
    h = "<body><nav><p>menu menu menu menu menu</p></nav><article><h1>Một tiêu đề đủ dài cho bài</h1><p>ngắn</p><li>mục danh sách đủ dài để giữ lại</li></article></body>"
    assert html.article(h) == "Một tiêu đề đủ dài cho bài\n\nmục danh sách đủ dài để giữ lại"


def test_relational(spark, tmp_path):
    snap = {
        "vehicles": {"cars": {"models": [{"id": "Products-Car-A", "name": "A", "defaultProductID": "p"}], "Products-Car-A": {"listEdition": ["e1", "e2"], "e1": {"label": "Eco", "price": "5 đ", "priceValue": 5}}}, "bikes": {"models": [{"id": "B", "name": "Bee"}]}},
        "objects": {"costs": [{"model": "Products-Car-A", "ID": "t1", "price": 1_200_000_000, "UUID": "u", "isBatterySales": True}, {"model": "Products-Car-X", "ID": "t2", "price": 0, "basePrice": "7e8"}, {"model": "B", "ID": "t3", "price": "x"}], "provinces": [{"name": "Hà Nội"}], "fees": [{"zone": "KV1"}, {"zone": "KV2", "carLicenseFee": 1}]},
    }
    path = tmp_path / "s.json"
    path.write_text(json.dumps(snap))
    s = relational.snapshot(spark, str(path))
    t = relational.tables(s, "maker")
    assert t["cars_catalog"].count() == 2 and t["fee_rules"].count() == 6 and t["provinces"].first().region_code == "2"
    trims = {r.trim_name: r for r in t["trims_pricing"].collect()}
    assert (trims["t1"].price_vat_vnd, trims["t1"].deposit_amount_vnd, trims["t1"].trim_id) == (1_200_000_000, 50_000_000, "Products-Car-A_u")
    assert (trims["t2"].car_name, trims["t2"].price_vat_vnd, trims["t3"].price_vat_vnd) == ("X", 700_000_000, 0)
    m = t["rolling_cost_matrix"].collect()
    assert len(m) == 12 and all(r.total_rolling_cost_vnd == r.list_price_vnd + r.license_plate_fee_vnd + 340_000 + 1_560_000 + 480_700 for r in m)
    v = {r.vehicle_id: r for r in relational.vehicles(s).collect()}
    assert [x.label for x in v["Products-Car-A"].trims] == ["Eco", "e2"] and v["Products-Car-A"].rolling_costs["KV2"].license_plate_fee == 1 and "| Eco | 5 đ | 5 đ |" in v["Products-Car-A"].searchable_markdown


def test_url_rules(spark):
    rows = [("Xe máy mới", "https://a.vn/x", "k"), ("", "https://a.vn/x", "k"), ("Giá", "https://a.vn/x", "gia_ca_lan_banh"), ("Luật", "https://a.vn/luat-36", "k"), ("Thông số", "https://official.vn/x", "thong_so_ky_thuat"), ("Thông số", "https://b.vn/x", "thong_so_ky_thuat"), ("Tin", "https://b.vn/x", "k")]
    df = spark.createDataFrame(rows, "t string, u string, c string")
    assert [r[0] for r in df.select(classify.url_is_valid(F.col("t"), F.col("u"), F.col("c"), "official")).collect()] == [False, False, False, False, True, False, True]


def test_sources(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("﻿Title,url,Category\nA,http://a,\n,http://b,x\n".encode())
    assert [tuple(r) for r in files.read_sources_csv(spark, str(tmp_path / "s.csv")).collect()] == [("A", "http://a", "trai_nghiem_danh_gia")]
    (tmp_path / "m.json").write_text(json.dumps([{"title": "T", "file": "a.html"}, {"title": "", "file": "zz.html"}]))
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a.html").write_text("<article><p>một đoạn văn bản đủ dài để được giữ lại</p></article>")
    m = files.read_json_array(spark, str(tmp_path / "m.json"), files.MANIFEST)
    b = files.bronze_articles(m, files.read_pages(spark, str(tmp_path / "pages")), "general", "d.vn").collect()
    assert len(b) == 1 and b[0].raw_content.startswith("# T\n\nmột") and b[0].raw_id == "html_d.vn_a.html"
    assert files.read_json_array(spark, str(tmp_path / "none.json"), files.MANIFEST).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_jsonl(spark, str(tmp_path / "none"), "a int", required=True)
    files.write_report(spark, {"n": 1, "t": "ê"}, str(tmp_path / "r.json"))
    assert files.read_report(spark, str(tmp_path / "r.json")) == {"n": 1, "t": "ê"}
    t = spark.createDataFrame([("Thong-Bao_chinh sach 2x",)], "s string")
    assert t.select(files.titled(F.col("s"))).first()[0] == "Thong-Bao_chinh sach 2x".replace("_", " ").title()


def test_medallion_end_to_end(spark):
    body = "Giá xe niêm yết và chi phí lăn bánh được công bố. " * 8
    rows = [(0, "a", "faq", "T", None, "faq", None, "# Giá\n" + body), (1, "b", "faq", "T", None, "faq", None, "# Giá\n" + body), (2, "c", "pdf", "U", None, "", None, "ngắn"), (3, "d", "pdf", "V", None, "k", None, "# Khác\n" + "không có gì liên quan ở đây cả nhé các bạn ơi. " * 8)]
    bronze = spark.createDataFrame(rows, "ord long, raw_id string, source_type string, title string, url string, category string, domain string, raw_content string")
    flagged = medallion.cleaned(bronze)
    docs = medallion.silver_documents(flagged)
    assert sorted(r.source_id for r in docs.collect()) == ["a", "d"]
    chunks = medallion.silver_chunks(docs)
    judged = medallion.verdicts(chunks)
    gold = medallion.gold_chunks(judged)
    assert {r.topic for r in gold.collect()} == {"bao_gia_chi_phi"}
    assert [r.source_id for r in medallion.gold_documents(docs, gold).collect()] == ["a"]


def test_stream(spark, tmp_path):
    from strataloom.streaming.ingest import run_available, silver_stream

    schema = "ord long, raw_content string, arrived timestamp"
    row = spark.createDataFrame([(1, "văn bản đủ dài để được giữ lại trong bảng bạc này, kể cả khi chạy lại"), (2, "văn bản đủ dài để được giữ lại trong bảng bạc này, kể cả khi chạy lại")], "ord long, raw_content string").withColumn("arrived", F.current_timestamp())
    row.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        run_available(silver_stream(spark, str(tmp_path / "in"), schema, medallion.Config(compose=False)), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_chunk_sizes_of_whole_texts_equal_brute_force(spark, tmp_path):
    from strataloom.plans.queries import chunk_sizes as chunk_sizes_whole

    tail = "what comes after the second full stop is kept as well, to the last word"
    docs = [(1, "s", f"one. two. three. {tail}."), (2, "t", f"a line. b. c.\nsecond line of it. {tail}\n## Part\nd. e. f. {tail}\n### Deep\ntoo short\n## Next\n{tail} g. h."), (3, "u", None), (4, "v", "short. one. here")]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = set()
    for d, source, t in docs:
        path, parts = {1: source}, [([source], [])]
        for line in (t or "").split("\n"):
            marks = len(line) - len(line.lstrip("#"))
            if marks:
                path = {k: v for k, v in path.items() if k < marks} | {marks: line[marks:].strip()}
                parts.append(([path[k] for k in sorted(path)], []))
            else:
                parts[-1][1].append(line)
        bodies = [(" > ".join(p), "\n".join(b).strip()) for p, b in parts if len("\n".join(b).strip()) >= 40]
        for i, (p, b) in enumerate(bodies):
            content = f"[{p}]\n{b}"
            expected.add((f"{d}_{i}", p, content, len(content.split()), len(content)))
    assert {tuple(r) for r in chunk_sizes_whole(spark, str(tmp_path)).collect()} == expected
    assert len(expected) == 4


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 0.9, 1.0])
def test_sets_that_meet_by_chance_are_not_fetched(spark, threshold):
    """All similar pairs are candidates, and unlike ones that share a rare shingle or two are none."""
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"{i}w{j}" for j in range(300)], k=rng.randint(70, 74))) + f" mate{i // 2}a mate{i // 2}b mate{i // 2}c" for i in range(90)]
    for i in range(60):
        w = texts[i].split()
        for _ in range(rng.randint(1, 12)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
        texts.append(" ".join(w))
    sets = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    value = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in range(len(sets)) for i in range(j)}
    alike = {p for p, v in value.items() if v >= threshold and min(len(sets[x]) for x in p) >= max(threshold, 0.8) * max(len(sets[x]) for x in p)}
    items = spark.createDataFrame([(i, "t", t) for i, t in enumerate(texts)], "item long, topic string, text string")
    assert {(r.a, r.b) for r in dedup.similar_pairs(items, threshold).collect()} == alike
    shingled = items.select("item", "topic", F.transform(text.shingles(F.col("text")), lambda x: F.xxhash64(x)).alias("s"))
    found = {(r.a, r.b) for r in dedup._candidates(shingled, threshold, max(threshold, 0.8)).collect()}
    # before, every pair that shares a shingle of its prefixes was one
    assert alike <= found and all(value[p] > 0.1 for p in found)


@pytest.mark.parametrize(("met", "cells"), [(1 << 21, 1 << 23), (1, 1), (50, 40), (100, 1 << 23), (1 << 21, 1)])
def test_pairs_counted_in_parts(monkeypatch, met, cells):
    """However few pairs and cells a task holds at a time, all similar pairs come once, of one chunk and of two."""
    from strataloom.operators import similar

    rng = random.Random(met + cells)
    monkeypatch.setattr(similar, "MET", met)
    monkeypatch.setattr(similar, "CELLS", cells)
    for trial in range(40):
        some, words = [], rng.choice([20, 100, 2000])
        for _ in range(rng.randint(1, 50)):
            s = set(rng.choice(some)) if some and rng.random() < 0.5 else {rng.randrange(words) for _ in range(rng.randint(1, 30))}
            some.append(s | {rng.randrange(words) for _ in range(rng.randint(0, 3))})
        first, t = rng.choice([len(some), rng.randint(1, len(some))]), (1e-9, 0.3, 0.5, 0.9, 1.0)[trial % 5]
        r = max(0.8, t)
        pairs = [(a, b) for a in range(first) for b in range(first if first < len(some) else a + 1, len(some))]
        pairs = [(a, b) for a, b in pairs if min(len(some[a]), len(some[b])) >= r * max(len(some[a]), len(some[b])) - 1e-9]
        want = {(a, b): len(some[a] & some[b]) / len(some[a] | some[b]) for a, b in pairs}
        n, h = np.array([len(s) for s in some]), np.array([x * 7919 - 5000 for s in some for x in rng.sample(sorted(s), len(s))])
        got = [p for part in similar.alike(n, h, first, t, r, t) for p in zip(*(x.tolist() for x in part))]
        assert len({p[:2] for p in got}) == len(got) and {p[:2]: p[2] for p in got} == {p: v for p, v in want.items() if v >= t}


@pytest.mark.parametrize(("chunk", "sets"), [(1 << 21, 1 << 15), (200, 7), (100, 1 << 15)])
def test_sets_compared_chunk_by_chunk(spark, monkeypatch, chunk, sets):
    """Chunks of any size give all similar pairs once, with their Jaccard; other topics and null topics give none."""
    from strataloom.operators import similar

    rng = random.Random(15)
    monkeypatch.setattr(similar, "CHUNK", chunk)
    monkeypatch.setattr(similar, "SETS", sets)
    items = []
    for i in range(70):
        if items and rng.random() < 0.6:
            s = set(rng.choice(items)[2])
            s = set(rng.sample(sorted(s), max(1, len(s) - rng.randint(0, 5)))) | {rng.randrange(400) - 200 for _ in range(rng.randint(0, 5))}
        else:
            s = {rng.randrange(400) - 200 for _ in range(rng.randint(1, 60))}
        items.append((i, rng.choice(["a", "b", None]), sorted(s)))
    df = spark.createDataFrame(items, "item long, topic string, s array<long>").repartition(3)
    for t in (0.3, 0.5, 0.9):
        r, want = max(0.8, t), {}
        for a, p, x in items:
            for b, q, y in items:
                if a < b and p == q and p is not None and min(len(x), len(y)) >= r * max(len(x), len(y)) - 1e-9:
                    value = len(set(x) & set(y)) / len(set(x) | set(y))
                    if value >= t:
                        want[a, b] = value
        rows = similar.set_pairs(df, t, r, t).collect()
        assert len(rows) == len(want) and {(x.a, x.b): x.jaccard for x in rows} == want


def test_similar_pairs_leave_the_pairs_alone_on_disk(spark):
    """Neither shuffles of sets and of pairs that meet nor the sets are left when the pairs are there."""
    from strataloom import store

    items = spark.createDataFrame([(i, "t", f"a few words that all have and then {i % 7} of its own {i}") for i in range(60)], "item long, topic string, text string")
    before = set(store._made)
    pairs = dedup.similar_pairs(items, 0.5)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert [u.rsplit("/", 1)[1].split("-")[0] for u in set(store._made) - before] == ["similar"]
    assert pairs.count() > 60
    store.drop(pairs)
