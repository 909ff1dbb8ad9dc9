"""All sources from real files: the plan of file functions and the data source give one table."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from strataloom.sources import bronze, files
from tests.test_pdf import PAGES, classic, parts

LONG = "một đoạn văn bản đủ dài để được giữ lại trong tài liệu này"


@pytest.fixture
def layout(tmp_path):
    d = tmp_path / "in"
    for x in ("a/pages", "b/pages", "pdf/luat"):
        (d / x).mkdir(parents=True)
    page = lambda t: f"<html><nav><p>{LONG} bỏ</p></nav><article><h1>Đầu đề của trang số {t}</h1><p>{LONG} {t}</p></article></html>"
    for i in range(5):
        (d / f"a/pages/p{i}.html").write_text(page(i))
    (d / "a/pages/bytes.html").write_bytes(page(9).encode().replace(b"</p></article>", b"\xff\xfe</p></article>"))
    (d / "a/pages/empty.html").write_text("<p>x</p>")
    listed = [{"title": f"T{i}", "url": f"http://a/{i}", "category": "c1" if i % 2 else None, "domain": "a.vn", "file": f"p{i}.html", "bytes": 10 + i, "crawled_at": "2026-01-01"} for i in range(5)]
    listed += [{"title": "", "file": "bytes.html"}, {"title": "E", "file": "empty.html"}, {"title": "none"}, {"title": "gone", "file": "gone.html"}]
    (d / "a/manifest.json").write_text(json.dumps(listed[::-1]))
    (d / "b/pages/q.html").write_text(page("q"))
    (d / "b/manifest.json").write_text(json.dumps([{"title": "Q", "file": "q.html", "category": "c2"}]))
    post = lambda q, a: f'<div class="post"><h2 class="post-title">{q}</h2><div class="post-content"><p>{a} <b>đậm</b></p></div></div>'
    (d / "faq.html").write_text(post("Đầu?", "không") + '<h2 class="cat-name">Pin</h2><h3 class="child-name">Thuê</h3>' + post("Một?", "đáp") + post("Hai?", "đáp 2") + '<h3 class="child-name">Mua</h3>' + post("Ba?", "x") + '<h3 class="child-name">Thuê</h3>' + post("Bốn?", "y"))
    snap = {"vehicles": {"cars": {"models": [{"id": "A", "name": "VA"}, {"id": "N", "name": "None"}], "A": {"listEdition": ["e1", "e2"], "e1": {"label": "Eco", "price": "", "priceValue": 5_000_000}}}, "bikes": {"models": [{"id": "B", "name": "Bee"}]}}, "objects": {"provinces": [{"name": "Hà Nội"}, {}], "fees": [{"zone": "KV1"}]}}
    (d / "snap.json").write_text(json.dumps(snap))
    plain, streams = parts([PAGES[0] + [LONG, LONG], PAGES[1]])
    good = classic(plain | streams)
    (d / "pdf/luat/a.pdf").write_bytes(good)
    (d / "pdf/top_file.pdf").write_bytes(good)
    (d / "pdf/luat/bad.pdf").write_bytes(b"%PDF-1.4 nothing")
    (d / "pdf/m.json").write_text(json.dumps([{"title": "Luật", "category": "luat", "relative_path": "x/luat/a.pdf", "size_bytes": 3, "type": "t"}, {"title": "bad", "category": "luat", "relative_path": "bad.pdf"}, {"title": "", "relative_path": "y/top_file.pdf"}, {"title": "gone", "relative_path": "y/gone.pdf"}]))
    a = [bronze.Articles(f"{d}/a/manifest.json", f"{d}/a/pages", "d1", "dom.a"), bronze.Articles(f"{d}/b/manifest.json", f"{d}/b/pages", "d2", "dom.b"), bronze.Articles(f"{d}/none.json", f"{d}/none")]
    return bronze.Layout(a, f"{d}/faq.html", f"{d}/snap.json", f"{d}/pdf/m.json", f"{d}/pdf", "Hãng", "h.vn", "http://h.vn/faq", "http://h.vn/gia", ["Bee"])


def rows(df):
    return [r.asDict() for r in df.orderBy("ord").collect()]


def test_the_data_source_equals_the_plan(spark, layout):
    plan, source = rows(bronze.bronze_plan(spark, layout)), rows(bronze.read_bronze(spark, layout))
    assert [r["ord"] for r in plan] == [r["ord"] for r in source] and len({r["ord"] for r in plan}) == len(plan)
    for a, b in zip(plan, source):
        assert a == b
    assert [r["source_type"] for r in plan] == ["html_article"] * 7 + ["faq"] * 3 + ["relational_snapshot"] + ["pdf"] * 2
    assert [r["title"] for r in plan[:7]] == ["", "T4", "T3", "T2", "T1", "T0", "Q"]  # the manifest's order, then the next source
    assert [r["raw_metadata"]["total_questions"] for r in plan[7:10]] == ["1", "3", "1"]
    assert plan[1]["category"] == "d1" and plan[2]["category"] == "c1" and plan[12]["title"] == "Top File" and plan[12]["raw_id"] == "pdf_general_top_file.pdf"
    assert "## Chương I" in plan[11]["raw_content"] and "| Eco | 5,000,000 đ | 5,000,000 đ |" in plan[10]["raw_content"]
    assert files.BRONZE == ", ".join(f"{n} {t}" for n, t in bronze.read_bronze(spark, layout).dtypes).replace("bigint", "long")


@pytest.mark.parametrize("main", [True])
def test_main_content_in_both(spark, layout, main):
    from dataclasses import replace

    own = replace(layout, main=main)
    plan = rows(bronze.bronze_plan(spark, own))
    assert plan == rows(bronze.read_bronze(spark, own)) and "bỏ" not in plan[1]["raw_content"] and plan[1]["raw_content"].startswith("# ")


def test_filters_leave_files_out(spark, layout):
    df = bronze.read_bronze(spark, layout)
    plan = bronze.bronze_plan(spark, layout)
    for condition in ("category = 'c1'", "category IN ('d1', 'faq')", "source_type = 'pdf'", "source_type = 'pdf' AND category = 'luat'", "category = 'none'"):
        assert rows(df.filter(condition)) == rows(plan.filter(condition))
    reader = bronze.BronzeReader(layout, False, 2)
    from pyspark.sql.datasource import EqualTo, IsNotNull

    assert list(reader.pushFilters([EqualTo(("category",), "c1"), IsNotNull(("title",))])) == [IsNotNull(("title",))]
    assert [len(p.entries) for p in reader.partitions()] == [2]


def test_errors_are_rows(spark, layout, tmp_path):
    (tmp_path / "in/b/manifest.json").write_text('[{"file": ')
    (tmp_path / "in/snap.json").write_text("{")
    got = {(r.source_type, r.source_file.split("/")[-1]): r.reason for r in bronze.read_bronze(spark, layout, "errors").collect()}
    assert set(got) == {("html_article", "gone.html"), ("html_article", "manifest.json"), ("relational_snapshot", "snap.json"), ("pdf", "bad.pdf"), ("pdf", "gone.pdf")}
    assert got["html_article", "gone.html"] == "missing" and got["html_article", "manifest.json"].startswith("manifest: ")
    assert rows(bronze.read_bronze(spark, layout)) == rows(bronze.bronze_plan(spark, layout)) and bronze.read_bronze(spark, layout).count() == 11


def test_nothing_there(spark):
    assert bronze.read_bronze(spark, bronze.Layout()).count() == 0 and bronze.bronze_plan(spark, bronze.Layout()).count() == 0
    began = time.perf_counter()
    assert bronze.BronzeReader(bronze.Layout([bronze.Articles("/none", "/none")]), True, 8).partitions()[0].entries == []
    assert time.perf_counter() - began < 5 and bronze.read_bronze(spark, bronze.Layout(), "errors").agg(F.count("*")).first()[0] == 0
