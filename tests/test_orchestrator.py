"""Runs of all layers from files to files, and the command line."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from strataloom import cli, store
from strataloom.operators import crawl
from strataloom.plans import queries
from strataloom.plans.medallion import Config
from strataloom.plans.orchestrator import Orchestrator
from strataloom.sources import bronze as bronze_source
from strataloom.sources import files
from tests.test_bronze import layout  # noqa: F401


def test_layers_from_files_to_files(spark, sf, tmp_path, capsys):
    bronze = queries.bronze(spark, sf).withColumn("source_file", F.lit("f")).withColumn("raw_metadata", F.create_map(F.lit("a"), F.lit("b"))).withColumn("crawled_at", F.lit(None).cast("string"))
    shaped = bronze.selectExpr(*(f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in files.BRONZE.split(", ")))
    config = Config(topics=queries.TOPICS, core=queries.CORE)
    o = Orchestrator(spark, str(tmp_path), config)
    o.write_bronze([shaped.filter("ord % 2 = 0"), shaped.filter("ord % 2 = 1")])
    before = set(store._made)
    out = o.run_all()
    assert set(store._made) == before  # nothing is left of the intermediate tables
    assert out["silver"]["total_bronze_records"] == shaped.count() and out["gold"]["total_gold_chunks"] == o.read("gold", "chunks").count() > 0
    assert out["gold"]["total_silver_chunks"] == o.read("silver", "chunks").count()
    assert json.loads((tmp_path / "silver" / "silver_report.json").read_text())["total_silver_documents"] == o.read("silver", "documents").count()
    text = (tmp_path / "gold" / "README.md").read_text()
    assert text.startswith("# Gold") and "| total gold chunks |" in text and "## gold topic distribution" in text
    assert cli.main(["stats", "--root", str(tmp_path)], spark)["gold/chunks"]["rows"] == out["gold"]["total_gold_chunks"]
    got = cli.main(["sample", "--root", str(tmp_path), "--layer", "silver", "--table", "documents", "-n", "2"], spark)
    assert len(got) == 2 and got[0]["ord"] < got[1]["ord"]
    assert '"ord"' in capsys.readouterr().out
    again = cli.main(["silver", "--root", str(tmp_path), "--chunk-size", "64", "--overlap", "8", "--keep-duplicates"], spark)
    assert again["total_silver_documents"] >= out["silver"]["total_silver_documents"] and again["duplicates_filtered"] == 0


def test_runs_from_a_layout_with_all_tables_and_counters(spark, layout, tmp_path):
    """What the writes have seen equals counts over the written tables; side tables and errors are there; gold has cars only."""
    (tmp_path / "in/b/manifest.json").write_text("[{")
    (tmp_path / "layout.json").write_text(layout.options()["layout"])
    root = f"{tmp_path}/out"
    out = cli.main(["run", "--root", root, "--layout", f"{tmp_path}/layout.json"], spark)
    o = Orchestrator(spark, root, layout=layout)
    n = lambda *t: o.read(*t).count()
    s, g = out["silver"], out["gold"]
    assert out["bronze"]["total_bronze_records"] == n("bronze") == s["total_bronze_records"] == sum(s["source_distribution"].values()) == sum(s["category_distribution"].values())
    assert out["bronze"]["total_errors"] == n("bronze_audit", "errors") == 4 and s["errors"] == out["bronze"]["errors"] and s["errors"]["html_article: manifest"] == 1
    flagged = n("bronze") - s["low_quality_filtered"] - s["duplicates_filtered"]
    assert s["total_silver_documents"] == flagged == n("silver", "documents") and s["total_silver_chunks"] == n("silver", "chunks") and s["language_distribution"] == {"vi": flagged}
    assert (s["total_faq_items"], s["total_vehicles"]) == (n("silver", "faq"), n("silver", "vehicles")) == (5, 3)
    assert round(o.read("silver", "chunks").agg(F.avg("token_estimate")).first()[0], 1) == s["average_token_count_per_chunk"]
    assert g["total_gold_chunks"] == n("gold", "chunks") and g["total_gold_documents"] == n("gold", "documents") and sum(g["gold_topic_distribution"].values()) == g["total_gold_chunks"]
    assert (g["total_gold_faq"], g["total_gold_vehicles"]) == (5, 3)
    rows = lambda layer: files.read_csv(spark, f"{root}/{layer}/rdb_schema/cars_catalog").filter("car_id is not null").count()
    assert (rows("silver"), rows("gold")) == (3, 2)
    readme = (tmp_path / "out/silver/README.md").read_text()
    assert "| cars_catalog | 3 |" in readme and f"| silver/faq | questions and answers | 5 | {o.stats()['silver/faq']['files']} |" in readme and "## category distribution" in readme
    assert "| cars_catalog | 2 |" in (tmp_path / "out/gold/README.md").read_text() and "| bronze | documents of all sources" in (tmp_path / "out/bronze_audit/README.md").read_text()
    size = o.stats()["silver/chunks"]
    assert size["rows"] == n("silver", "chunks") and size["files"] >= 1 and size["bytes"] > 500


def test_runs_of_nothing(spark, tmp_path):
    import pytest

    o = Orchestrator(spark, str(tmp_path), layout=bronze_source.Layout())
    with pytest.raises(FileNotFoundError):
        o.run_gold()
    out = o.run_all()
    assert out["silver"]["total_silver_documents"] == out["gold"]["total_gold_chunks"] == 0 and out["gold"]["retention_rate_percent"] == 0.0


def test_crawl_command(spark, tmp_path):
    (tmp_path / "s.csv").write_text("title,url,category\nMot,http://a/1,k\nHai,http://a/2,k\nLuat,http://thuvienphapluat.vn/x,k\n")
    (tmp_path / "m.json").write_text('[{"file": "Mot.html"}]')
    out = cli.main(["crawl", "--root", str(tmp_path), "--sources", f"{tmp_path}/s.csv", "--manifest", f"{tmp_path}/m.json"], spark)
    assert out["status_distribution"] == {"cached": 1, "pending": 1} and out["total_addresses"] == 2


def test_crawl_plan(spark):
    seeds = spark.createDataFrame([("Một", "http://a/1", "k", 0), ("Xe máy", "http://a/2", "k", 1), (None, "http://a/3", "k", 2)], "title string, url string, category string, ord long")
    found = spark.createDataFrame([("Hai", "http://a/1", "k", 0), ("Ba bốn", "http://a/4", "k", 1), ("Luật", "http://thuvienphapluat.vn/x", "k", 2)], seeds.schema)
    known = crawl.discovered(seeds, found)
    assert {(r.title, r.url, r.rank) for r in known.collect()} == {("Một", "http://a/1", 0), ("Ba bốn", "http://a/4", 1)}
    manifest = spark.createDataFrame([("M_t.html",)], "file string")
    plan = {r.file: r.status for r in crawl.crawl_plan(known, manifest).collect()}
    assert plan == {"M_t.html": "cached", "Ba_b_n.html": "pending"}
    assert [r.file for r in crawl.crawl_plan(known, manifest, max_pages=1).collect()] == ["M_t.html"]
    assert crawl.crawl_plan(known.limit(0), manifest).count() == 0


def test_located_prints_and_order(spark):
    m = spark.createDataFrame([("t", "c", "x/a.pdf"), ("u", "c", "x/b.pdf"), ("v", "c", "x/none.pdf")], "title string, category string, relative_path string")
    f = spark.createDataFrame([("c/a.pdf",), ("a.pdf",), ("b.pdf",)], "path string")
    assert {(r.title, r.path) for r in crawl.located_prints(m, f).collect()} == {("t", "c/a.pdf"), ("u", "b.pdf")}
    c = spark.createDataFrame([(5, "z"), (1, "z"), (2, "a"), (3, None)], "ord long, topic string")
    assert [r.ord for r in crawl.output_order(c).orderBy("topic_ord", "ord").collect()] == [1, 5, 2, 3]
    s = spark.createDataFrame([("x" * 10, None), ("", "old"), (None, None)], "a string, b string")
    assert [r[0] for r in s.select(crawl.fetch_status(F.col("a"), F.col("b"), 5)).collect()] == ["success", "cached", "failed"]
