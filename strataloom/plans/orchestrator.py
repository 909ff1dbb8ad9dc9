"""Runs of the layers from files to files, with their reports.

A run reads what the layer before has written, so each can be repeated alone.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import crawl, faq, relational, report
from ..sources import bronze, files
from ..store import materialize, scope
from . import medallion


@dataclass
class Orchestrator:
    """``root`` holds a folder for each layer: bronze (Parquet in the schema ``sources.files.BRONZE``), silver and gold.

    With a ``layout``, bronze is read from its files, and the runs also carry questions and answers, vehicles and relational tables."""

    spark: SparkSession
    root: str
    config: medallion.Config = field(default_factory=medallion.Config)
    layout: bronze.Layout | None = None
    relational_rows: dict[str, dict[str, int]] = field(default_factory=dict, repr=False)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def read(self, *parts: str) -> DataFrame:
        return self.spark.read.parquet(self.path(*parts))

    def has(self, *parts: str) -> bool:
        return files.exists(self.spark, self.path(*parts))

    def write_bronze(self, sources: list[DataFrame]) -> None:
        """All sources in their fixed order."""
        files.write_table(crawl.in_order(sources), self.path("bronze"))

    def run_crawl(self, sources_csv: str, manifest: str, max_pages: int | None = None) -> dict:
        """The plan of a crawl of an address list, against what a manifest says is there: a table, and counts by status."""
        began, watch = time.perf_counter(), report.Watch()
        listed = files.read_sources_csv(self.spark, sources_csv).withColumn("ord", F.monotonically_increasing_id())
        known = crawl.discovered(listed, listed.limit(0))
        had = files.read_json_array(self.spark, manifest, files.MANIFEST)
        plan = crawl.crawl_plan(known, had, max_pages)
        files.write_table(watch.on(plan, "plan", n=F.count("*"), statuses=report.top(F.col("status")), categories=report.top(F.col("category"))), self.path("crawl", "plan"))
        return self._reported("crawl", {"total_addresses": watch["plan"]["n"], "status_distribution": watch["plan"]["statuses"], "category_distribution": watch["plan"]["categories"]}, began)

    def run_bronze(self) -> dict:
        """The layout's sources as a table, and beside it what could not be used of them."""
        began, watch = time.perf_counter(), report.Watch()
        everything = watch.on(bronze.read_bronze(self.spark, self.layout), "bronze", n=F.count("*"), sources=report.top(report.or_general("source_type")))
        files.write_table(everything, self.path("bronze"))
        wrong = watch.on(bronze.read_bronze(self.spark, self.layout, "errors"), "errors", n=F.count("*"), kinds=report.top(F.concat_ws(": ", "source_type", F.substring_index("reason", ":", 1))))
        files.write_table(wrong, self.path("bronze_audit", "errors"))
        out = {"total_bronze_records": watch["bronze"]["n"], "source_distribution": watch["bronze"]["sources"], "total_errors": watch["errors"]["n"], "errors": watch["errors"]["kinds"]}
        return self._reported("bronze_audit", out, began)

    def run_silver(self) -> dict:
        """Documents and chunks; each table is counted by the pass that writes it."""
        began, watch, c = time.perf_counter(), report.Watch(), self.config
        with scope(self.spark):
            seen = lambda d: watch.on(d, "bronze", n=F.count("*"), low=F.count_if(medallion.low_quality(c)), sources=report.top(report.or_general("source_type")), categories=report.top(report.or_general("category")))
            flagged = medallion.cleaned(self.read("bronze"), c, watch=seen)
            documents = medallion.silver_documents(flagged, c)
            files.write_table(watch.on(documents, "documents", n=F.count("*"), q=F.avg("quality_score"), languages=report.top(F.col("language"))), self.path("silver", "documents"))
            chunks = medallion.silver_chunks(self.read("silver", "documents"), c)
            files.write_table(watch.on(chunks, "chunks", n=F.count("*"), t=F.avg("token_estimate")), self.path("silver", "chunks"))
            more = self._side_tables(watch) if self.layout else {}
        audit = ("bronze_audit", "bronze_audit_report.json")
        errors = files.read_report(self.spark, self.path(*audit))["errors"] if self.has(*audit) else {}
        return self._reported("silver", report.silver_report(watch["bronze"], watch["documents"], watch["chunks"], more, errors), began)

    def _side_tables(self, watch: report.Watch) -> dict[str, int]:
        """Questions and answers, vehicles, and the relational tables of the whole snapshot."""
        layout, told = self.layout, {}
        normal = lambda c: text.normalize(F.col(c), self.config.compose).alias(c)
        if layout.faq and files.exists(self.spark, layout.faq):
            pages = files.read_pages(self.spark, layout.faq, "*").select(F.col("path").alias("page"), F.col("content").alias("html"))
            items = faq.items(pages, layout.names, layout.brand)
            items = items.select(*(normal(c) if c in ("question", "answer", "answer_markdown") else c for c in items.columns), F.lit(layout.faq_url or None).cast("string").alias("source_url"))
            files.write_table(watch.on(items, "faq", n=F.count("*")), self.path("silver", "faq"))
            told["total_faq_items"] = watch["faq"]["n"]
        if layout.snapshot and files.exists(self.spark, layout.snapshot):
            s = relational.snapshot(self.spark, layout.snapshot)
            v = relational.vehicles(s, layout.brand, placed=True)
            v = v.select(*(normal(c) if c == "searchable_markdown" else c for c in v.columns))
            files.write_table(watch.on(v, "vehicles", n=F.count("*")), self.path("silver", "vehicles"))
            told["total_vehicles"] = watch["vehicles"]["n"]
            self._relational("silver", cars_only=False)
        return told

    def _relational(self, layer: str, cars_only: bool) -> None:
        s = relational.snapshot(self.spark, self.layout.snapshot)
        tables = relational.tables(s, self.layout.brand, cars_only)
        self.relational_rows[layer] = {name: files.write_csv(t, self.path(layer, "rdb_schema", name)) for name, t in tables.items()}

    def run_gold(self) -> dict:
        """Relevant chunks without duplicates and their documents; relational tables again from the snapshot, cars only."""
        if not self.has("silver", "chunks"):
            raise FileNotFoundError(f"{self.path('silver', 'chunks')}: the silver run comes first")
        began, watch = time.perf_counter(), report.Watch()
        with scope(self.spark):
            chunks, documents = self.read("silver", "chunks"), self.read("silver", "documents")
            # judged once, for the chunks, their documents and the report
            judged = materialize(watch.on(medallion.verdicts(chunks, self.config), "verdicts", n=F.count("*"), ok=F.count_if("admitted")), "judged")
            kept = crawl.output_order(medallion.gold_chunks(judged, self.config))
            ordered = kept.repartitionByRange("topic_ord", "ord").sortWithinPartitions("topic_ord", "ord").drop("topic_ord")
            files.write_table(watch.on(ordered, "chunks", n=F.count("*"), near=F.sum("near_duplicate_merged"), topics=report.top(F.col("topic"))), self.path("gold", "chunks"))
            gold = medallion.gold_documents(documents, self.read("gold", "chunks"), self.config)
            files.write_table(watch.on(gold, "documents", n=F.count("*")), self.path("gold", "documents"))
            reasons = {r[0]: r[1] for r in report.top_reasons(judged.filter("not admitted"), "reason", "ord").collect()}
            more = {}
            for name in ("faq", "vehicles"):
                if self.has("silver", name):
                    files.write_table(watch.on(self.read("silver", name), name, n=F.count("*")), self.path("gold", name))
                    more[f"total_gold_{name}"] = watch[name]["n"]
            if self.layout and self.layout.snapshot and files.exists(self.spark, self.layout.snapshot):
                self._relational("gold", cars_only=True)
        return self._reported("gold", report.gold_report(watch["verdicts"], watch["chunks"], watch["documents"], more, reasons), began)

    def run_all(self) -> dict:
        first = {"bronze": self.run_bronze()} if self.layout else {}
        return first | {"silver": self.run_silver(), "gold": self.run_gold()}

    def _reported(self, layer: str, out: dict, began: float) -> dict:
        out = out | {"seconds": round(time.perf_counter() - began, 2)}
        files.write_report(self.spark, out, self.path(layer, f"{layer}_report.json"))
        sizes = {k: v for k, v in self.stats().items() if k.startswith(f"{layer}/") or (layer == "bronze_audit" and k == "bronze")}
        readme = report.readme(layer.replace("_", " ").capitalize(), out, sizes, self.relational_rows.get(layer))
        files.write_text(self.spark, readme, self.path(layer, "README.md"))
        return out

    def stats(self) -> dict:
        """Rows, files and bytes of each table that has been written."""
        tables = [("crawl", "plan"), ("bronze",), ("bronze_audit", "errors"), *((layer, t) for layer in ("silver", "gold") for t in ("documents", "chunks", "faq", "vehicles"))]
        return {"/".join(t): report.table_size(self.read(*t)) for t in tables if self.has(*t)}

    def sample(self, layer: str, table: str, n: int = 3) -> list[dict]:
        """The first n rows, in the table's order."""
        return [r.asDict(recursive=True) for r in self.read(layer, table).orderBy(F.col("ord").asc_nulls_last()).limit(n).collect()]
