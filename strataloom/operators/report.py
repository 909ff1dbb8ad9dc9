"""Counts, shares and averages for audit reports, each one pass over its table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def histogram(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def share(part: Column, whole: Column, places: int = 2) -> Column:
    """Percentage; 0 where there is nothing to share."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, places)).otherwise(0.0)


def top_reasons(df: DataFrame, reason: str, order: str, n: int = 10) -> DataFrame:
    """The n most frequent reasons; of equally frequent ones those seen first."""
    return df.groupBy(reason).agg(F.count("*").alias("n"), F.min(order).alias("first")).orderBy(F.desc("n"), "first").limit(n).select(reason, "n")


def labelled_counts(labels: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Every label with its count, 0 where it does not occur."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return labels.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def human_size(n: Column) -> Column:
    kb, mb = n / 1024, n / (1024 * 1024)
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(kb < 1024, F.format_string("%.1f KB", F.bround(kb.cast("double"), 1))).otherwise(F.format_string("%.1f MB", F.bround(mb.cast("double"), 1)))


#: Values that a histogram has at most, and that it tracks: with up to three quarters of these different ones it is exact.
TOP, TRACKED = 1000, 20_000


def or_general(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("general"))


def top(value: Column) -> Column:
    """The most frequent values with their counts, as an aggregate of bounded size that can be observed."""
    return F.call_function("approx_top_k", value, F.lit(TOP), F.lit(TRACKED))


class Watch:
    """Aggregates over rows on their way into a table: told by the pass that writes them, without a scan of their own.

    Put right below the write, so that each counts the tasks that succeed."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def on(self, df: DataFrame, name: str, **aggregates: Column) -> DataFrame:
        self.seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self.seen[name], *(c.alias(k) for k, c in aggregates.items()))

    def __getitem__(self, name: str) -> dict:
        """What was seen; histograms as dictionaries, largest first."""
        shown = lambda v: {r["item"]: r["count"] for r in v} if isinstance(v, list) else v
        return {k: shown(v) for k, v in self.seen[name].get.items()}


def silver_report(bronze: dict, documents: dict, chunks: dict, more: dict[str, int], errors: dict[str, int]) -> dict:
    """Totals, averages and histograms of a silver run, of what its writes have seen."""
    return {
        "total_bronze_records": bronze["n"], "total_silver_documents": documents["n"], "total_silver_chunks": chunks["n"], **more,
        "duplicates_filtered": bronze["n"] - bronze["low"] - documents["n"], "low_quality_filtered": bronze["low"], "language_distribution": documents["languages"],
        "source_distribution": bronze["sources"], "category_distribution": bronze["categories"], "average_quality_score": round(documents["q"] or 0.0, 3), "average_token_count_per_chunk": round(chunks["t"] or 0.0, 1),
        "errors": errors,
    }


def gold_report(verdicts: dict, chunks: dict, documents: dict, more: dict[str, int], reasons: dict[str, int]) -> dict:
    """Totals and distributions of a gold run."""
    n, ok, kept, near = verdicts["n"], verdicts["ok"], chunks["n"], chunks["near"] or 0
    return {
        "total_silver_chunks": n, "relevant_chunks_before_dedup": ok, "filtered_out_irrelevant_chunks": n - ok, "exact_duplicates_dropped": ok - kept - near, "near_duplicates_dropped": near, "total_duplicates_dropped": ok - kept,
        "total_gold_chunks": kept, "filtered_out_chunks": n - kept, "retention_rate_percent": round(kept / n * 100, 2) if n else 0.0, "total_gold_documents": documents["n"], **more,
        "gold_topic_distribution": chunks["topics"], "top_filter_reasons": reasons,
    }


def table_size(df: DataFrame) -> dict[str, int]:
    """Rows, files and bytes of a written table, of its files' footers and names alone."""
    each = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).groupBy("f").agg(F.count("*").alias("n"), F.max("b").alias("b"))
    r = each.agg(F.sum("n"), F.count("*"), F.sum("b")).first()
    return {"rows": r[0] or 0, "files": r[1], "bytes": r[2] or 0}


def markdown_table(rows: list[tuple], header: list[str]) -> str:
    """A small aggregate as a Markdown table, for README files of data folders."""
    line = lambda x: "| " + " | ".join(str(v) for v in x) + " |"
    return "\n".join([line(header), line(["---"] * len(header)), *map(line, rows)])


def shown_size(n: int) -> str:
    """Bytes as people read them."""
    return f"{n} B" if n < 1024 else f"{n / 1024:.1f} KB" if n < 1024**2 else f"{n / 1024**2:.1f} MB"


#: What each layer's README says first, and what its tables hold.
LAYERS = {
    "crawl": ("What a crawl has to fetch, against what is there.", {"plan": "addresses with file names and status"}),
    "bronze_audit": ("Sources as they were read, and what could not be used of them.", {"bronze": "documents of all sources in their order", "bronze_audit/errors": "files and manifests that could not be read"}),
    "silver": ("Documents cleaned, gated and distinct, and their chunks.", {"documents": "clean documents", "chunks": "chunks with heading paths", "faq": "questions and answers", "vehicles": "vehicles with trims and prices"}),
    "gold": ("Chunks that bear on the topics, without duplicates, and their documents.", {"documents": "documents with a chunk or a title that is kept", "chunks": "kept chunks by topic", "faq": "questions and answers", "vehicles": "vehicles with trims and prices"}),
}


def readme(title: str, report: dict, sizes: dict[str, dict] | None = None, relational: dict[str, int] | None = None) -> str:
    """A data folder's README: what it is, its tables with rows, files and sizes, relational tables, the report's single figures,
    then a table for each distribution, largest first."""
    about, holds = LAYERS.get(title.lower().replace(" ", "_"), ("", {}))
    parts = [f"# {title}", *([about] if about else [])]
    if sizes:
        parts += ["## tables", markdown_table([(t, holds.get(t.split("/", 1)[-1], holds.get(t, "")), x["rows"], x["files"], shown_size(x["bytes"])) for t, x in sizes.items()], ["table", "holds", "rows", "files", "size"])]
    if relational:
        parts += ["## relational tables", markdown_table(list(relational.items()), ["table", "rows"])]
    parts += ["## figures", markdown_table([(k.replace("_", " "), v) for k, v in report.items() if not isinstance(v, dict)], ["figure", "value"])]
    for name, counts in ((k, v) for k, v in report.items() if isinstance(v, dict) and v):
        rows = sorted(counts.items(), key=lambda kv: (-kv[1], str(kv[0])))
        parts += [f"## {name.replace('_', ' ')}", markdown_table(rows, ["value", "n"])]
    return "\n\n".join(parts) + "\n"
