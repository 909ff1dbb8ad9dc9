"""Sources and sinks: manifests, pages, JSONL, CSV, printed documents, snapshots."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text
from ..operators import dedup

MANIFEST = "title string, url string, category string, domain string, file string, bytes long, crawled_at string"
PRINT_MANIFEST = "title string, category string, relative_path string, size_bytes long, type string"
BRONZE = "ord long, raw_id string, source_type string, source_file string, title string, url string, category string, domain string, raw_content string, raw_metadata map<string,string>, crawled_at string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """A path as the readers of files name it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of a JSON array file with ``pos``; a missing or broken file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema + ", pos long")
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.posexplode(F.from_json("value", f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in schema.split(', '))}>>")).alias("pos", "x"))
    return parsed.select("x.*", F.col("pos").cast("long").alias("pos"))


def read_jsonl(spark: SparkSession, path: str, schema: str, required: bool = False) -> DataFrame:
    """Rows of a JSONL file or folder; missing: an error where required, else no rows."""
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_sources_csv(spark: SparkSession, path: str, default_category: str = "trai_nghiem_danh_gia") -> DataFrame:
    """title, url, category of an address list: header in either letter case, UTF-8 with or without BOM, rows without address or title left out."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    by_name = {c.lstrip("﻿").lower(): F.col(f"`{c}`") for c in raw.columns}
    field = lambda n: text.strip(F.coalesce(by_name.get(n, F.lit(None).cast("string")), F.lit("")))
    out = raw.select(field("title").alias("title"), field("url").alias("url"), F.coalesce(F.nullif(field("category"), F.lit("")), F.lit(default_category)).alias("category"))
    return out.filter("url != '' and title != ''")


def read_pages(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """(file, path, content): whole files as UTF-8, bytes that are none dropped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit("")).alias("content"))


def list_files(spark: SparkSession, folder: str, glob: str, least_bytes: int = 1000) -> DataFrame:
    """(name, size_bytes) of files above a size, by name; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "length")
    return files.filter(F.col("length") > least_bytes).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size_bytes")).orderBy("name")


def titled(stem: Column) -> Column:
    """As a title: ``_`` to blank, a capital after anything that is no letter, others small."""
    chars = F.split(F.lower(F.replace(stem, F.lit("_"), F.lit(" "))), "(?<=[^\\p{L}])(?=\\p{L})", -1)
    return F.array_join(F.transform(chars, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")


def print_manifest(spark: SparkSession, folder: str, category: str, kind: str, prefix: str) -> DataFrame:
    """A manifest of the PDF files of a folder."""
    f = list_files(spark, folder, "*.pdf")
    return f.select(titled(F.regexp_replace("name", r"\.pdf$", "")).alias("title"), F.lit(category).alias("category"), F.concat(F.lit(f"{prefix.rstrip('/')}/"), "name").alias("relative_path"), "size_bytes", F.lit(kind).alias("type"))


def valid_pdf(content: Column) -> Column:
    return (F.octet_length(content) > 1000) & (F.substring(content, 1, 4) == F.lit(b"%PDF"))


def bronze_articles(manifest: DataFrame, pages: DataFrame, default_category: str, default_domain: str, source_rank: int = 0, main_extractor=None) -> DataFrame:
    """Articles of a manifest as bronze documents. ``main_extractor``: a Column
    function html -> Markdown to try first; short results fall back to the paragraphs of the article."""
    joined = pages.join(manifest, "file")
    fallback = H.article_text(F.col("content"))
    body = fallback
    if main_extractor is not None:
        first = main_extractor(F.col("content"))
        body = F.when(F.length(text.strip(F.coalesce(first, F.lit("")))) < 100, fallback).otherwise(first)
    d = joined.withColumn("_body", body).filter(text.strip(F.coalesce("_body", F.lit(""))) != "")
    title = F.coalesce("title", F.lit(""))
    content = F.when((title != "") & ~F.startswith("_body", F.lit("#")), F.concat(F.lit("# "), "title", F.lit("\n\n"), "_body")).otherwise(F.col("_body"))
    domain = F.coalesce("domain", F.lit(default_domain))
    return d.select(
        (F.lit(source_rank).cast("long") * (1 << 40) + F.col("pos")).alias("ord"), F.concat_ws("_", F.lit("html"), domain, "file").alias("raw_id"), F.lit("html_article").alias("source_type"), F.col("path").alias("source_file"),
        "title", "url", F.coalesce("category", F.lit(default_category)).alias("category"), domain.alias("domain"), content.alias("raw_content"),
        _metadata("title", "url", "category", "domain", "file", "bytes", "crawled_at").alias("raw_metadata"), "crawled_at",
    )


def _metadata(*names: str) -> Column:
    """The entry of a manifest as a map, without what it lacks."""
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.col(n).cast("string") for n in names))), lambda k, v: v.isNotNull())


def bronze_prints(pages: DataFrame, source_rank: int = 3, domain: str = "local_pdf") -> DataFrame:
    """Printed documents (a manifest's columns with pos, path, and pages: array<string>) as bronze documents. Fewer than 100 characters: left out."""
    d = pages.withColumn("raw_content", text.printed_markdown(F.col("pages"), F.col("title"))).filter(F.length("raw_content") >= 100)
    null, name = F.lit(None).cast("string"), F.element_at(F.split("relative_path", "/"), -1)
    category = F.coalesce("category", F.lit("general"))
    title = F.coalesce(F.nullif("title", F.lit("")), titled(F.replace(name, F.lit(".pdf"), F.lit(""))))
    return d.select(
        (F.lit(source_rank).cast("long") * (1 << 40) + F.col("pos")).alias("ord"), F.concat_ws("_", F.lit("pdf"), category, name).alias("raw_id"), F.lit("pdf").alias("source_type"), F.col("path").alias("source_file"), title.alias("title"), null.alias("url"),
        category.alias("category"), F.lit(domain).alias("domain"), "raw_content", _metadata("title", "category", "relative_path", "size_bytes", "type").alias("raw_metadata"), null.alias("crawled_at"),
    )


def upsert_manifest(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The manifest with those new entries whose file it lacks."""
    return existing.unionByName(new.join(existing.select("file"), "file", "left_anti"), allowMissingColumns=True)


def _paths(spark: SparkSession, path: str):
    """The file system of a table's path, the path itself and where its last version waits while a new one takes its place."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.last")


def recovered(spark: SparkSession, path: str) -> bool:
    """Put back a table's last version where a replacement was cut off between its two renames; whether there is a table."""
    fs, now, last = _paths(spark, path)
    if not fs.exists(now) and fs.exists(last):
        fs.rename(last, now)
    return fs.exists(now)


def replace_table(df: DataFrame, path: str) -> None:
    """Write a table in place of the one at ``path``, which ``df`` may read: the new one is written beside it, whole, and then
    renamed. Until then, and after any failure, the old one is there; ``recovered`` settles a cut between the renames."""
    spark = df.sparkSession
    fs, now, last = _paths(spark, path)
    recovered(spark, path)
    staged = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.new-{uuid.uuid4().hex}")
    try:
        df.write.parquet(staged.toString())
        fs.delete(last, True)
        if fs.exists(now) and not fs.rename(now, last):
            raise OSError(f"{now.toString()} cannot be renamed")
        if not fs.rename(staged, now):
            raise OSError(f"{staged.toString()} cannot be renamed")
    finally:
        fs.delete(staged, True)
        recovered(spark, path)
    fs.delete(last, True)


def upsert_table(new: DataFrame, path: str) -> DataFrame:
    """Add to the manifest table at ``path`` those entries of ``new`` whose file it lacks, in place; returns the table."""
    spark = new.sparkSession
    there = recovered(spark, path)
    replace_table(upsert_manifest(spark.read.parquet(path), new) if there else dedup.first_by(new, "file", "file"), path)
    return spark.read.parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    """The primary format; partitions are written in parallel, and a table that is there stays until the new one is whole."""
    replace_table(df, path)


def write_csv(df: DataFrame, path: str, mark: bool = True) -> int:
    """A small relational table as one CSV file with header, after a byte order mark as spreadsheets want it; nothing for an
    empty one. Counted by the pass that writes it; returns the rows."""
    seen = Observation(f"csv-{uuid.uuid4().hex}")
    one = df.coalesce(1).observe(seen, F.count("*").alias("n"))
    if mark and df.columns:
        one = one.withColumnRenamed(df.columns[0], f"\ufeff{df.columns[0]}")
    one.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    n = seen.get["n"]
    if not n:
        fs, now, _ = _paths(df.sparkSession, path)
        fs.delete(now, True)
    return n


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table that ``write_csv`` wrote: strings, or the types of ``schema``; a byte order mark is no part of a name."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    kinds = dict(c.strip().split() for c in schema.split(",")) if schema else {}
    return raw.select(*(F.col(f"`{c}`").cast(kinds.get(c.lstrip("\ufeff"), "string")).alias(c.lstrip("\ufeff")) for c in raw.columns))


def write_text(spark: SparkSession, content: str, path: str) -> None:
    """A small file, by the path's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A report of one row as indented JSON."""
    write_text(spark, json.dumps(report, ensure_ascii=False, indent=2), path)


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
