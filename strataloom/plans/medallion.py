"""The layers: bronze documents to silver documents and chunks, and these to gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import chunking, classify, dedup
from ..store import materialize


@dataclass(frozen=True)
class Config:
    chunk_size: int = 512
    chunk_overlap: int = 80
    min_chunk_length: int = 40
    min_doc_length: int = 50
    min_diacritic_ratio: float = 0.03
    deduplicate: bool = True
    dedup_exact: bool = True
    dedup_near: bool = True
    dedup_threshold: float = 0.90
    shingle_k: int = 3
    min_score: float = 0.5
    language: str = "vi"
    compose: bool = True
    untitled: str = "Tài liệu không tiêu đề"
    topics: dict[str, list[str]] = field(default_factory=lambda: fixed.TOPICS)
    core: list[str] = field(default_factory=lambda: fixed.CORE_CATEGORIES)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to all cores where it comes in few splits: cleaning is bound by
    the processor. Inputs with as many splits as cores stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def low_quality(config: Config = Config()) -> Column:
    """Whether a cleaned document has no text or does not pass."""
    passed = text.quality_gate(F.col("markdown"), F.col("ratio"), config.min_diacritic_ratio, config.min_doc_length)
    return (text.strip(F.coalesce("raw_content", F.lit(""))) == "") | ~passed


def cleaned(bronze: DataFrame, config: Config = Config(), written: bool = True, watch: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """``bronze`` with markdown, ratio, quality_score and low_quality.

    The clean text is written and read again: later filters would otherwise be
    pushed below it and compute it several times over. ``written=False`` leaves that out, for streams. ``watch`` sees what is written.
    """
    raw = F.coalesce("raw_content", F.lit(""))
    bronze = spread(bronze) if written else bronze
    # a column a step: each is used more than once by the next, and so is computed once
    d = bronze.withColumn("markdown", text.strip_boilerplate(raw))
    if config.compose:
        d = d.withColumn("markdown", text.nfc(F.col("markdown")))
    d = d.withColumn("markdown", text.modern_tones(F.col("markdown"))).withColumn("markdown", text.typography(F.col("markdown")))
    d = d.withColumn("ratio", text.diacritic_ratio(F.col("markdown")))
    if written:
        d = materialize(watch(d), "clean")
    d = d.withColumn("quality_score", text.quality_score(F.col("markdown"), F.col("ratio"), config.min_diacritic_ratio, config.min_doc_length))
    return d.withColumn("low_quality", low_quality(config))


def silver_documents(flagged: DataFrame, config: Config = Config()) -> DataFrame:
    """Documents that pass, the first of equal texts, ready for search."""
    d = flagged.filter("not low_quality").drop("low_quality").withColumn("checksum_sha256", F.sha2("markdown", 256))
    if config.deduplicate:
        d = dedup.first_by(d, "checksum_sha256")
    d = d.withColumn("plain", text.plain_text(F.col("markdown")))
    falsy = lambda c, default: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default))
    return d.select(
        "ord", F.concat(F.lit("doc_"), F.substring("checksum_sha256", 1, 16)).alias("doc_id"), F.col("raw_id").alias("source_id"), "source_type", text.normalize(falsy("title", config.untitled), config.compose).alias("title"),
        falsy("category", "general").alias("category"), "domain", "url", F.lit(config.language).alias("language"), F.col("markdown").alias("content_clean_markdown"), F.col("plain").alias("content_plain_text"),
        text.n_words(F.col("plain")).alias("word_count"), F.length("markdown").alias("char_count"), text.n_words(F.col("markdown")).alias("token_estimate"), F.round("ratio", 4).alias("diacritic_ratio"), "quality_score", "checksum_sha256",
    )


def silver_chunks(documents: DataFrame, config: Config = Config()) -> DataFrame:
    """Chunks of silver documents with their category, type, address and ``ord`` (of the document, then index)."""
    d = documents.withColumnRenamed("ord", "_doc")
    c = chunking.chunks(d, "doc_id", "content_clean_markdown", config.chunk_size, config.chunk_overlap, config.min_chunk_length, keep=("category", "source_type", "url", "_doc"))
    return c.withColumn("ord", F.struct(F.col("_doc").alias("doc"), F.col("chunk_index").alias("index"))).drop("_doc")


def verdicts(chunks: DataFrame, config: Config = Config()) -> DataFrame:
    """``chunks`` with admitted, topic, consultation_score and reason."""
    v = classify.chunk_verdict(F.col("content"), F.col("heading_path"), F.col("category"), config.topics, config.core, min_score=config.min_score)
    return chunks.withColumn("v", v).select(*chunks.columns, "v.admitted", "v.topic", F.col("v.score").alias("consultation_score"), "v.reason")


def gold_chunks(judged: DataFrame, config: Config = Config()) -> DataFrame:
    """Admitted chunks without exact and near duplicates."""
    c = judged.filter("admitted").drop("admitted", "reason")
    if config.dedup_exact:
        c = dedup.exact_chunks(c)
    else:
        c = c.withColumn("duplicate_doc_sources", F.array().cast("array<string>")).withColumn("duplicate_count", F.lit(0))
    c = c.withColumn("topic", F.coalesce("topic", F.nullif("category", F.lit("")), F.lit("all")))
    if config.dedup_near:
        return dedup.near_chunks(materialize(c, "exact"), config.dedup_threshold, config.shingle_k)
    return c.withColumn("near_duplicate_merged", F.lit(0))


def gold_documents(documents: DataFrame, chunks: DataFrame, config: Config = Config()) -> DataFrame:
    """Documents of which a chunk is admitted, or that are admitted themselves."""
    ids = chunks.select(F.col("doc_id").alias("_id")).distinct().withColumn("_in", F.lit(True))
    v = classify.document_verdict(F.col("title"), F.col("source_id"), F.col("category"), config.core)
    return documents.join(ids, F.col("doc_id") == F.col("_id"), "left").filter(F.coalesce("_in", F.lit(False)) | v["admitted"]).drop("_id", "_in")
