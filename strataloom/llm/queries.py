"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, cws, line_dedup, mixing, negatives, ngram_join, ogg, quality, repair, simhash, token_files, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), line_dedup.PUNCT)
    return out.select("doc_id", "n_removed", F.size(F.split("text", "\n", -1)).alias("n_lines"), F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_shards(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, drops_space=True)
    return token_files.read_token_shards(manifest)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, drops_space=False)
    return token_files.pack_concat(manifest, window=2048)


def _payload(docs: DataFrame) -> DataFrame:
    """UTF-8 bytes with blanks up to a positive multiple of 192."""
    text = F.coalesce("text", F.lit(""))
    n = F.octet_length(text)
    padded = F.greatest(F.ceil(n / 192) * 192, F.lit(192))
    return docs.select("doc_id", n.cast("long").alias("n_bytes"), F.concat(text, F.repeat(F.lit(" "), (padded - n).cast("int"))).cast("binary").alias("payload"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), n=5, num=80, den=100)


def op4_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = ogg.ogg_encode(_payload(table(spark, sf_dir, "documents")), "payload").select("doc_id", "n_bytes", "media")
    back = ogg.ogg_decode(stored)
    payload = F.col("decoded.payload")
    return back.select(
        "doc_id", "n_bytes", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_sha256"), F.crc32(F.substring(payload, -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.col("decoded.feature").alias("feature"), F.col("decoded.ok").alias("ok"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=[3, 1, 2], total_share=1.5, cap=2.0).select("doc_id", "size", "source_size", "target", "taken")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], turns.schema)
    return chat.read_back(chat.prefix_targets(turns.unionByName(more)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.predict(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_warc(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return warc.read_warc(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.edited_likeness(table(spark, sf_dir, "documents"), k=64)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(rows), rows.select("conv_id"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_classes(table(spark, sf_dir, "documents"), k=4, radius=4)
    return out.select("doc_id", simhash.to_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_token_files, op3_ngram_join, op4_ogg_media, op5_mixing, op6_chat, op7_quality, op8_warc, op9_packing, op10_fingerprints, op11_conversation_repair, op12_simhash, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op6_chat": chat.ORACLE, "op11_conversation_repair": repair.ORACLE, "op13_hard_negatives": negatives.ORACLE}
