"""Question-and-answer items from FAQ pages, and their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H


def carry_forward(df: DataFrame, value: str, group: str, order: str, into: str, default: str) -> DataFrame:
    """``into``: the last non-null ``value`` up to each row, within ``group`` by ``order``."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(into, F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit(default)))


def tags(question: Column, subcategory: Column, names: list[str]) -> Column:
    """Names that occur in either text, in their order, whatever the letter case."""
    q, s = F.lower(question), F.lower(subcategory)
    return F.filter(F.array(*(F.lit(n) for n in names)) if names else F.array().cast("array<string>"), lambda n: F.contains(q, F.lower(n)) | F.contains(s, F.lower(n)))


def slug_id(category: Column, subcategory: Column) -> Column:
    return F.concat(F.lit("faq_doc_"), F.substring(F.md5(F.lower(F.replace(F.concat_ws("_", category, subcategory), F.lit(" "), F.lit("_")))), 1, 10))


def items(pages: DataFrame, names: list[str], default_category: str, default_subcategory: str = "Hỏi đáp chung") -> DataFrame:
    """Items of pages (page, html) with the nearest headers before each."""
    e = pages.select("page", F.explode(H.faq_of_page(F.col("html"))).alias("e")).select("page", "e.*")
    e = e.withColumn("c", F.when(F.col("kind") == "category", F.col("text"))).withColumn("s", F.when(F.col("kind") == "subcategory", F.col("text")))
    e = carry_forward(carry_forward(e, "c", "page", "pos", "category", default_category), "s", "page", "pos", "subcategory", default_subcategory).filter("kind = 'post'")
    return e.select(
        "page", "pos", F.concat(F.lit("faq_"), F.substring(F.md5("text"), 1, 12)).alias("faq_id"), F.col("text").alias("question"), "answer", "answer_markdown", "category", "subcategory",
        tags(F.col("text"), F.col("subcategory"), names).alias("vehicle_tags"), slug_id(F.col("category"), F.col("subcategory")).alias("doc_id"), F.lit(1.0).alias("quality_score"),
    )


def documents(items: DataFrame) -> DataFrame:
    """A document for each (category, subcategory): its questions and answers in order.
    (doc_id, category, subcategory, content, total_questions, first)."""
    block = F.concat(F.lit("### "), "question", F.lit("\n\n"), "answer_markdown", F.lit("\n"))
    rows = items.withColumn("at", F.struct("page", "pos")).withColumn("block", block)
    g = rows.groupBy("doc_id", "category", "subcategory").agg(F.array_sort(F.collect_list(F.struct("at", "block"))).alias("b"), F.count("*").alias("total_questions"), F.min("at").alias("first"))
    body = F.array_join(F.transform("b", lambda x: x["block"]), "\n")
    return g.select("doc_id", "category", "subcategory", F.concat(F.lit("# "), "category", F.lit("\n## "), "subcategory", F.lit("\n\n"), body).alias("content"), "total_questions", "first")
