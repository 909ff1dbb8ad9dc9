"""Planning what to fetch, and assembling sources that have been fetched. Fetching itself stays outside the engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from .classify import url_is_valid
from .dedup import first_by

#: Columns of an address list.
ADDRESS = ["title", "url", "category"]


def discovered(seeds: DataFrame, found: DataFrame, official: str | None = None) -> DataFrame:
    """Seeds (title, url, category, ord) and then addresses found on pages, the valid ones, the first of equal addresses.
    Entries with null or empty title or address go; no row of either gives none."""
    lists = [x.select(*ADDRESS, F.struct(F.lit(rank).alias("rank"), "ord").alias("at")) for rank, x in enumerate((seeds, found))]
    every = lists[0].unionByName(lists[1]).filter(F.coalesce(url_is_valid(F.col("title"), F.col("url"), F.col("category"), official), F.lit(False)))
    return first_by(every, "url", "at").select(*ADDRESS, F.col("at.rank").alias("rank"), F.col("at.ord").alias("ord"))


def crawl_plan(addresses: DataFrame, manifest: DataFrame, max_pages: int | None = None, suffix: str = ".html") -> DataFrame:
    """What a crawl of ``addresses`` (title, url, category, rank, ord) has to fetch: those without prices and law portals, with the file
    name made from their title, and ``status``: cached where the manifest holds the file, else pending. Of
    files of equal name the first counts. ``max_pages``: the least by (rank, ord) only, as a crawl's own page cap."""
    portal = text.contains_any(F.lower("url"), fixed.LAW_PORTALS)
    wanted = addresses.filter(~F.coalesce((F.col("category") == fixed.PRICE_CATEGORY) | portal, F.lit(False)))
    named = wanted.withColumn("file", F.concat(text.slug(F.col("title")), F.lit(suffix))).withColumn("at", F.struct("rank", "ord"))
    once = first_by(named, "file", "at").drop("at")
    had = manifest.select(F.col("file").alias("_file")).distinct()
    out = once.join(had, F.col("file") == F.col("_file"), "left").withColumn("status", F.when(F.col("_file").isNull(), "pending").otherwise("cached")).drop("_file")
    return out if max_pages is None else out.orderBy("rank", "ord").limit(max_pages)


def fetch_status(fetched: Column, cached: Column, least: int) -> Column:
    """success, cached or failed of a fetch: its text if longer than ``least``, else what an earlier one left, else nothing."""
    enough = F.length(F.coalesce(fetched, F.lit(""))) > least
    return F.when(enough, "success").when(F.coalesce(cached, F.lit("")) != "", "cached").otherwise("failed")


def located_prints(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """A manifest of printed documents (with category, relative_path) joined with ``files`` (path, below the folder): first as
    category/name, else as name; entries without either go."""
    name = F.element_at(F.split("relative_path", "/"), -1)
    m = manifest.withColumn("name", name).withColumn("_first", F.concat_ws("/", "category", "name"))
    known = files.select(F.col("path").alias("_p"))
    a = m.join(known.withColumnRenamed("_p", "_a"), F.col("_first") == F.col("_a"), "left")
    b = a.join(known.withColumnRenamed("_p", "_b"), F.col("name") == F.col("_b"), "left")
    return b.withColumn("path", F.coalesce("_a", "_b")).filter("path is not null").drop("_first", "_a", "_b")


def in_order(sources: list[DataFrame]) -> DataFrame:
    """Bronze documents of several sources as one table: ``ord`` sorts by source, then by place in it."""
    return reduce(DataFrame.unionByName, sources)


def output_order(chunks: DataFrame, topic: str = "topic", order: str = "ord") -> DataFrame:
    """``chunks`` with ``topic_ord``, the least ``order`` of their topic: a writer sorts by (topic_ord, order), so that topics come in the order in which
    they appear first. A null topic is one."""
    first = chunks.groupBy(F.col(topic).alias("_topic")).agg(F.min(order).alias("topic_ord"))
    return chunks.join(first, F.col(topic).eqNullSafe(F.col("_topic"))).drop("_topic")
