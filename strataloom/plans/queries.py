"""The engine's queries over the test tables, each over whole tables.

The tables are no Vietnamese car corpus, so some queries put headings, noise or
rule words into texts, on both sides alike, and pass small rule tables of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed, html, text
from ..operators import chunking, classify, crawl, dedup, faq, relational, report
from . import medallion
from .medallion import Config

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _queries[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_queries)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Topics in words that the test documents use.
TOPICS = {"common": ["the ", "and ", "of "], "romance": [" de ", " la ", " que "], "german": ["und ", "der ", " die "], "marks": ["!!", "$$$", "|"]}
CORE = ["src3", "src7"]
NOISE = "\nChia sẻ bài viết qua: web\n\n\n\nXem thêm: tin khác\nhotline hỗ trợ : 0123 456\nMột dòng   giữ lại\nabout: blank"
SAMPLES = ["hoà bình, thuỷ điện, khoẻ mạnh, quĩ đầu tư", "Xe,một thương hiệu ô tô  điện .“Xe rất tốt” – ông Nam chia sẻ .", "giá 260.000.000 và 60,13 %", "Toán khoản loại quý quỹ", "a​b c…"]
NFD = ["Việt Nam", "été", "plain", "ẛ̣", "Å"]


def bronze(spark: SparkSession, sf_dir: str, noise: str = "") -> DataFrame:
    """``documents`` as bronze documents."""
    d = table(spark, sf_dir, "documents")
    null = F.lit(None).cast("string")
    return d.select(F.col("doc_id").alias("ord"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("raw_id"), F.lit("html_article").alias("source_type"), F.col("source").alias("title"), null.alias("url"), F.col("source").alias("category"), F.col("lang").alias("domain"), F.concat(F.coalesce("text", F.lit("")), F.lit(noise)).alias("raw_content"))


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as Markdown with two headings and one more between lines."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat(F.lit("# "), "source", F.lit("\n## "), "lang", F.lit("\n"), F.replace(F.coalesce("text", F.lit("")), F.lit(".\n"), F.lit(".\n### part\n"))).alias("markdown"))


# --- text


@_query
def boilerplate_strip(spark, sf_dir):
    return bronze(spark, sf_dir, NOISE).select(F.col("ord").alias("doc_id"), text.strip_boilerplate(F.col("raw_content")).alias("clean"))


@_query
def tone_rewrite(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" " + SAMPLES[0] + SAMPLES[3])).alias("t"))
    return d.select("doc_id", text.modern_tones(F.col("t")).alias("modern"))


@_query
def typography(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n" + SAMPLES[1] + "\n\n\n " + SAMPLES[2] + SAMPLES[4])).alias("t"))
    return d.select("doc_id", text.typography(F.col("t")).alias("typed"))


@_query
def normalize(spark, sf_dir):
    d = bronze(spark, sf_dir, "\n" + "\n".join(SAMPLES))
    return d.select(F.col("ord").alias("doc_id"), text.normalize(F.col("raw_content")).alias("normal"))


@_query
def nfc_normalize(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat("doc_id", F.lit("d")).alias("k"), "text")
    v = spark.createDataFrame([(f"v{i}", t) for i, t in enumerate(NFD)], "k string, text string")
    return d.unionByName(v).select("k", text.nfc(F.col("text")).alias("composed"))


@_query
def quality(spark, sf_dir):
    d = medallion.spread(bronze(spark, sf_dir)).withColumn("r", text.diacritic_ratio(F.col("raw_content")))
    t, r = F.col("raw_content"), F.col("r")
    return d.select(F.col("ord").alias("doc_id"), F.round(r, 6).alias("ratio"), text.quality_score(t, r).alias("score"), text.quality_gate(t, r).alias("passed"))


@_query
def plain_text(spark, sf_dir):
    return headed(spark, sf_dir).select("doc_id", text.plain_text(F.col("markdown")).alias("plain"), text.n_words(F.col("markdown")).alias("n_words"), F.length("markdown").alias("n_chars"))


@_query
def sentence_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("nth", "sentence"))
    return d.select("doc_id", "nth", "sentence")


@_query
def shingle_sets(spark, sf_dir):
    s = text.shingles(F.col("text"), 3)
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.size(s).alias("n"), F.md5(F.array_join(F.array_sort(s), ",")).alias("digest"))


@_query
def dedup_keys(spark, sf_dir):
    return headed(spark, sf_dir).select("doc_id", F.sha2(text.dedup_key(F.col("markdown")), 256).alias("key"))


# --- documents


@_query
def exact_doc_dedup(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("checksum"))
    return dedup.first_by(d, "checksum", "doc_id").select("doc_id", "checksum", F.concat(F.lit("doc_"), F.substring("checksum", 1, 16)).alias("name"))


@_query
def silver_documents(spark, sf_dir):
    return medallion.silver_documents(medallion.cleaned(bronze(spark, sf_dir, NOISE))).drop("domain", "url")


@_query
def silver_report(spark, sf_dir):
    f = medallion.cleaned(bronze(spark, sf_dir)).select("ord", "raw_content", "low_quality", "quality_score", F.sha2("markdown", 256).alias("k"))
    best = f.groupBy("k", "low_quality").agg(F.count("*").alias("n"), F.min_by("quality_score", "ord").alias("q"))
    good = ~F.col("low_quality")
    return best.agg(F.sum("n").alias("total"), F.count_if(good).alias("documents"), F.coalesce(F.sum(F.when(good, F.col("n") - 1)), F.lit(0)).alias("duplicates"), F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("low_quality"), F.round(F.avg(F.when(good, F.col("q"))), 3).alias("average_quality"))


@_query
def source_histogram(spark, sf_dir):
    return report.histogram(table(spark, sf_dir, "documents"), F.coalesce(F.nullif("source", F.lit("")), F.lit("general")), "category")


# --- chunks


@_query
def heading_sections(spark, sf_dir):
    return chunking.sections(medallion.spread(headed(spark, sf_dir))).select("doc_id", "section", F.array_join("heading_path", " > ").alias("path"), F.col("text").alias("body"))


@_query
def table_and_fence(spark, sf_dir):
    """Tables stay whole, fences hide headings, laws give headings, around whole texts."""
    d = table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit(""))
    grid = F.concat(F.lit("| x | y |\n|---|---|\n"), F.repeat(F.lit("| 1 | 2 |\n"), (F.pmod("doc_id", F.lit(50)) + 1).cast("int")))
    d = d.select("doc_id", F.concat(F.lit("# A\n"), grid, F.lit("## B\n```py\n# hidden\nĐiều 1. hidden\n"), body, F.lit("\n```\n  Chương I Chung\n"), body, F.lit("\nđiều 2. Phạm vi\n"), body, F.lit(" end\n##### Deep\n"), body, F.lit("\n# Last\n```\n# open to the end")).alias("markdown"))
    return chunking.sections(medallion.spread(d)).select("doc_id", "section", F.array_join("heading_path", " > ").alias("path"), F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@_query
def silver_chunks(spark, sf_dir):
    c = chunking.chunks(medallion.spread(headed(spark, sf_dir)))
    return c.select("chunk_id", "doc_id", "chunk_index", "heading_context", "token_estimate", "char_count", F.md5("content").alias("digest"))


@_query
def chunk_sizes(spark, sf_dir):
    """Whole texts with all their lines and headings, in sections that all fit: chunks that SQL can tell too."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("# "), "source", F.lit("\n"), F.coalesce(F.col("text"), F.lit(""))).alias("markdown"))
    c = chunking.chunks(medallion.spread(d), size=1_000_000)
    return c.select("chunk_id", "heading_context", "content", "token_estimate", "char_count")


# --- classification


@_query
def topic_hits(spark, sf_dir):
    d = medallion.spread(table(spark, sf_dir, "documents")).select("doc_id", classify.topic_keywords(F.lower("text"), TOPICS).alias("found"))
    d = d.select("doc_id", *(n.alias(t) for t, n in classify.topic_hits(F.col("found"), TOPICS).items()))
    topic, most = classify.best_topic({t: F.col(t) for t in TOPICS})
    return d.select("doc_id", *TOPICS, topic.alias("best"), most.alias("most"))


def _judged(spark, sf_dir) -> DataFrame:
    d = medallion.spread(table(spark, sf_dir, "documents"))
    titles = F.element_at(F.array(F.lit("Nghi Dinh 100 2019 ND-CP"), F.lit("Nghi Dinh 67 2023"), F.lit("Tin")), (F.pmod("doc_id", F.lit(11)) % 3 + 1).cast("int"))
    extra = F.when(F.pmod("doc_id", F.lit(7)) == 0, " Điều 5. Vượt xe trên đường").when(F.pmod("doc_id", F.lit(5)) == 0, " mức phí").otherwise("")
    d = d.select("doc_id", F.concat(F.coalesce("text", F.lit("")), extra).alias("content"), F.array(titles).alias("heading_path"), F.col("source").alias("category"), F.col("doc_id").alias("ord"))
    return medallion.verdicts(d, Config(topics=TOPICS, core=CORE))


@_query
def gold_cascade(spark, sf_dir):
    return _judged(spark, sf_dir).select("doc_id", "admitted", "topic", "consultation_score", "reason")


@_query
def gold_drop_reasons_top10(spark, sf_dir):
    return report.top_reasons(_judged(spark, sf_dir).filter("not admitted"), "reason", "ord")


@_query
def gold_report(spark, sf_dir):
    j = _judged(spark, sf_dir)
    return j.agg(F.count("*").alias("total"), F.count_if("admitted").alias("admitted"), report.share(F.count_if("admitted"), F.count("*")).alias("retention"))


def taxonomy_rows() -> list[tuple[str, str]]:
    """(words, category) that are dealt out to documents."""
    rows = [(words[i % len(words)] + " " + words[-1 - i], topic) for topic, words in fixed.TOPICS.items() for i in range(5)]
    return [*rows, ("Điều 8. Nhường đường cho xe", "luat"), ("không liên quan", "x"), ("không liên quan", "faq"), ("không liên quan", "thu_tuc_phap_ly")]


@_query
def real_taxonomy(spark, sf_dir):
    """The shipped rule tables over whole texts, each with some of their own words at its end."""
    rows = taxonomy_rows()
    at = (F.pmod("doc_id", F.lit(len(rows))) + 1).cast("int")
    dealt = lambda i: F.element_at(F.array(*(F.lit(r[i]) for r in rows)), at)
    d = medallion.spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("ord"), F.concat(F.coalesce("text", F.lit("")), F.lit(" "), dealt(0)).alias("content"), F.array().cast("array<string>").alias("heading_path"), dealt(1).alias("category"))
    return medallion.verdicts(d).select("ord", "admitted", "topic", "consultation_score", "reason")


@_query
def doc_existence_or_rule(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    docs = d.select("doc_id", F.concat_ws(" ", "source", F.when(F.pmod("doc_id", F.lit(13)) == 0, F.lit("Cho vay"))).alias("title"), F.lit("x").alias("source_id"), F.col("source").alias("category"))
    chunks = l.filter("quality = 1 and toxic = 0").select("doc_id")
    return medallion.gold_documents(docs, chunks, Config(core=CORE)).select("doc_id", "title")


# --- duplicates


@_query
def exact_chunk_dedup(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("ord", F.col("doc_id"))
    path = F.transform(F.sequence(F.lit(1), (F.pmod("doc_id", F.lit(3)) + 1).cast("int")), lambda i: F.lit("h"))
    c = d.select("ord", F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("content"), F.lit("").alias("raw_chunk_text"), path.alias("heading_path"), (F.pmod("doc_id", F.lit(2)) / 2).alias("consultation_score"))
    out = dedup.exact_chunks(c)
    return out.select("ord", "doc_id", "consultation_score", F.array_join("duplicate_doc_sources", ",").alias("sources"), "duplicate_count")


def _items(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", "lang", F.lower("text").alias("text"))
    # by digest: a text is shuffled once, not as key and row
    return dedup.first_by(d, F.unhex(F.sha2("text", 256)), "doc_id").select(F.col("doc_id").alias("item"), F.col("lang").alias("topic"), "text")


@_query
def jaccard_pairs(spark, sf_dir):
    return dedup.similar_pairs(_items(spark, sf_dir), 0.5).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@_query
def near_dedup_greedy(spark, sf_dir):
    return dedup.greedy_keep(dedup.similar_pairs(_items(spark, sf_dir), 0.5))


@_query
def near_dedup_strict(spark, sf_dir):
    return dedup.greedy_keep(dedup.similar_pairs(_items(spark, sf_dir), 0.9))


@_query
def near_dedup_merge(spark, sf_dir):
    """Whole near-duplicate removal of chunks with provenance."""
    i = _items(spark, sf_dir)
    c = i.select(F.col("item").alias("ord"), F.col("item").cast("string").alias("doc_id"), "topic", F.col("text").alias("content"), F.col("text").alias("raw_chunk_text"), F.array(F.col("item").cast("string")).alias("duplicate_doc_sources"))
    out = dedup.near_chunks(c, 0.5)
    return out.select("ord", F.array_join("duplicate_doc_sources", ",").alias("sources"), "near_duplicate_merged")


# --- questions and answers, pages, addresses


@_query
def faq_forward_fill(spark, sf_dir):
    """The question before each answer, carried forward within its conversation."""
    c = table(spark, sf_dir, "conversations").withColumn("q", F.when(F.col("role") == "user", F.coalesce("text", F.lit(""))))
    f = faq.carry_forward(c, "q", "conv_id", "turn", "question", "none")
    return f.filter("role = 'assistant'").select("conv_id", "turn", "question", F.col("text").alias("answer"))


@_query
def faq_group_concat(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("q", F.when(F.col("role") == "user", F.coalesce("text", F.lit(""))))
    f = faq.carry_forward(c, "q", "conv_id", "turn", "question", "none").filter("role = 'assistant'")
    category, sub = F.concat(F.lit("c"), F.pmod("conv_id", F.lit(3)).cast("string")), F.concat(F.lit("s"), F.pmod("conv_id", F.lit(5)).cast("string"))
    i = f.select(F.col("conv_id").alias("page"), F.col("turn").alias("pos"), "question", F.coalesce("text", F.lit("")).alias("answer_markdown"), category.alias("category"), sub.alias("subcategory"))
    i = i.withColumn("doc_id", faq.slug_id(F.col("category"), F.col("subcategory")))
    return faq.documents(i).select("doc_id", "category", "subcategory", F.md5("content").alias("digest"), F.length("content").alias("n_chars"), "total_questions")


@_query
def name_tags(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("t"))
    return c.select("conv_id", "turn", F.array_join(faq.tags(F.col("t"), F.lit("Und"), ["The ", "Que", "un", "zzz"]), ",").alias("tags"))


@_query
def page_article(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.article_text(F.col("html")).alias("article"))


@_query
def page_main(spark, sf_dir):
    """Main content by blocks of text and links, the paragraphs of the article where that is short."""
    p = table(spark, sf_dir, "pages").select("page_id", html.main_markdown(F.col("html")).alias("main"), html.article_text(F.col("html")).alias("article"))
    return p.select("page_id", F.when(F.length(text.strip(F.coalesce("main", F.lit("")))) < 100, F.col("article")).otherwise(F.col("main")).alias("content"))


@_query
def page_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))).alias("nth", "href"))
    kept = p.filter(~text.contains_any(F.lower("href"), fixed.TWO_WHEELERS) & F.exists(F.array(*map(F.lit, ["/t", "/a", "/d", "http"])), lambda k: F.contains("href", k)))
    return kept.select("page_id", "nth", text.absolute(F.col("href"), "https://example.org").alias("link"))


@_query
def url_parse_slug(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    h, path = text.host(F.col("url")), F.try_parse_url("url", F.lit("PATH"))
    s = text.slug(F.btrim(path, F.lit("/")))
    h_ = F.replace(h, F.lit("."), F.lit("_"))
    return p.select("page_id", h.alias("host"), F.when(s != "", F.concat_ws("_", h_, s)).otherwise(h_).alias("slug"))


@_query
def url_validity(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    category = F.element_at(F.array(F.lit(fixed.PRICE_CATEGORY), F.lit(fixed.SPEC_CATEGORY), F.lit("khac")), (F.pmod("page_id", F.lit(3)) + 1).cast("int"))
    title = F.when(F.pmod("page_id", F.lit(17)) == 0, F.lit("Xe máy mới")).when(F.pmod("page_id", F.lit(19)) == 0, F.lit("")).otherwise(F.lit("Tin"))
    return p.select("page_id", classify.url_is_valid(title, F.col("url"), category, official="blog").alias("valid"))


SEEDS = [("Tin một", "https://seed.example/one", "khac", 1), ("Xe máy", "https://seed.example/two", "khac", 2), ("Tin một", "https://seed.example/one", "khac", 3), ("", "https://seed.example/three", "khac", 4)]


def _discovered(spark, sf_dir):
    seeds = spark.createDataFrame(SEEDS, "title string, url string, category string, ord long")
    found = table(spark, sf_dir, "pages").select(F.concat(F.lit("Tin "), F.col("page_id").cast("string")).alias("title"), F.regexp_replace("url", r"[?#].*", "").alias("url"), F.lit("khac").alias("category"), F.col("page_id").alias("ord"))
    return crawl.discovered(seeds, found)


@_query
def url_discovery(spark, sf_dir):
    return _discovered(spark, sf_dir).select("title", "url", "rank", "ord")


@_query
def crawl_plan_status(spark, sf_dir):
    manifest = table(spark, sf_dir, "documents").select(F.concat(F.lit("Tin_"), F.col("doc_id").cast("string"), F.lit(".html")).alias("file"))
    return crawl.crawl_plan(_discovered(spark, sf_dir), manifest).select("file", "url", "status")


@_query
def crawl_page_cap(spark, sf_dir):
    none = table(spark, sf_dir, "documents").select(F.lit("").alias("file"))
    return crawl.crawl_plan(_discovered(spark, sf_dir), none, max_pages=20).select("file", "rank", "ord", "status")


@_query
def print_manifest_paths(spark, sf_dir):
    """A manifest of documents against files: in the folder of their source where a label is known, or at the top by a page's number."""
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))
    manifest = d.select("doc_id", F.col("source").alias("category"), F.concat(F.lit("any/"), name).alias("relative_path"))
    below = d.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id").select(F.concat_ws("/", "source", name).alias("path"))
    top = table(spark, sf_dir, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".pdf")).alias("path")).distinct()
    return crawl.located_prints(manifest, below.unionByName(top)).select("doc_id", "path")


@_query
def gold_output_order(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("topic"), F.col("doc_id").alias("ord"))
    return crawl.output_order(d).select("doc_id", "topic", "topic_ord")


@_query
def fetch_outcomes(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", crawl.fetch_status(F.col("html"), F.nullif("url", F.lit("")), 500).alias("status"))


@_query
def url_first_seen(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", r"[?#].*", "").alias("address"))
    return dedup.first_by(p.withColumn("host", F.try_parse_url("address", F.lit("HOST"))), "host", "page_id").select("page_id", "address")


@_query
def manifest_anti_upsert(spark, sf_dir):
    from ..sources.files import upsert_manifest

    new = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), "source")
    old = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file"), F.lit("labelled").alias("source"))
    return upsert_manifest(old, new)


@_query
def manifest_inner(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id", "source").join(l, "doc_id").select("doc_id", "source", "quality")


# --- relational tables


@_query
def catalog_left_default(spark, sf_dir):
    """Documents with the label that some of them have, else a name of their own."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    named = l.groupBy("doc_id").agg(F.max(F.concat_ws(" ", F.lit("quality"), F.col("quality").cast("string"))).alias("label"))
    j = d.groupBy("doc_id").agg(F.count("*").alias("n")).join(named, "doc_id", "left")
    return j.select("doc_id", F.coalesce("label", F.concat(F.lit("document "), F.col("doc_id").cast("string"))).alias("name"), "n")


@_query
def cross_fee_matrix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    priced = p.select(F.col("p_partkey").alias("car_id"), F.col("p_name").alias("car_name"), F.col("p_type").alias("trim_name"), F.lit("-").alias("battery_option"), F.when(F.col("p_size") > 5, F.floor(F.col("p_retailprice") * 1000)).otherwise(0).cast("long").alias("price_vat_vnd"), F.lit("t").alias("snapshot_datetime"))
    return relational.cost_matrix(priced).drop("snapshot_datetime", "battery_option")


@_query
def deposit_tier(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    vnd = F.floor(F.col("o_totalprice") * 5000).cast("long")
    return o.select("o_orderkey", vnd.alias("price"), relational.deposit(vnd).alias("deposit"))


@_query
def price_falsy_chain(spark, sf_dir):
    """Prices as text, missing, zero, broken or whole, from the part's columns."""
    p = table(spark, sf_dir, "part")
    size, retail = F.col("p_size"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    value = F.when(size % 5 == 0, "0").when(size % 5 == 1, "").when(size % 5 == 2, F.lit(None)).when(size % 5 == 3, F.col("p_name")).otherwise(retail)
    base = F.when(size % 3 == 0, F.lit(None)).when(size % 3 == 1, retail).otherwise(F.concat(size.cast("string"), F.lit("e3")))
    return p.select("p_partkey", relational.price(value, base).alias("price_vnd"))


@_query
def label_left_zero(spark, sf_dir):
    labels = spark.createDataFrame([("en",), ("fr",), ("de",), ("es",), ("vi",)], "lang string")
    return report.labelled_counts(labels, table(spark, sf_dir, "documents"), "lang")


@_query
def union_sources_ordered(spark, sf_dir):
    parts = [("documents", "doc_id"), ("pages", "page_id"), ("conversations", "conv_id")]
    out = None
    for rank, (name, key) in enumerate(parts):
        d = table(spark, sf_dir, name).select(F.lit(rank).alias("source_rank"), F.col(key).alias("id"))
        out = d if out is None else out.unionByName(d)
    return out.groupBy("source_rank").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


@_query
def head_n(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").orderBy("doc_id").limit(2)


@_query
def json_nav_explode(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    return e.select("event_id", F.try_variant_get("v", "$.k", "string").alias("k"), F.coalesce(F.length("props"), F.lit(0)).alias("n_chars"))


@_query
def json_map_lookup(spark, sf_dir):
    """Editions of a model looked up by name: keys are data. A document a part, of its columns."""
    p = table(spark, sf_dir, "part").select("p_partkey", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("p_brand", "p_type", "p_name", "p_size")))
    doc = F.format_string('{"%s":{"listEdition":["%s","small one","none"],"%s":{"label":"%s","priceValue":%s},"small one":{"priceValue":7}},"empty":{"listEdition":[]}}', "p_brand", "p_type", "p_type", "p_name", "p_size")
    d = p.select("p_partkey", F.explode(F.try_variant_get(F.try_parse_json(doc), "$", "map<string,variant>")).alias("model", "x"))
    d = d.withColumn("m", F.try_variant_get("x", "$", "map<string,variant>")).withColumn("edition", F.explode(F.try_variant_get("x", "$.listEdition", "array<string>")))
    y = F.try_element_at("m", F.col("edition"))
    return d.select("p_partkey", "model", "edition", F.coalesce(F.try_variant_get(y, "$.label", "string"), F.col("edition")).alias("label"), F.coalesce(F.try_variant_get(y, "$.priceValue", "bigint"), F.lit(0)).alias("price"))


@_query
def lineitem_by_flag(spark, sf_dir):
    """Partial and final aggregates over the largest table."""
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@_query
def semi_and_anti(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    big = o.filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(big, "c_custkey", "left_semi").select("c_custkey", F.lit("with").alias("kind")).unionByName(c.join(big, "c_custkey", "left_anti").select("c_custkey", F.lit("without").alias("kind")))


@_query
def running_window(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.row_number().over(w).alias("nth"), F.round(F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)), 4).alias("running"))


@_query
def file_sizes(spark, sf_dir):
    n: Column = F.col("n_chars") * 37
    return table(spark, sf_dir, "documents").select("doc_id", report.human_size(n).alias("size"))


@_query
def printed_pages(spark, sf_dir):
    """Line shaping of printed pages."""
    pages = ["Trang 1 / 3\nChương II Quy định\n9/30/26, 12:16 PM about: blank\nĐiều 4. Phạm vi\nnội dung một", "- 2 -\n3/7\n\nPage 4 of 9\nnội dung hai about: blank", "  \n", "cuối"]
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.array(*map(F.lit, pages)), F.array(F.coalesce("text", F.lit("")))).alias("pages"), F.lit("Tài liệu").alias("title"))
    return d.select("doc_id", text.printed_markdown(F.col("pages"), F.col("title")).alias("markdown"))
