"""All sources as one bronze table in their fixed order: as a plan of the file functions, and as a Spark data source.

    spark.dataSource.register(BronzeSource)
    spark.read.format("strataloom_bronze").options(**layout.options()).load()

The order is that of the layout: ``ord`` is a source's rank and the place in it. The data source reads manifests on the driver and files in tasks, some files a
partition; filters on ``category`` and ``source_type`` leave out files before any is read. With the option ``mode=errors``
it gives, in place of documents, a row for each file or manifest that cannot be used (columns ``ERRORS``).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..functions import fixed, pdf
from ..functions import html as H
from ..functions.text import _BLANKS
from ..operators import crawl, faq, relational
from . import files

ERRORS = "source_type string, source_file string, reason string"
#: Files that a partition reads.
FILES = 64


@dataclass(frozen=True)
class Articles:
    """Pages that a manifest (``files.MANIFEST``) lists, in a folder."""

    manifest: str
    folder: str
    category: str = "general"
    domain: str = "web"


@dataclass(frozen=True)
class Layout:
    """Where the sources are, in their order: articles, FAQ page, price snapshot, printed documents. What is empty or missing has no documents."""

    articles: list[Articles] = field(default_factory=list)
    faq: str = ""
    snapshot: str = ""
    prints_manifest: str = ""
    prints_folder: str = ""
    brand: str = ""
    domain: str = ""
    faq_url: str = ""
    snapshot_url: str = ""
    names: list[str] = field(default_factory=list)
    #: Take a page's main content by its blocks, and its paragraphs only where that is short.
    main: bool = False

    def options(self) -> dict[str, str]:
        return {"layout": json.dumps(asdict(self))}

    @staticmethod
    def of(options: dict) -> Layout:
        d = json.loads(options["layout"])
        return Layout(**{**d, "articles": [Articles(**a) for a in d["articles"]]})

    @property
    def ranks(self) -> tuple[int, int, int]:
        """Ranks of FAQ, snapshot and prints; those of articles are their places."""
        n = len(self.articles)
        return n, n + 1, n + 2

    def faq_title(self) -> str:
        return " ".join(x for x in ("Hỏi đáp", self.brand) if x) + ": "

    def snapshot_title(self) -> str:
        return " ".join(x for x in ("Bảng giá xe và chi phí lăn bánh", self.brand, "toàn quốc") if x)


SNAPSHOT_ID, SNAPSHOT_CATEGORY = "vehicles_catalog", "gia_xe_va_chi_phi_lan_banh"


def bronze_plan(spark: SparkSession, layout: Layout) -> DataFrame:
    """Bronze documents (``files.BRONZE``) of all sources of a layout, by DataFrame functions."""
    parts, (at_faq, at_snapshot, at_prints) = [], layout.ranks
    null = F.lit(None).cast("string")
    names = [c.split()[0] for c in files.BRONZE.split(", ")]
    empty_to_null = lambda x: F.lit(x or None).cast("string")
    for rank, a in enumerate(layout.articles):
        if files.exists(spark, a.manifest) and files.exists(spark, a.folder):
            parts.append(files.bronze_articles(files.read_json_array(spark, a.manifest, files.MANIFEST), files.read_pages(spark, a.folder, "*"), a.category, a.domain, rank, H.main_markdown if layout.main else None))
    if layout.faq and files.exists(spark, layout.faq):
        pages = files.read_pages(spark, layout.faq, "*").select(F.col("path").alias("page"), F.col("content").alias("html"))
        d = faq.documents(faq.items(pages, layout.names, layout.brand))
        told = F.create_map(F.lit("category"), "category", F.lit("subcategory"), "subcategory", F.lit("total_questions"), F.col("total_questions").cast("string"))
        parts.append(d.select(
            (F.lit(at_faq).cast("long") * (1 << 40) + F.col("first.pos")).alias("ord"), F.col("doc_id").alias("raw_id"), F.lit("faq").alias("source_type"), F.col("first.page").alias("source_file"), F.concat(F.lit(layout.faq_title()), "category", F.lit(" - "), "subcategory").alias("title"),
            empty_to_null(layout.faq_url).alias("url"), F.lit("faq").alias("category"), empty_to_null(layout.domain).alias("domain"), F.col("content").alias("raw_content"), told.alias("raw_metadata"), null.alias("crawled_at"),
        ))
    if layout.snapshot and files.exists(spark, layout.snapshot):
        s = relational.snapshot(spark, layout.snapshot)
        v = relational.vehicles(s, layout.brand, placed=True).agg(F.array_sort(F.collect_list(F.struct("place", "searchable_markdown"))).alias("v"))
        content = F.array_join(F.concat(F.array(F.lit(f"# {layout.snapshot_title()}\n")), F.transform("v", lambda x: x["searchable_markdown"])), "\n\n")
        told = F.create_map(F.lit("total_vehicles"), F.size("v").cast("string"), F.lit("total_provinces"), F.col("provinces").cast("string"))
        whole = F.try_parse_json("content")
        file = files.read_pages(spark, layout.snapshot, "*").select("path", F.coalesce(F.size(F.try_variant_get(whole, "$.objects.provinces", "array<variant>")), F.lit(0)).alias("provinces"), whole.isNotNull().alias("good"))
        # one row by one
        parts.append(v.crossJoin(file.filter("good")).select(
            (F.lit(at_snapshot).cast("long") * (1 << 40)).alias("ord"), F.lit(SNAPSHOT_ID).alias("raw_id"), F.lit("relational_snapshot").alias("source_type"), F.col("path").alias("source_file"), F.lit(f"{layout.snapshot_title()} (Dữ liệu cấu trúc)").alias("title"),
            empty_to_null(layout.snapshot_url).alias("url"), F.lit(SNAPSHOT_CATEGORY).alias("category"), empty_to_null(layout.domain).alias("domain"), content.alias("raw_content"), told.alias("raw_metadata"), null.alias("crawled_at"),
        ))
    if layout.prints_manifest and files.exists(spark, layout.prints_manifest) and files.exists(spark, layout.prints_folder):
        binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(layout.prints_folder)
        root = files.qualified(spark, layout.prints_folder)
        below = binary.select(F.col("path").alias("file"), F.substring("path", F.lit(len(root) + 2), F.length("path")).alias("path"), "content")
        m = files.read_json_array(spark, layout.prints_manifest, files.PRINT_MANIFEST).withColumn("category", F.coalesce("category", F.lit("general")))
        found = crawl.located_prints(m, below.select("path")).join(below, "path").drop("path").withColumnRenamed("file", "path")
        parts.append(files.bronze_prints(found.withColumn("pages", pdf.pdf_pages(F.col("content"))["pages"]), at_prints))
    if not parts:
        return spark.createDataFrame([], files.BRONZE)
    return reduce(DataFrame.unionByName, [p.select(*names) for p in parts])


@dataclass
class Files(InputPartition):
    entries: list[dict]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    path = re.sub(r"^file:(?=/(?!/))", "file://", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _bytes(path: str) -> bytes:
    fs, p = _open(path)
    with fs.open_input_file(p) as f:
        return f.read()


def _is_file(path: str) -> bool:
    fs, p = _open(path)
    return fs.get_file_info(p).type == pafs.FileType.File


def _uri(path: str) -> str:
    """As Spark's readers name a file."""
    return path if ":/" in path else f"file:{path}"


class BronzeReader(DataSourceReader):
    def __init__(self, layout: Layout, errors: bool, each: int):
        self.layout, self.errors, self.each, self.wanted = layout, errors, each, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on category and source type are met by leaving entries out."""
        for f in filters:
            name = getattr(f, "attribute", None)
            if not self.errors and isinstance(f, (EqualTo, In)) and name in (("category",), ("source_type",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name[0]] = self.wanted.get(name[0], values) & values
            else:
                yield f

    def _manifest(self, path: str, kind: str) -> Iterator[tuple[int, dict]]:
        """(place, entry) of a manifest; what is wrong with it becomes an entry of its own."""
        if not path or not _is_file(path):
            return
        try:
            listed = json.loads(_bytes(path).decode())
            if not isinstance(listed, list):
                raise ValueError("no list")
        except ValueError as e:
            yield -1, {"kind": kind, "path": path, "reason": f"manifest: {e}"[:200]}
            return
        for i, x in enumerate(listed):
            if isinstance(x, dict):
                yield i, {"kind": kind, "item": x}
            else:
                yield i, {"kind": kind, "path": path, "reason": f"manifest: entry {i} is no object"}

    def _entries(self) -> Iterator[dict]:
        layout, (at_faq, at_snapshot, at_prints) = self.layout, self.layout.ranks
        place = lambda rank, i: (rank << 40) + i
        for rank, a in enumerate(layout.articles):
            for i, e in self._manifest(a.manifest, "html_article"):
                item = e.get("item")
                if item is not None and not item.get("file"):
                    continue
                own = {} if item is None else {"path": f"{a.folder}/{item['file']}", "category": a.category if item.get("category") is None else item["category"], "domain": a.domain if item.get("domain") is None else item["domain"]}
                yield {"ord": place(rank, i), **e, **own}
        if layout.faq and _is_file(layout.faq):
            yield {"ord": place(at_faq, 0), "kind": "faq", "path": layout.faq, "category": "faq"}
        if layout.snapshot and _is_file(layout.snapshot):
            yield {"ord": place(at_snapshot, 0), "kind": "relational_snapshot", "path": layout.snapshot, "category": SNAPSHOT_CATEGORY}
        for i, e in self._manifest(layout.prints_manifest, "pdf"):
            item = e.get("item")
            if item is not None:
                category, name = "general" if item.get("category") is None else item["category"], (item.get("relative_path") or "").split("/")[-1]
                e = e | {"category": category, "name": name, "path": f"{layout.prints_folder}/{category}/{name}", "other": f"{layout.prints_folder}/{name}"}
            yield {"ord": place(at_prints, i), **e}

    def partitions(self) -> list[Files]:
        fits = lambda e: ("category" not in self.wanted or e.get("category") in self.wanted["category"]) and ("source_type" not in self.wanted or e["kind"] in self.wanted["source_type"])
        entries = [e for e in self._entries() if fits(e)]
        return [Files(entries[i : i + self.each]) for i in range(0, len(entries), self.each)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for e in partition.entries:
            try:
                if "reason" in e:
                    raise ValueError(e["reason"])
                rows = list(_READ[e["kind"]](e, self.layout))
            except (OSError, ValueError, TypeError, AttributeError, KeyError, AssertionError, RecursionError) as error:
                if self.errors:
                    reason = "missing" if isinstance(error, FileNotFoundError) else str(error)
                    yield e["kind"], e.get("path"), (reason or type(error).__name__)[:200]
                continue
            if not self.errors:
                yield from rows


def _told(item: dict, *names: str) -> dict[str, str]:
    return {n: str(item[n]) for n in names if item.get(n) is not None}


def _article(e: dict, layout: Layout) -> Iterator[tuple]:
    item = e["item"]
    if not _is_file(e["path"]):
        raise FileNotFoundError(e["path"])
    html = _bytes(e["path"]).decode("utf-8", "ignore")
    content = H.main_content(html) if layout.main else ""
    if len(content.strip(_BLANKS)) < 100:
        content = H.article(html)
    if content.strip(_BLANKS):
        title = item.get("title")
        if title and not content.startswith("#"):
            content = f"# {title}\n\n{content}"
        yield e["ord"], "_".join(("html", e["domain"], item["file"])), "html_article", _uri(e["path"]), title, item.get("url"), e["category"], e["domain"], content, _told(item, "title", "url", "category", "domain", "file", "bytes", "crawled_at"), item.get("crawled_at")


def _faq(e: dict, layout: Layout) -> Iterator[tuple]:
    category, sub, groups = layout.brand, "Hỏi đáp chung", {}
    for pos, kind, words, _, answer in H.faq_elements(_bytes(e["path"]).decode("utf-8", "ignore")):
        if kind == "category":
            category = words
        elif kind == "subcategory":
            sub = words
        else:
            groups.setdefault((category, sub), []).append((pos, f"### {words}\n\n{answer}\n"))
    for (category, sub), items in groups.items():
        slug = hashlib.md5(f"{category}_{sub}".replace(" ", "_").lower().encode()).hexdigest()[:10]
        content = f"# {category}\n## {sub}\n\n" + "\n".join(b for _, b in items)
        yield e["ord"] + items[0][0], f"faq_doc_{slug}", "faq", _uri(e["path"]), f"{layout.faq_title()}{category} - {sub}", layout.faq_url or None, "faq", layout.domain or None, content, {"category": category, "subcategory": sub, "total_questions": str(len(items))}, None


def _vehicle(m: dict, kind: str, held: dict, brand: str) -> str:
    """A model's description, as ``relational.vehicles`` has it."""
    label = "Ô tô điện" if kind == "cars" else "Xe máy điện"
    d = held.get(m.get("id", "")) or {}
    out = [f"## {label} {f'{brand} ' if brand else ''}{m.get('name') or ''}", f"- **Loại phương tiện**: {label}", f"- **Mã định danh**: `{m.get('id') or ''}`", "", "### Các phiên bản và giá niêm yết:"]
    rows = []
    for code in d.get("listEdition") or []:
        x = d.get(code) or {}
        value = x.get("priceValue") or 0
        price, battery = x.get("price", "0"), x.get("priceWithBattery", value)
        rows.append(f"| {x.get('label', code)} | {price or f'{value:,} đ'} | {f'{battery:,} đ' if battery else 'Theo chính sách'} |")
    out += ["| Phiên bản | Giá thuê pin (VNĐ) | Giá kèm pin (VNĐ) |\n|---|---|---|", *rows] if rows else ["- Liên hệ đại lý hoặc xem thông báo giá mới nhất."]
    out += ["", "### Lệ phí đăng ký và biển số tham khảo:", "- Khu vực 1 (Hà Nội, TP.HCM): 20.000.000 VNĐ (ô tô) / 1.000.000 - 4.000.000 VNĐ (xe máy)", "- Khu vực 2, 3: 1.000.000 VNĐ (ô tô) / 50.000 - 150.000 VNĐ (xe máy)", "- Ô tô điện chạy pin được miễn 100% lệ phí trước bạ theo quy định của Chính phủ."]
    return "\n".join(out)


def _snapshot(e: dict, layout: Layout) -> Iterator[tuple]:
    data = json.loads(_bytes(e["path"]).decode())
    kinds, provinces = data.get("vehicles") or {}, (data.get("objects") or {}).get("provinces") or []
    told = [_vehicle(m, k, kinds.get(k) or {}, layout.brand) for k in ("cars", "bikes") for m in (kinds.get(k) or {}).get("models") or []]
    content = "\n\n".join([f"# {layout.snapshot_title()}\n", *told])
    yield e["ord"], SNAPSHOT_ID, "relational_snapshot", _uri(e["path"]), f"{layout.snapshot_title()} (Dữ liệu cấu trúc)", layout.snapshot_url or None, SNAPSHOT_CATEGORY, layout.domain or None, content, {"total_vehicles": str(len(told)), "total_provinces": str(len(provinces))}, None


def _page_lines(page: str) -> Iterator[str]:
    for line in (x.strip(_BLANKS) for x in page.split("\n")):
        line = "" if re.search(fixed.PAGE_NUMBER, line, re.I) else re.sub(fixed.PRINT_MARK, "", line, flags=re.I).strip(_BLANKS)
        head = "##" if re.search(fixed.CHAPTER, line, re.I) else "###" if re.search(fixed.ARTICLE, line, re.I) else ""
        if line:
            yield f"\n{head} {line}\n" if head else line


def _print(e: dict, layout: Layout) -> Iterator[tuple]:
    path = next((p for p in (e["path"], e["other"]) if _is_file(p)), None)
    if path is None:
        raise FileNotFoundError(e["path"])
    pages, error = pdf.read(_bytes(path))
    if error:
        raise ValueError(error)
    item, name = e["item"], e["name"]
    lines = [f"# {item['title']}\n"] if item.get("title") else []
    for p in pages:
        lines += [*_page_lines(p), ""] if p.strip(_BLANKS) else []
    content = "\n".join(lines).strip(_BLANKS)
    if len(content) >= 100:
        title = item.get("title") or name.replace(".pdf", "").replace("_", " ").title()
        yield e["ord"], f"pdf_{e['category']}_{name}", "pdf", _uri(path), title, None, e["category"], "local_pdf", content, _told({**item, "category": e["category"]}, "title", "category", "relative_path", "size_bytes", "type"), None


_READ = {"html_article": _article, "faq": _faq, "relational_snapshot": _snapshot, "pdf": _print}


class BronzeSource(DataSource):
    """The sources of a layout (option ``layout``); ``mode``: documents or errors; ``files``: files a partition."""

    @classmethod
    def name(cls) -> str:
        return "strataloom_bronze"

    def schema(self) -> str:
        return ERRORS if self.options.get("mode") == "errors" else files.BRONZE

    def reader(self, schema) -> BronzeReader:
        return BronzeReader(Layout.of(self.options), self.options.get("mode") == "errors", int(self.options.get("files", FILES)))


def read_bronze(spark: SparkSession, layout: Layout, mode: str = "documents") -> DataFrame:
    """The data source's table, with its filters pushed down."""
    spark.dataSource.register(BronzeSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("strataloom_bronze").options(**layout.options(), mode=mode).load()
