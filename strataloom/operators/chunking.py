"""Heading-aware chunking of Markdown, row by row.

One pattern goes over a text once and marks its headings; code fences are consumed whole, so that nothing
inside is one. The text is split at the marks, a fold over the headings keeps the stack of those
open, and sections are packed by a fold over their sentences. All of that happens
inside the row: nothing is shuffled, and a document's columns stay with its chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text

#: Marks before a heading, after its number signs and after its title. A mark's first character in a text is followed by ``_KEPT`` meanwhile.
_MARK, _TITLE, _END, _KEPT = "\x01\x03", "\x01\x04", "\x01\x05", "\x01\x02"
_BLANK = r"[^\S\n]"


def _outline() -> str:
    """A fenced block (group 1), a heading (its signs and title: 2 and 3) or, below 80 characters, a heading of a law (4)."""
    fence = rf"(^{_BLANK}*```(?s:.*?)(?:\n{_BLANK}*```[^\n]*|\z))"
    heading = rf"^{_BLANK}*(#{{1,6}}){_BLANK}+(\S(?:[^\n]*\S)?){_BLANK}*$"
    legal = fixed.LEGAL_HEADING.removeprefix("^").replace(r"\s", _BLANK)
    return rf"(?mdU){fence}|{heading}|^(?={_BLANK}*\S(?:.{{0,77}}\S)?{_BLANK}*$){_BLANK}*(?i:{legal})"


def _with_sections(docs: DataFrame, markdown: str, into: str) -> DataFrame:
    """``docs`` with ``into``: array of (section, heading_path, text), sections without text left out."""
    kept = F.replace(F.col(markdown), F.lit("\x01"), F.lit(_KEPT))
    marked = F.replace(F.regexp_replace(kept, _outline(), f"$1{_MARK}$2{_TITLE}$3$4{_END}"), F.lit(_MARK + _TITLE + _END), F.lit(""))
    parts = F.transform(F.split(marked, _MARK, -1), lambda p: F.split(p, "\x01[\x04\x05]", -1))
    told = lambda x: text.strip(F.replace(x, F.lit(_KEPT), F.lit("\x01")))

    def part(x: Column, i: Column) -> Column:
        level = F.when(F.size(x) == 1, 0).when(x[0] != "", F.length(x[0])).when(F.startswith(F.lower(x[1]), F.lit("chương")), 2).otherwise(3)
        return F.struct(i.alias("section"), level.alias("level"), F.when(F.size(x) > 1, told(x[1])).alias("title"), told(F.element_at(x, -1)).alias("text"))

    start = F.struct(F.array().cast("array<struct<level:int,title:string>>").alias("open"), F.array().cast("array<struct<section:int,heading_path:array<string>,text:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        above = F.filter(s["open"], lambda h: h["level"] < x["level"])
        pushed = F.when(x["level"] > 0, F.array_append(above, F.struct(x["level"].alias("level"), x["title"].alias("title")))).otherwise(s["open"])

        def with_stack(stack: Column) -> Column:
            own = F.struct(x["section"].alias("section"), F.transform(stack, lambda h: h["title"]).alias("heading_path"), x["text"].alias("text"))
            return F.struct(stack.alias("open"), F.when(x["text"] != "", F.array_append(s["out"], own)).otherwise(s["out"]).alias("out"))

        return text.bind(pushed, with_stack)

    # one expression that uses each part of it once: a column between would be computed anew for every use
    return docs.withColumn(into, F.aggregate(F.transform(parts, part), start, step, lambda s: s["out"]))


def sections(docs: DataFrame, doc_id: str = "doc_id", markdown: str = "markdown") -> DataFrame:
    """(doc_id, section, heading_path, text) in document order; sections without text are left out.

    Headings are ``#`` to ``######`` and, below 80 characters, headings of laws
    (chapters at level 2, others at 3), outside code fences. A heading ends those
    of its level and deeper. ``section`` counts the headings before.
    """
    d = _with_sections(docs.select(F.col(doc_id).alias("doc_id"), F.col(markdown).alias("_markdown")), "_markdown", "_s")
    # outer: a plain explode brings a filter on the array's size, which would compute it twice
    return d.select("doc_id", F.explode_outer("_s").alias("s")).filter("s is not null").select("doc_id", "s.section", "s.heading_path", "s.text")


def pack(sentences: Column, size: int, overlap: int, least: int) -> Column:
    """Sentences joined greedily to pieces of about ``size`` characters; a new
    piece starts with the last sentences of the one before, as many as fit in ``overlap``."""
    empty = F.array().cast("array<string>")

    def emit(out: Column, cur: Column) -> Column:
        joined = F.array_join(cur, " ")
        piece = text.strip(joined)
        return F.when(F.length(piece) >= least, F.array_append(out, piece)).otherwise(out)

    def suffix(cur: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(True).alias("open"))

        def step(s: Column, x: Column) -> Column:
            fits = s["open"] & (s["n"] + F.length(x) <= overlap)
            return F.when(fits, F.struct((s["n"] + F.length(x)).alias("n"), (s["k"] + 1).alias("k"), F.lit(True).alias("open"))).otherwise(F.struct(s["n"].alias("n"), s["k"].alias("k"), F.lit(False).alias("open")))

        return F.aggregate(F.reverse(cur), start, step)

    start = F.struct(empty.alias("cur"), F.lit(0).alias("len"), empty.alias("out"))

    def step(s: Column, x: Column) -> Column:
        full = (s["len"] + F.length(x) > size) & (F.size(s["cur"]) > 0)

        def flush(kept: Column) -> Column:
            tail = F.when(kept["k"] > 0, F.slice(s["cur"], F.size(s["cur"]) - kept["k"] + 1, F.greatest(kept["k"], F.lit(1)))).otherwise(empty)
            return F.struct(F.array_append(tail, x).alias("cur"), (kept["n"] + F.length(x)).alias("len"), emit(s["out"], s["cur"]).alias("out"))

        flushed = text.bind(suffix(s["cur"]), flush)
        grown = F.struct(F.array_append(s["cur"], x).alias("cur"), (s["len"] + F.length(x)).alias("len"), s["out"].alias("out"))
        return F.when(full, flushed).otherwise(grown)

    return F.aggregate(sentences, start, step, lambda s: F.when(F.size(s["cur"]) > 0, emit(s["out"], s["cur"])).otherwise(s["out"]))


def chunks(docs: DataFrame, doc_id: str = "doc_id", markdown: str = "markdown", size: int = 512, overlap: int = 80, least: int = 40, keep: tuple[str, ...] = ()) -> DataFrame:
    """(chunk_id, doc_id, chunk_index, heading_path, heading_context, content,
    raw_chunk_text, token_estimate, char_count) and the columns ``keep`` of each document. Sections that fit, and those with a
    table row, are one chunk; none is shorter than ``least``. Rows of ``docs`` are chunked each on its own, whatever their doc_id."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(markdown).alias("_markdown"), F.struct(F.lit(0).alias("_none"), *(F.col(c) for c in keep)).alias("_keep"))
    none = F.array().cast("array<string>")

    def pieces(t: Column) -> Column:
        whole = (F.length(t) <= size) | F.exists(F.split(t, "\n", -1), lambda x: F.startswith(text.strip(x), F.lit("|")))
        alone = F.when(F.length(t) >= least, F.array(t)).otherwise(none)
        return F.when(whole, alone).otherwise(pack(text.sentences(t), size, overlap, least))

    s = _with_sections(own, "_markdown", "_s").drop("_markdown")
    cut = F.flatten(F.transform("_s", lambda x: F.transform(pieces(x["text"]), lambda p: F.struct(x["heading_path"].alias("heading_path"), p.alias("raw_chunk_text")))))
    p = s.select("doc_id", "_keep", F.posexplode_outer(cut).alias("chunk_index", "_c")).filter("_c is not null").select("doc_id", "_keep", "chunk_index", "_c.heading_path", "_c.raw_chunk_text")
    context = F.array_join("heading_path", " > ")
    content = F.when(context != "", F.concat(F.lit("["), context, F.lit("]\n"), "raw_chunk_text")).otherwise(F.col("raw_chunk_text"))
    p = p.withColumn("heading_context", context).withColumn("content", content)
    return p.select(
        F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"), "doc_id", "chunk_index", "heading_path", "heading_context", "content", "raw_chunk_text",
        text.n_words(F.col("content")).alias("token_estimate"), F.length("content").alias("char_count"), *(F.col(f"_keep.{c}").alias(c) for c in keep),
    )
