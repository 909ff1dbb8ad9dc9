"""Text functions, Column to Column, inside whole-stage code wherever Spark has the operation.

Python's ``\\s`` and ``strip`` know all Unicode white space; ``(?U)`` gives Java's
patterns the same. Lengths are in code points.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed

#: All white space of Unicode, as (?U)\\s has it.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_LETTER = r"a-zA-Z\u00C0-\u1EF9"
#: Combining marks, Hangul jamo, and characters whose composed form is another one; all from U+0300 on, by one comparison in most texts.
_MAY_CHANGE = r"(?=[\u0300-\x{10FFFF}])[\p{M}\u0340-\u0344\u0374\u037E\u0387\u0958-\u095F\u09DC-\u09DF\u0A33-\u0A5E\u0B5C\u0B5D\u0F43-\u0FB9\u1100-\u11FF\u1F71-\u1FFD\u2000\u2001\u2126\u212A\u212B\u2329\u232A\u2ADC\uF900-\uFAFF\uFB1D-\uFB4E\x{1D15E}-\x{1D1C0}\x{2F800}-\x{2FA1D}]"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(_BLANKS))


def words(c: Column) -> Column:
    """The white-space-separated words."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def n_words(c: Column) -> Column:
    return F.coalesce(F.size(words(c)), F.lit(0))


# plain UDFs, not Arrow batches of up to 10,000 whole texts: a worker holds a hundred rows
@F.udf(returnType=T.StringType(), useArrow=False)
def _nfc(t):
    import unicodedata

    return None if t is None else unicodedata.normalize("NFC", t)


def nfc(c: Column) -> Column:
    """Canonical composition. Python sees only texts that may need it."""
    return F.coalesce(_nfc(F.when(c.rlike(_MAY_CHANGE), c)), c)


def modern_tones(c: Column, pairs: list[tuple[str, str]] = fixed.TONES) -> Column:
    """Old placements of tone marks replaced, pair after pair; texts without any are left alone."""
    out = c
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    # what begins alike is one branch
    ends: dict[str, str] = {}
    for old, _ in pairs:
        ends[old[:-1]] = ends.get(old[:-1], "") + f"\\x{{{ord(old[-1]):x}}}"
    return F.when(c.rlike("|".join(f"{begin}[{last}]" for begin, last in ends.items())), out).otherwise(c)


def typography(c: Column) -> Column:
    """Quotes, dashes and blanks as in ASCII; spaces around punctuation; white space tidied."""
    t = F.translate(c, fixed.TYPOGRAPHY_FROM + fixed.TYPOGRAPHY_REMOVED, fixed.TYPOGRAPHY_TO)
    t = F.replace(t, F.lit("…"), F.lit("..."))
    t = F.regexp_replace(t, r"(?U)\s+([,.:;?!%])", "$1")
    t = F.regexp_replace(t, f"([{_LETTER}])([,;:])([{_LETTER}])", "$1$2 $3")
    t = F.regexp_replace(t, rf"([{_LETTER}]{{2,}})\.([A-Z\u00C0-\u1EF9][a-z\u00C0-\u1EF9])", "$1. $2")
    t = F.regexp_replace(t, r"([.,:;?!])([\"'])", "$1 $2")
    t = F.regexp_replace(t, r"(?U)[^\S\r\n]+", " ")
    t = F.regexp_replace(t, r"(?md)^[ \r]+|[ \r]+$", "")
    return F.btrim(F.regexp_replace(t, r"\n{3,}", "\n\n"), F.lit(" \r\n"))


def normalize(c: Column, compose: bool = True) -> Column:
    """Composition (optional: it is the one step that leaves the JVM), tones, typography."""
    return typography(modern_tones(nfc(c) if compose else c))


def strip_boilerplate(c: Column, patterns: tuple[str, ...] = fixed.BOILERPLATE) -> Column:
    """Noise cut out of lines; lines that hold boilerplate or were nothing but
    noise dropped, blank lines kept; at most one blank line in a row."""
    any_of = "(?iU)" + "|".join(f"(?:{p})" for p in patterns)
    noisy = "|".join(f"(?{'U' if cased else 'iU'}:{pattern})" for pattern, cased in fixed.INLINE_NOISE)
    collapse = lambda x: F.regexp_replace(x, r"(?U)\s{2,}", " ")

    def clean(line: Column) -> Column:
        x = line
        for pattern, cased in fixed.INLINE_NOISE:
            x = F.regexp_replace(x, ("(?U)" if cased else "(?iU)") + pattern, "")
        return F.nullif(strip(collapse(x)), F.lit(""))

    # one test tells the lines that need the replacements
    lines = F.transform(F.transform(F.split(c, "\n", -1), strip), lambda x: F.when(x.rlike(noisy), clean(x)).otherwise(collapse(x)))
    kept = F.filter(lines, lambda x: x.isNotNull() & ~x.rlike(any_of))
    return strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def diacritic_ratio(c: Column) -> Column:
    """Share of letters with Vietnamese diacritics; 0 without letters."""
    letters = F.length(c) - F.length(F.regexp_replace(c, r"\p{L}+", ""))
    # a lookup a character; a class of so many characters is tried one after the other
    marked = F.length(c) - F.length(F.translate(c, fixed.DIACRITICS, ""))
    return F.when(letters > 0, marked / letters).otherwise(0.0)


def quality_score(c: Column, ratio: Column, min_ratio: float = 0.03, min_length: int = 50) -> Column:
    """Length, language and structure, 0 to 1, to three places; 0 for short texts."""
    n = F.length(strip(c))
    size = F.least(F.lit(0.3), n / 1000 * 0.3)
    language = F.when(ratio >= 0.08, 0.3).when(ratio >= min_ratio, 0.2).otherwise(0.05)
    has_list = F.contains(c, F.lit("\n- ")) | F.contains(c, F.lit("\n* ")) | F.contains(c, F.lit("\n1. ")) | F.contains(c, F.lit("\n|"))
    point = lambda cond: F.when(cond, 0.1).otherwise(0.0)
    structure = F.lit(0.1) + point(F.contains(c, F.lit("#"))) + point(has_list) + point(F.size(F.split(c, "\n\n", -1)) >= 3)
    return F.when(n < min_length, 0.0).otherwise(F.floor((size + language + structure) * 1000 + 0.5) / 1000)


def quality_gate(c: Column, ratio: Column, min_ratio: float = 0.03, min_length: int = 50) -> Column:
    n = F.length(strip(c))
    return (n >= min_length) & ((ratio >= min_ratio) | (n > 200))


def plain_text(c: Column) -> Column:
    """Lines without marks of Markdown at their ends, joined by blanks."""
    lines = F.filter(F.split(c, "\n", -1), lambda x: strip(x) != "")
    return F.array_join(F.transform(lines, lambda x: F.btrim(x, F.lit("#* -|>"))), " ")


def _honorific() -> str:
    edge = r"(?:^|[^\p{L}\p{N}_./])"
    one = "|".join(fixed.HONORIFICS)
    more = "|".join(h.replace(".", r"\.") for h in fixed.HONORIFICS_DOTTED)
    return rf"(?<!{edge}(?iu:{one})\.)(?<!{edge}(?iu:{more})\.{{1,8}})"


SENTENCE_END = rf"(?<=[.!?…]){_honorific()}[ \t](?U:\s*)(?=[A-ZÀ-ỹ\"'(“‘0-9])"


def sentences(c: Column) -> Column:
    """Sentences in order. Headings, list items, quotations, table rows and code
    fences are units; numbers, acronyms and honorifics do not end a sentence."""

    def of_paragraph(p: Column) -> Column:
        parts = F.filter(F.transform(F.split(p, SENTENCE_END), strip), lambda s: s != "")
        return F.when(p.rlike(r"^[#\-*>|]|^```"), F.array(p)).otherwise(parts)

    paragraphs = F.filter(F.transform(F.split(c, "\n", -1), strip), lambda p: p != "")
    return F.flatten(F.transform(paragraphs, of_paragraph))


def dedup_key(c: Column) -> Column:
    """Lower case, without leading Markdown marks, blanks collapsed."""
    return F.lower(strip(F.regexp_replace(F.regexp_replace(c, r"(?U)^[\s#*\->|]+", ""), r"(?U)\s+", " ")))


def bind(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def shingles(c: Column, k: int = 3) -> Column:
    """Distinct runs of k words (``[\\p{L}\\p{N}_]+``); shorter texts are one; none without words."""

    def runs(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(k)), " "))
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(each))

    return bind(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), runs)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def page_lines(lines: Column) -> Column:
    """Lines of a printed page as Markdown: page numbers and print marks out, chapters and articles as headings."""

    def shape(x: Column) -> Column:
        cleaned = strip(F.regexp_replace(x, f"(?iU){fixed.PRINT_MARK}", ""))
        y = F.when(x.rlike(f"(?iU){fixed.PAGE_NUMBER}"), F.lit("")).otherwise(cleaned)
        return F.when(y.rlike(f"(?iU){fixed.CHAPTER}"), F.concat(F.lit("\n## "), y, F.lit("\n"))).when(y.rlike(f"(?iU){fixed.ARTICLE}"), F.concat(F.lit("\n### "), y, F.lit("\n"))).otherwise(y)

    return F.filter(F.transform(F.transform(lines, strip), shape), lambda x: x != "")


def printed_markdown(pages: Column, title: Column) -> Column:
    """Markdown of an array of page texts; a blank line ends each page that has text."""
    has_text = F.filter(pages, lambda p: strip(F.coalesce(p, F.lit(""))) != "")
    body = F.transform(has_text, lambda p: F.concat(page_lines(F.split(p, "\n", -1)), F.array(F.lit(""))))
    head = F.when(F.coalesce(title, F.lit("")) != "", F.array(F.concat(F.lit("# "), title, F.lit("\n")))).otherwise(F.array().cast("array<string>"))
    return strip(F.array_join(F.concat(head, F.flatten(body)), "\n"))


def contains_any(c: Column, keywords: list[str]) -> Column:
    out = F.lit(False)
    for k in keywords:
        out = out | F.contains(c, F.lit(k))
    return out


@lru_cache(maxsize=16)
def _automaton(keywords: tuple[str, ...]):
    """An Aho-Corasick automaton, one a worker process; a keyword's value is its places."""
    import ahocorasick

    places: dict[str, list[int]] = {}
    for i, k in enumerate(keywords):
        places.setdefault(k, []).append(i)
    out = ahocorasick.Automaton()
    for k, at in places.items():
        out.add_word(k, tuple(at))
    out.make_automaton()
    return out


def found_keywords(c: Column, keywords: list[str]) -> Column:
    """Places in ``keywords`` (none of them empty) of those that the text holds anywhere, each once, ascending.

    One pass of an automaton over the text, whatever the number of keywords; they may overlap, and may be stated twice."""
    words = tuple(keywords)
    if not words:
        return F.when(c.isNotNull(), F.array().cast("array<int>"))

    @F.udf(returnType=T.ArrayType(T.IntegerType()), useArrow=False)
    def places(t):
        if t is None:
            return None
        seen: set[tuple[int, ...]] = {at for _, at in _automaton(words).iter(t)}
        return sorted(i for at in seen for i in at)

    return places(c)


def host(url: Column) -> Column:
    """Host of a URL without ``www.``, lower case."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"www\.", "")


def slug(c: Column) -> Column:
    """Characters beyond letters, digits, ``_`` and ``-`` become ``_``."""
    return F.btrim(F.regexp_replace(c, r"[^a-zA-Z0-9_\-]+", "_"), F.lit("_"))


def absolute(url: Column, base: str) -> Column:
    return F.when(F.startswith(url, F.lit("/")), F.concat(F.lit(base), url)).otherwise(url)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)
