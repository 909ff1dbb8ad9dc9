"""HTML to text, FAQ entries and links: UDFs on the standard library's parser, row by row.

Spark hands rows to plain UDFs a hundred at a time, so that a worker's memory does not grow with the rows of a split, as it does
with Arrow batches of up to 10,000 whole pages.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements left out, classes that mark an article's container, and elements that are paragraphs.
SKIPPED = {"script", "style", "nav", "footer", "header", "noscript", "svg", "form"}
CONTAINER_CLASSES = ("article", "content", "post-body", "detail")
BLOCKS = {"h1", "h2", "h3", "p", "li"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):
        """Elements below this one in document order, without recursion."""
        stack = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                yield x
                stack.extend(reversed(x.children))

    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            else:
                stack.extend(reversed(x.children))

    def text(self, sep: str = "") -> str:
        return sep.join(s for s in (x.strip() for x in self.strings()) if s)

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


def _prune(node: Node) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        x.children = [c for c in x.children if isinstance(c, str) or c.tag not in SKIPPED]
        stack.extend(c for c in x.children if isinstance(c, Node))


def article(html: str) -> str:
    """Paragraphs of more than 20 characters of the page's article, a blank line between."""
    root = tree(html)
    _prune(root)
    every = list(root.walk())
    found = next((x for x in every if x.tag == "article"), None)
    found = found or next((x for x in every if any(k in x.attrs.get("class", "").lower() for k in CONTAINER_CLASSES)), None)
    found = found or next((x for x in every if x.tag == "main"), None) or next((x for x in every if x.tag == "body"), None)
    if found is None:
        return ""
    texts = (x.text() for x in found.walk() if x.tag in BLOCKS)
    return "\n\n".join(t for t in texts if len(t) > 20)


def markdown(node: Node) -> str:
    """A fragment as Markdown: ATX headings, lists, emphasis, links, tables."""
    import re

    def inner(x: Node, depth: int) -> str:
        return "".join(re.sub(r"\s+", " ", c) if isinstance(c, str) else show(c, depth) for c in x.children)

    def show(x: Node, depth: int) -> str:
        if depth > 200:
            return x.text(" ")
        body = inner(x, depth + 1)
        if x.tag in {"h1", "h2", "h3", "h4", "h5", "h6"}:
            return f"\n\n{'#' * int(x.tag[1])} {body.strip()}\n\n"
        if x.tag in {"p", "div", "section", "article"}:
            return f"\n\n{body.strip()}\n\n"
        if x.tag in {"b", "strong"}:
            return f"**{body.strip()}**" if body.strip() else ""
        if x.tag in {"i", "em"}:
            return f"*{body.strip()}*" if body.strip() else ""
        if x.tag == "a" and x.attrs.get("href"):
            return f"[{body.strip()}]({x.attrs['href']})"
        if x.tag in {"ul", "ol"}:
            items = [inner(c, depth + 1).strip() for c in x.children if isinstance(c, Node) and c.tag == "li"]
            return "\n\n" + "\n".join(f"{i + 1}. {t}" if x.tag == "ol" else f"* {t}" for i, t in enumerate(items)) + "\n\n"
        if x.tag == "tr":
            return "| " + " | ".join(inner(c, depth + 1).strip() for c in x.children if isinstance(c, Node)) + " |\n"
        return "  \n" if x.tag == "br" else body

    return re.sub(r"\n{3,}", "\n\n", show(node, 0)).strip()


#: Elements that are blocks of text, and those that hold blocks; a block's least length, and the share of its text in links from which it is none.
TEXT_BLOCKS = {"p", "pre", "blockquote", "li", "td", "dd", "h1", "h2", "h3", "h4", "h5", "h6"}
HOLDERS = {"body", "main", "article", "section", "div", "td", "blockquote", "ul", "ol", "table", "tbody", "tr", "dl", "aside"}
LEAST_BLOCK, LINKED = 25, 0.5
#: Words in a class or id of what stands beside the main content.
BESIDE = {"ad", "ads", "advert", "aside", "banner", "breadcrumb", "comment", "comments", "cookie", "menu", "related", "share", "sidebar", "social", "widget"}


def _lengths(root: Node) -> dict[int, tuple[int, int]]:
    """(characters of text, of them in links) below each element, by its identity; without recursion."""
    out, stack = {}, [(root, False)]
    while stack:
        x, done = stack.pop()
        if not done:
            stack.append((x, True))
            stack.extend((c, False) for c in x.children if isinstance(c, Node))
            continue
        own = sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str))
        below = [out[id(c)] for c in x.children if isinstance(c, Node)]
        n = own + sum(b[0] for b in below)
        out[id(x)] = (n, n if x.tag == "a" else sum(b[1] for b in below))
    return out


def _beside(x: Node) -> bool:
    import re

    return bool(BESIDE & set(re.split(r"[^a-z]+", f"{x.attrs.get('class', '')} {x.attrs.get('id', '')}".lower())))


def main_node(root: Node) -> Node | None:
    """The element that holds the main content: of those that hold blocks of text, the one with the most text outside links. A block counts
    whole for the holder around it and for half, a third and so on for those further out; blocks mostly of links do not count,
    and text in links counts against a holder by its share. Of equals the first in the document."""
    size, score, order = _lengths(root), {}, []
    stack = [(root, ())]
    while stack:
        x, above = stack.pop()
        n, linked = size[id(x)]
        if x.tag in HOLDERS:
            score[id(x)] = 0.0
            order.append(x)
            above = (x, *above[:4])
        bare = x.tag in HOLDERS and not any(isinstance(c, Node) and c.tag in HOLDERS | TEXT_BLOCKS for c in x.children)
        if (x.tag in TEXT_BLOCKS or bare) and n >= LEAST_BLOCK and linked < LINKED * n:
            for far, holder in enumerate(above):
                score[id(holder)] += (n - linked) / (far + 1)
        stack.extend((c, above) for c in reversed(x.children) if isinstance(c, Node) and not _beside(c))
    share = lambda x: 1 - size[id(x)][1] / max(size[id(x)][0], 1)
    best = max(order, key=lambda x: score[id(x)] * share(x), default=None)
    return best if best is not None and score[id(best)] > 0 else None


def main_content(html: str) -> str:
    """The main content of a page as Markdown, without parts beside it and blocks of links; empty if there is none."""
    root = tree(html)
    _prune(root)
    top = main_node(root)
    if top is None:
        return ""
    size, stack = _lengths(top), [top]
    while stack:
        x = stack.pop()
        keep = lambda c: isinstance(c, str) or not (_beside(c) or (c.tag in HOLDERS and size[id(c)][1] >= LINKED * max(size[id(c)][0], 1) and size[id(c)][1]))
        x.children = [c for c in x.children if keep(c)]
        stack.extend(c for c in x.children if isinstance(c, Node))
    return markdown(top)


FAQ = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("answer", T.StringType()), T.StructField("answer_markdown", T.StringType())]))
LINKS = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("title", T.StringType())]))


def faq_elements(html: str) -> list[tuple]:
    """Headers (kinds ``category`` and ``subcategory``) and entries (``post``) in document order."""
    out = []
    for x in tree(html).walk():
        if x.tag == "h2" and x.has_class("cat-name"):
            out.append((len(out), "category", x.text(), None, None))
        elif x.tag == "h3" and any("child-name" in c for c in x.attrs.get("class", "").split()):
            out.append((len(out), "subcategory", x.text(), None, None))
        elif x.tag == "div" and x.has_class("post"):
            q = next((n for n in x.walk() if n.tag == "h2" and n.has_class("post-title")), None)
            a = next((n for n in x.walk() if n.tag == "div" and n.has_class("post-content")), None)
            if q is not None and a is not None:
                out.append((len(out), "post", q.text(), a.text(" "), markdown(a)))
    return out


def links(html: str) -> list[tuple]:
    return [(x.attrs["href"].strip(), x.text()) for x in tree(html).walk() if x.tag == "a" and "href" in x.attrs]


def _safe(f, html):
    """A page that cannot be parsed gives null: one bad page never ends a run."""
    if html is None:
        return None
    try:
        return f(html)
    except (ValueError, AssertionError, RecursionError):
        return None


@F.udf(returnType=T.StringType(), useArrow=False)
def article_text(page):
    return _safe(article, page)


@F.udf(returnType=T.StringType(), useArrow=False)
def main_markdown(page):
    return _safe(main_content, page)


@F.udf(returnType=FAQ, useArrow=False)
def faq_of_page(page):
    return _safe(faq_elements, page)


@F.udf(returnType=LINKS, useArrow=False)
def links_of_page(page):
    return _safe(links, page)
