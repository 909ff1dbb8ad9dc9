"""Main content: marked pages, and the choice against scores computed from scratch."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from strataloom.functions import html as H
from strataloom.plans import queries


def words(rng, mark, n):
    return " ".join(f"{mark}{rng.randrange(10**6):06d}" + ("," if rng.random() < 0.1 else "") for _ in range(n))


def page(rng):
    """Words of the main content begin with m, all others with b."""
    links = lambda n: "".join(f'<li><a href="/{i}">{words(rng, "b", rng.randint(1, 6))}</a></li>' for i in range(n))
    block = rng.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}</b></p>", "<blockquote>{}</blockquote>"])
    main = "".join(block.format(words(rng, "m", rng.randint(12, 90))) for _ in range(rng.randint(3, 15)))
    main = f"<h1>{words(rng, 'm', 5)}</h1>{main}" + ("<ul>" + "".join(f"<li>{words(rng, 'm', 9)}</li>" for _ in range(4)) + "</ul>" if rng.random() < 0.5 else "")
    if rng.random() < 0.5:
        main = main.replace("</p><p>", f"</p><div class='ad'>{words(rng, 'b', 12)}</div><p>", 1)
    for _ in range(rng.randint(0, 3)):
        main = f"<div class='x{rng.randrange(9)}'>{main}</div>"
    main = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div id=c>{}</div>", "<td>{}</td>"]).format(main)
    side = f"<div class='sidebar'><h3>{words(rng, 'b', 3)}</h3><p>{words(rng, 'b', 30)}</p></div>" + f"<div class=links><ul>{links(12)}</ul></div><div><p>{words(rng, 'b', 8)}</p></div>"
    parts = [f"<header>{words(rng, 'b', 9)}</header><nav><ul>{links(9)}</ul></nav>", main, side]
    if rng.random() < 0.5:
        parts[1:] = parts[:0:-1]
    return f"<html><head><title>{words(rng, 'b', 4)}</title><script>var x='<p>b1';</script></head><body>{''.join(parts)}<footer>{words(rng, 'b', 20)}</footer></body></html>"


def test_recall_and_precision_on_marked_pages():
    rng = random.Random(7)
    found = wanted = other = 0
    for _ in range(300):
        h = page(rng)
        got, marked = set(re.findall(r"[mb]\d{6}", H.main_content(h))), set(re.findall(r"m\d{6}", h))
        found += len(got & marked)
        wanted += len(marked)
        other += len(got - marked)
    print("recall", found / wanted, "precision", found / (found + other))
    assert found / wanted > 0.98 and found / (found + other) > 0.98


def scratch(root):
    """Scores of all holders, each by a search of its own."""
    def text(x):
        return sum(len(" ".join(c.split())) if isinstance(c, str) else text(c) for c in x.children)

    def linked(x):
        return text(x) if x.tag == "a" else sum(linked(c) for c in x.children if isinstance(c, H.Node))

    def holders(x, above):
        if x.tag in H.HOLDERS:
            above = [x, *above]
            yield x, 0
        inner = [c for c in x.children if isinstance(c, H.Node)]
        if (x.tag in H.TEXT_BLOCKS or (x.tag in H.HOLDERS and not any(c.tag in H.HOLDERS | H.TEXT_BLOCKS for c in inner))) and text(x) >= 25 and linked(x) < text(x) / 2:
            for far, a in enumerate(above[:5]):
                yield a, (text(x) - linked(x)) / (far + 1)
        for c in inner:
            if not H._beside(c):
                yield from holders(c, above)

    total: dict = {}
    for x, v in holders(root, []):
        total[x] = total.get(x, 0) + v
    return {x: v * (1 - linked(x) / max(text(x), 1)) for x, v in total.items()}


def test_the_choice_is_that_of_scores_from_scratch(spark, sf):
    rng = random.Random(8)
    pages = [page(rng) for _ in range(40)] + [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    for h in pages:
        root = H.tree(h or "")
        H._prune(root)
        want, top = scratch(root), H.main_node(root)
        most = max(want.values(), default=0)
        assert (top is None and most == 0) or abs(want[top] - most) < 1e-6


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>" + "chữ " * 30 + "</p>"
    rows = [(0, None), (1, ""), (2, "<p>x"), (3, "<a href=x>" + "liên kết " * 50 + "</a>"), (4, deep), (5, "a" * 500_000), (6, "<body><p>" + "từ " * 40 + "<p>" + "sau " * 40)]
    got = {r.i: r.m for r in spark.createDataFrame(rows, "i int, h string").select("i", H.main_markdown(F.col("h")).alias("m")).collect()}
    assert got[0] is None and got[1] == got[2] == got[3] == got[5] == ""
    assert "chữ" in got[4] and "từ" in got[6] and "sau" in got[6]


def test_query_covers_all_pages(spark, sf):
    got = {r.page_id: r.content for r in queries.page_main(spark, sf).collect()}
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert set(got) == set(pages) and all(v or not H.article(pages[k]) for k, v in got.items()) and sum(map(bool, got.values())) >= 0.9 * len(pages)


def test_pages_come_to_python_a_few_at_a_time(spark, sf):
    """No Arrow batches of up to 10,000 whole pages, each of which a worker holds."""
    for name in ("page_article", "page_main"):
        plan = queries.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
