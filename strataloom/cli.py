"""Command line:  python -m strataloom.cli crawl|bronze|silver|gold|run|stats|sample --root FOLDER [--layout FILE]"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from .plans.medallion import Config
from .plans.orchestrator import Orchestrator
from .sources.bronze import Layout
from .sources.files import read_report


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strataloom", description="Layers of a text corpus.")
    sub = p.add_subparsers(dest="command", required=True)
    every = (("crawl", "what is to be fetched"), ("bronze", "files to bronze"), ("silver", "bronze to silver"), ("gold", "silver to gold"), ("run", "all layers"), ("stats", "rows, files and bytes of all tables"), ("sample", "first rows of a table"))
    for name, what in every:
        c = sub.add_parser(name, help=what)
        c.add_argument("--root", required=True, help="folder of the layers")
        if name in ("bronze", "silver", "gold", "run"):
            c.add_argument("--layout", required=name == "bronze", help="JSON file that names the sources (the fields of sources.bronze.Layout)")
        if name == "crawl":
            c.add_argument("--sources", required=True, help="address list, CSV")
            c.add_argument("--manifest", required=True, help="manifest of what has been fetched, JSON")
            c.add_argument("--max-pages", type=int)
        if name in ("silver", "run"):
            c.add_argument("--chunk-size", type=int, default=Config.chunk_size)
            c.add_argument("--overlap", type=int, default=Config.chunk_overlap)
            c.add_argument("--keep-duplicates", action="store_true")
        if name in ("gold", "run"):
            c.add_argument("--threshold", type=float, default=Config.dedup_threshold)
            c.add_argument("--no-exact", action="store_true")
            c.add_argument("--no-near", action="store_true")
        if name == "sample":
            c.add_argument("--layer", choices=["silver", "gold"], default="gold")
            c.add_argument("--table", choices=["documents", "chunks"], default="chunks")
            c.add_argument("-n", type=int, default=3)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict | list:
    """Run a command, print its result as JSON and return it."""
    a = vars(parser().parse_args(argv))
    names = {"chunk_size": "chunk_size", "overlap": "chunk_overlap", "threshold": "dedup_threshold"}
    config = replace(Config(), **{field: a[flag] for flag, field in names.items() if flag in a})
    config = replace(config, deduplicate=not a.get("keep_duplicates", False), dedup_exact=not a.get("no_exact", False), dedup_near=not a.get("no_near", False))
    spark = spark or SparkSession.builder.appName("strataloom").getOrCreate()
    layout = Layout.of({"layout": json.dumps({"articles": []} | read_report(spark, a["layout"]))}) if a.get("layout") else None
    o = Orchestrator(spark, a["root"], config, layout)
    todo = {"crawl": lambda: o.run_crawl(a["sources"], a["manifest"], a["max_pages"]), "bronze": o.run_bronze, "silver": o.run_silver, "gold": o.run_gold, "run": o.run_all, "stats": o.stats, "sample": lambda: o.sample(a["layer"], a["table"], a["n"])}
    out = todo[a["command"]]()
    json.dump(out, sys.stdout, ensure_ascii=False, indent=2, default=str)
    print()
    return out


if __name__ == "__main__":
    main()
