"""Connected components of an edge table, with DataFrame operations only."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import drop, materialize, scope


def connected_components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: of one type that has an order), written; component is the
    least node reachable.

    Alternating large-star and small-star steps (Kiveris et al. 2014): edges never
    grow, and a few rounds suffice whatever the shape. It goes on until nothing
    changes; with ``rounds``, going beyond that many is an error. Each round's edges are
    written to the shared folder, and the round's before are deleted. A hub's edges are only ever joined with the
    hub's one aggregated row, never gathered. Loops, repeated edges and nulls are
    harmless; no edges give no rows.
    """
    with scope(edges.sparkSession) as results:
        e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
        e, before = materialize(e, "edges"), None
        for done in count(1):
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            # the larger neighbours of each node move to the least of its neighbourhood; here u > v, so they are its rows as v
            large = e.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            old, e = e, materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
            drop(old)
            now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
            if now == before:
                break
            if done == rounds:
                raise RuntimeError(f"components have not settled in {rounds} rounds")
            before = now
        roots = e.select(F.col("v").alias("node")).distinct()
        out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
        results.append(out := materialize(out, "classes"))
    return out
