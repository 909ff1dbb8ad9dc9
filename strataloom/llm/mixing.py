"""Mixing sources to target weights by entropy balancing.

Documents get rates r between 0 and ``cap`` that meet a token target for every
source and otherwise stay as near to even as can be: they minimise the entropy of documents
sum r ln r + (cap - r) ln(cap - r)  subject to  sum size r = target  for each source.
The solution is an exponential tilt of every document by its size,
r = cap / (1 + exp(-l size / mean size))  with one multiplier l a source: a source that has to shrink
gives up its long documents first, one that has to grow takes them first. No closed form gives l; it is
the root of the convex dual's gradient, found by Newton's method. A round sums gradient and curvature of all
sources over the documents' sizes (partial sums in each task, exact integers, so that reruns
agree to the bit) and moves every multiplier; a bracket around each root takes a step that leaves it
to its middle. Documents count by (source, size), which is all that a rate depends on. It goes on until every
source is within ``TOLERANCE`` of its target, or its bracket within the precision of numbers.

Rates become copies by systematic rounding: with documents of a source in the
order of size, md5 of the id, id, and R the sum of rates up to a document, it gets
floor(R + u) - floor(R - r + u) copies. Neighbours in that order have nearly equal sizes, so a source's tokens miss its
target by about one document. Sums come from a range partitioning and a prefix
sum over partitions: no task holds a whole source.

Defined cases: a null text has no tokens; a null source is a source, ordered last;
sources without tokens have target 0; a null doc_id sorts first; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import drop, materialize, scope

WORD = r"[^\x20\x09-\x0D]+"
#: Where in the unit interval rounding starts; the unit of rates (2^-24: sums of 10^11 rates fit a long).
START, UNIT = 0.381966, 1 << 24
#: Part of a target that may be missed before rounding; sources up to which their table is sent to all tasks.
TOLERANCE, FEW = 1e-7, 65_536


def token_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the whole text), text_hash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def source_targets(sizes: DataFrame, weights: list[float], total_share: float, cap: float) -> DataFrame:
    """source, source_size, target: weights in code point order of the sources,
    repeating; shares of ``total_share`` of all tokens, none above ``cap`` times
    its source, the excess going to the others by weight (a water level)."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (nth % len(weights) + 1).cast("int"))
    t = per_source.withColumn("w", w).withColumn("full", F.lit(cap) * F.col("source_size")).withColumn("q", F.col("full") / F.col("w"))
    by_q = Window.orderBy("q", F.col("source").asc_nulls_last())
    before = by_q.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_q.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = t.withColumn("total", F.lit(total_share) * F.sum("source_size").over(everything))
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("w").over(onward))
    level = F.min_by(F.when(F.col("level") <= F.col("q"), F.col("level")), F.when(F.col("level") <= F.col("q"), F.col("q"))).over(everything)
    return t.withColumn("level", level).select("source", "source_size", F.least("full", F.coalesce(F.col("w") * F.col("level"), F.col("full"))).alias("target"))


def tilted_rate(size: Column, mean: Column, l: Column, cap: float) -> Column:
    """A document's rate under its source's multiplier; sources at their bounds have infinite ones."""
    z = F.least(F.lit(700.0), F.greatest(F.lit(-700.0), -l * size / mean))
    inside = F.lit(float(cap)) / (F.lit(1.0) + F.exp(z))
    return F.when(l == float("inf"), F.lit(float(cap))).when(l == float("-inf"), F.lit(0.0)).otherwise(inside)


def multipliers(sizes: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """(source, source_size, target, mean, l), written: the dual's solution, a row a source.

    Sums are of integers: rates in units of 2^-24 times sizes, as decimals."""
    spark = sizes.sparkSession
    with scope(spark) as results:
        counts = materialize(sizes.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
        means = counts.groupBy(F.col("source").alias("s")).agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
        t = targets.join(means, targets["source"].eqNullSafe(means["s"]), "left").drop("s").withColumn("mean", F.coalesce("mean", F.lit(1.0)))
        fixed = F.when((F.col("source_size") <= 0) | (F.col("target") <= 0), float("-inf")).when(F.col("target") >= F.lit(cap) * F.col("source_size"), float("inf"))
        t = t.withColumn("l", F.coalesce(fixed, F.lit(0.0))).withColumn("lo", F.lit(float("-inf"))).withColumn("hi", F.lit(float("inf"))).withColumn("done", fixed.isNotNull())
        t = materialize(t, "multipliers")
        while not t.filter("not done").isEmpty():
            open_ = t.filter("not done").select(F.col("source").alias("s"), F.col("mean").alias("m"), F.col("l").alias("x"))
            rows = counts.join(open_, counts["source"].eqNullSafe(open_["s"]))
            r = tilted_rate(F.col("size"), F.col("m"), F.col("x"), cap)
            exact = lambda c: F.sum(c.cast("decimal(20,0)") * F.col("n") * F.col("size"))
            part = r * (F.lit(1.0) - r / cap) * F.col("size") / F.col("m")
            sums = rows.groupBy("s").agg(exact(F.round(r * UNIT)).alias("got"), exact(F.round(part * UNIT)).alias("bend"))
            new = t.join(sums, t["source"].eqNullSafe(sums["s"]), "left").drop("s")
            off = F.col("got").cast("double") / UNIT - F.col("target")
            new = new.withColumn("off", off).withColumn("slope", F.col("bend").cast("double") / UNIT)
            new = new.withColumn("lo", F.when(~F.col("done") & (F.col("off") < 0), F.col("l")).otherwise(F.col("lo"))).withColumn("hi", F.when(~F.col("done") & (F.col("off") > 0), F.col("l")).otherwise(F.col("hi")))
            step = F.col("l") - F.col("off") / F.col("slope")
            # inside the bracket Newton's step, else its middle, or outward where it is still open
            middle = F.when(F.col("lo") == float("-inf"), F.least(F.col("l") * 2, F.col("l") - 1)).when(F.col("hi") == float("inf"), F.greatest(F.col("l") * 2, F.col("l") + 1)).otherwise((F.col("lo") + F.col("hi")) / 2)
            bounded = (F.col("slope") > 0) & (step > F.col("lo")) & (step < F.col("hi")) & (F.abs(step - F.col("l")) <= 1 + F.abs("l"))
            done = F.col("done") | (F.abs("off") <= F.lit(TOLERANCE) * F.col("target")) | (F.col("hi") - F.col("lo") <= F.abs("l") * 1e-14)
            new = new.withColumn("now", done).withColumn("l", F.when(F.col("now"), F.col("l")).when(bounded, step).otherwise(middle))
            old, t = t, materialize(new.select("source", "source_size", "target", "mean", "l", "lo", "hi", F.col("now").alias("done")), "multipliers")
            drop(old)
        results.append(t)
    return t.select("source", "source_size", "target", "mean", "l")


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source's row. Up to ``FEW`` sources are sent to all tasks; more are joined with
    rows spread over 16 parts each, so that a large source is no single task's."""
    named = per_source.withColumnRenamed("source", "_s")
    same = rows["source"].eqNullSafe(named["_s"])
    if per_source.limit(FEW + 1).count() <= FEW:
        return rows.join(F.broadcast(named), same).drop("_s")
    named = named.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    salted = rows.withColumn("_own", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(16)).cast("int"))
    return salted.join(named, salted["source"].eqNullSafe(named["_s"]) & (salted["_own"] == named["_salt"])).drop("_s", "_salt", "_own")


def summed(rated: DataFrame) -> DataFrame:
    """``rated`` (with ``units``, a rate in integers) with ``part`` and ``sum``, the units of its source up to the row in its range partition."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, source, total = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            at = []
            for s, u in zip(batch["source"].to_pylist(), batch["units"].to_pylist()):
                total = total + u if (s,) == source else u
                source = (s,)
                at.append(total)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(at, pa.int64())], [*batch.schema.names, "part", "sum"])

    order = ["source", "size", F.md5(F.col("doc_id").cast("string")), "doc_id", "text_hash"]
    schema = ", ".join(f"{n} {t}" for n, t in rated.dtypes) + ", part int, sum bigint"
    return rated.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema)


def mix(docs: DataFrame, weights: list[float], total_share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, rate, copies, taken for every document."""
    with scope(docs.sparkSession) as results:
        sizes = materialize(token_sizes(docs), "sizes")
        solved = multipliers(sizes, source_targets(sizes, weights, total_share, cap), cap)
        rated = _with_source(sizes, solved).withColumn("rate", tilted_rate(F.col("size"), F.col("mean"), F.col("l"), cap))
        rows = materialize(summed(rated.withColumn("units", F.round(F.col("rate") * UNIT).cast("long")).drop("mean", "l")), "rates")
        parts = rows.groupBy("source", "part").agg(F.sum("units").alias("n"))
        earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        # a row for each part of a source: parts and sources, not documents
        before = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        results.append(before := materialize(before, "before"))
        results.append(rows)
    out = rows.join(before, (rows["part"] == before["p"]) & rows["source"].eqNullSafe(before["s"]))
    upto, start = F.col("before") + F.col("sum"), round(START * UNIT)
    whole = lambda c: F.shiftright(c + start, 24)
    copies = whole(upto) - whole(upto - F.col("units"))
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
