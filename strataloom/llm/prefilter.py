"""A bitmap of fixed size that tells which rows may have a key in another table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits in the bitmap: 65,536 words of 64, some 1 MB when broadcast, whatever the tables' sizes.
BITS = 1 << 22


def _bitmap(df: DataFrame, key: Column, wanted: DataFrame, bits: int) -> tuple[DataFrame, DataFrame, Column]:
    (name,) = wanted.columns
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = wanted.select(slot(F.col(name)).alias("s")).groupBy(F.floor(F.col("s") / 64).alias("_word"))
    words = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("s") % 64).cast("int"))).alias("_bits"))
    marked = df.withColumn("_slot", slot(key)).withColumn("_at", F.floor(F.col("_slot") / 64))
    hit = F.call_function("shiftrightunsigned", F.coalesce("_bits", F.lit(0).cast("long")), (F.col("_slot") % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    # broadcast: at most ``bits`` / 64 rows of two longs
    return marked, F.broadcast(words), hit


def split_by_bitmap(df: DataFrame, key: Column, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """``df`` with a boolean ``may_match``: false only where ``key`` (a long) is not
    in ``wanted`` (one long column). Rows with false need no shuffle to be told apart
    from those that a join with ``wanted`` would find."""
    marked, words, hit = _bitmap(df, key, wanted, bits)
    return marked.join(words, F.col("_at") == F.col("_word"), "left").withColumn("may_match", hit).drop("_slot", "_at", "_word", "_bits")


def keep_by_bitmap(df: DataFrame, key: Column, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``wanted``."""
    marked, words, hit = _bitmap(df, key, wanted, bits)
    return marked.join(words, (F.col("_at") == F.col("_word")) & hit).drop("_slot", "_at", "_word", "_bits")
