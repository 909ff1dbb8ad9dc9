"""Batches by day give what one run over all of them gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataloom.plans import medallion, queries
from strataloom.sources import files
from strataloom.streaming.incremental import Increments


def shown(df):
    cols = sorted(c for c in df.columns if c != "batch")
    return sorted(str([r[c] for c in cols]) for r in df.collect())


@pytest.fixture(scope="module")
def bronze(spark, sf, tmp_path_factory):
    """Documents with some copies far apart; a middle batch has copies of earlier ``ord`` that come late."""
    b = queries.bronze(spark, sf)
    copies = b.filter("ord % 5 = 0").withColumn("ord", F.col("ord") + 1000)
    early = b.filter("ord % 7 = 0").withColumn("ord", F.col("ord") - 5000)
    path = str(tmp_path_factory.mktemp("bronze") / "b")
    every = b.withColumn("day", F.when(F.col("ord") < 100, 0).otherwise(1)).unionByName(copies.withColumn("day", F.lit(2))).unionByName(early.withColumn("day", F.lit(2)))
    every.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def whole(bronze):
    d = medallion.silver_documents(medallion.cleaned(bronze.drop("day")))
    return shown(d), shown(medallion.silver_chunks(d))


def test_three_days_equal_one_batch(spark, bronze, whole, tmp_path, monkeypatch):
    inc = Increments(spark, str(tmp_path))
    days = [bronze.filter(f"day = {k}").drop("day") for k in range(3)]
    assert inc.ingest(days[0], 0) > 0
    real = files.write_table

    def cut(df, path):
        if path.endswith("state"):
            raise OSError("cut off")
        real(df, path)

    monkeypatch.setattr(files, "write_table", cut)
    with pytest.raises(OSError, match="cut off"):
        inc.ingest(days[1], 1)
    monkeypatch.setattr(files, "write_table", real)
    first = inc.ingest(days[1], 1)
    assert inc.ingest(days[1], 1) == first
    inc.ingest(days[2], 2)
    assert (shown(inc.survivors()), shown(inc.surviving_chunks())) == whole


def test_a_stream_by_micro_batches(spark, bronze, whole, tmp_path):
    for k in range(3):
        bronze.filter(f"day = {k}").drop("day").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(bronze.drop("day").schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        Increments(spark, str(tmp_path / "out")).follow(stream, str(tmp_path / "checkpoint"))
    assert shown(Increments(spark, str(tmp_path / "out")).survivors()) == whole[0]
