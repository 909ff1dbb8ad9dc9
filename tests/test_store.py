"""Scopes of intermediate tables: side by side, nested, and after errors."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from strataloom import store
from strataloom.sources import files


def test_scopes_of_threads_are_apart(spark):
    """Each thread's inner scope ends while the others' tables are in use."""
    meet = Barrier(3, timeout=120)

    def work(n: int) -> int:
        with store.scope(spark) as results:
            a = store.materialize(spark.range(n), "a")
            meet.wait()
            with store.scope(spark) as inner:
                b = store.materialize(a.selectExpr("id + 1 AS id"), "b")
                inner.append(b)
                store.materialize(spark.range(3), "dropped")
            meet.wait()
            out = store.materialize(a.unionByName(b), "c")
            results.append(out)
        meet.wait()
        return out.count()

    before = set(store._made)
    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(work, (10, 20, 30))) == [20, 40, 60]
    left = set(store._made) - before
    assert len(left) == 3 and all("/c-" in u for u in left)
    for u in left:
        store._delete(u)


def test_an_inner_scope_that_fails_leaves_the_outer_one(spark):
    before = set(store._made)
    with store.scope(spark) as results:
        with pytest.raises(ValueError, match="early"), store.scope(spark):
            raise ValueError("early")
        with pytest.raises(ValueError, match="late"), store.scope(spark):
            store.materialize(spark.range(2), "lost")
            raise ValueError("late")
        results.append(out := store.materialize(spark.range(4), "kept"))
    assert out.count() == 4 and len(set(store._made) - before) == 1
    with store.scope(spark):
        store._scope.get().uris.append(out._strataloom_uri)
    assert set(store._made) == before


def test_an_upsert_onto_its_own_path_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "manifest")
    rows = lambda: {tuple(r) for r in spark.read.parquet(path).collect()}
    new = lambda *r: spark.createDataFrame(list(r), "file string, title string")
    files.upsert_table(new(("a", "1"), ("b", "2")), path)
    files.upsert_table(new(("b", "other"), ("c", "3")), path)
    want = {("a", "1"), ("b", "2"), ("c", "3")}
    assert rows() == want
    broken = new(("d", "4"), ("e", "5")).withColumn("title", F.when(F.col("file") == "e", F.raise_error(F.lit("halfway"))).otherwise(F.col("title")).cast("string"))
    with pytest.raises(Exception, match="halfway"):
        files.upsert_table(broken, path)
    assert rows() == want and sorted(p.name for p in tmp_path.iterdir()) == ["manifest"]
    (tmp_path / "manifest").rename(tmp_path / "manifest.last")  # cut off between the renames
    (tmp_path / "manifest.new-x").mkdir()
    assert files.recovered(spark, path) and rows() == want
    files.upsert_table(new(("f", "6")), path)
    assert rows() == want | {("f", "6")}
    files.replace_table(spark.read.parquet(path).filter("file > 'b'"), path)
    assert {r[0] for r in rows()} == {"c", "f"} and not files.recovered(spark, str(tmp_path / "none"))


def test_csv_with_a_mark(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("Hà Nội", 5, None), ('a "b", c', 7, "x\ny")], "province_name string, n long, t string")
    assert files.write_csv(df, path) == 2
    (file,) = (tmp_path / "t").glob("*.csv")
    assert file.read_bytes().startswith("\ufeffprovince_name,n,t\n".encode())
    assert sorted(map(tuple, files.read_csv(spark, path, "n long").collect())) == sorted(map(tuple, df.collect()))
    assert files.write_csv(df.limit(0), path) == 0 and not (tmp_path / "t").exists()


def test_shuffle_files_go_with_the_statement(spark):
    """A table that was written leaves no shuffle files, and the session's setting is as it was."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: {b for b in blocks.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    before, setting = shuffled(), spark.conf.get(store._CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with store.scope(spark) as results:
        out = store.materialize(df, "a")
        for _ in range(100):
            if not (left := shuffled() - before):
                break
            time.sleep(0.1)
        assert not left and spark.conf.get(store._CLEANUP, None) == setting
        assert out.join(store.materialize(df, "b"), "k").count() == 7
        results.append(out)
    store.drop(out)
