"""Keyed tables: equal to a dict after any changes; a change writes the buckets of its keys only."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.keyed_table import KeyedTable
from quarry.streaming import jobs

DDL = "k long, s string, at long, n long"


def combine():
    return {"s": F.max_by("s", "at"), "at": F.max("at"), "n": F.sum("n")}


def _table(spark, tmp_path, buckets=8):
    return KeyedTable(spark, str(tmp_path / "t"), ["k"], DDL, buckets).create()


def _content(df):
    return {r.k: (r.s, r["at"], r.n) for r in df.collect()}


def _files(table, kind):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{table.path}/{kind}") for f in fs if f.endswith(".parquet")}


def test_changes_and_deletions_are_those_of_a_dict(spark, tmp_path):
    rng = random.Random(11)
    table, model, seen = _table(spark, tmp_path), {}, {0: {}}
    assert _content(table.rows()) == {}
    for step in range(1, 9):
        if step % 3:
            rows = [(rng.choice([None, 7, 7, *range(60)]), f"v{step}-{i}", step * 1000 + i, 1) for i in range(80)]
            table.merge(spark.createDataFrame(rows, DDL), combine())
            for k, s, at, n in rows:
                old = model.get(k, (None, -1, 0))
                model[k] = (s, at, old[2] + n) if at > old[1] else (*old[:2], old[2] + n)
        else:
            keys = [None, *rng.sample(range(90), 25)]
            table.delete(spark.createDataFrame([(k,) for k in keys * 2], "k long"))
            model = {k: v for k, v in model.items() if k not in keys}
        seen[step] = dict(model)
        assert _content(table.rows()) == model
    assert all(_content(table.rows(v)) == seen[v] for v in (0, 2, 4))
    table.remove_old(keep=2)
    assert _content(table.rows()) == model and _content(table.rows(7)) == seen[7]
    with pytest.raises(ValueError):
        table.rows(3)


def test_a_change_writes_only_its_buckets(spark, tmp_path):
    table = _table(spark, tmp_path, buckets=32)
    table.merge(spark.range(2000).select(F.col("id").alias("k"), F.lit("a").alias("s"), F.lit(1).alias("at"), F.lit(1).alias("n")), combine())
    before, first = _files(table, "rows"), table.manifest()
    assert len(before) == len(first) == 32  # a file per bucket
    table.merge(spark.createDataFrame([(5, "b", 2, 1), (5, "c", 3, 1)], DDL), combine())
    now = table.manifest()
    touched = [b for b in now if now[b] != first[b]]
    assert len(touched) == 1 and len(_files(table, "rows") - before) == 1
    table.delete(spark.createDataFrame([(6,), (12345,)], "k long"))
    assert len(_files(table, "rows") - before) == 1 and len(_files(table, "gone")) == 1  # no row is written
    got = _content(table.rows())
    assert got[5] == ("c", 3, 3) and 6 not in got and len(got) == 1999
    wanted = table.lookup(spark.createDataFrame([(5,), (6,), (12345,)], "k long"))
    assert _content(wanted) == {5: ("c", 3, 3)}
    assert len(wanted.inputFiles()) <= 4
    table.remove_old(keep=1)
    assert len(_files(table, "rows")) == 32 and len(_files(table, "manifest")) == 1


def test_deleted_positions_beyond_one_page(spark, tmp_path):
    table = _table(spark, tmp_path, buckets=1)
    rows = spark.range(70_000).select(F.col("id").alias("k"), F.lit("a").alias("s"), F.lit(1).alias("at"), F.lit(1).alias("n"))
    table.merge(rows, combine())
    for remainder in (0, 1):  # the second deletion adds to the bitmaps of the first
        table.delete(rows.filter(F.col("k") % 3 == remainder).select("k"))
    left = table.rows().agg(F.count("k"), F.min(F.col("k") % 3), F.max(F.col("k") % 3)).first()
    assert tuple(left) == (23_333, 2, 2)
    table.delete(rows.select("k"))
    assert table.rows().count() == 0
    assert table.merge(rows.limit(0), combine(), version=2) == table.version()  # a version that exists: nothing happens


def test_upsert_keeps_the_highest_offset_of_each_column(spark, tmp_path):
    table = jobs.upsert_table(spark, str(tmp_path / "t"), "k", ["a", "b"], buckets=4)
    fn = jobs.upsert(table, ["a", "b"])
    schema = "k long, a string, b string, offset long"
    fn(spark.createDataFrame([(1, "new", None, 100), (2, "x", "y", 7)], schema), 0)
    fn(spark.createDataFrame([(1, "old", "b1", 5), (3, "z", None, 8)], schema), 1)
    fn(spark.createDataFrame([(1, "old", "b1", 5), (3, "z", None, 8)], schema), 1)  # the same batch again
    got = {r["k"]: (r["a"], r["b"], r["writes"]) for r in table.rows().collect()}
    assert got == {1: ("new", "b1", 2), 2: ("x", "y", 1), 3: ("z", None, 1)}
    with pytest.raises(ValueError):  # batch 4 is missing
        fn(spark.createDataFrame([(1, "c", None, 200)], schema), 5)
