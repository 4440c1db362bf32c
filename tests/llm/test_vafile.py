import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import vafile as V

SCHEMA = "vec_id long, embedding array<float>, label int, row string, v string, block string"


def brute(rows, every, k, scale=1024):
    sound = [(i, n, [math.floor(scale * float(np.float32(x))) for x in e]) for n, (i, e) in enumerate(rows)
             if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dims = max((len(v) for _, _, v in sound), default=0)
    sound = [(i, n, v + [0] * (dims - len(v))) for i, n, v in sound]
    out = []
    for i, n, q in sound:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, m, v in sound if m != n)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, every, k):
    df = spark.createDataFrame([(i, e, 1, "x", "y", "z") for i, e in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in V.top_k(df, F.col("id") % every == 0, k).collect())


def vectors(seed, n, d):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.2) for _ in range(d)]) for i in range(n)]


ODD = [(0, None), (1, [0.5, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, []), (None, [1.0, 1.0]),
       (6, [0.5, 0.5]), (6, [0.5, 0.5]), (8, [0.5]), (10, [-0.5, 0.25]), (12, [0.0, 0.0]), (7, [0.1, 0.1]), (9, [1e5, -1e5])]


@pytest.mark.parametrize("rows,every,k", [([], 2, 10), (ODD, 2, 3), (ODD, 2, 10), (vectors(1, 5, 3), 1, 10), (vectors(2, 700, 8), 20, 10),
                                          (vectors(3, 300, 4) + [(1000 + i, [0.3, -0.1, 0.2, 0.05]) for i in range(200)], 50, 10)])
def test_against_brute_force(spark, monkeypatch, rows, every, k):
    monkeypatch.setattr(V, "BLOCK", 64)
    monkeypatch.setattr(V, "QUERY_BLOCK", 8)
    assert run(spark, rows, every, k) == brute(rows, every, k)


def test_bounds_enclose_the_scores():
    rng = np.random.default_rng(1)
    v = rng.integers(-1000, 1000, (500, 6))
    q = rng.integers(-1000, 1000, (20, 6))
    number, lows, highs = V.approximate(v)
    assert (lows[number, np.arange(6)] <= v).all() and (v <= highs[number, np.arange(6)]).all()
    low, high = V.bounds(q, number, lows, highs)
    exact = q @ v.T
    assert (low <= exact).all() and (exact <= high).all()


def test_reading_stops_early():
    rng = np.random.default_rng(2)
    v = rng.integers(-200, 200, (4096, 16))
    number, lows, highs = V.approximate(v)
    q = rng.integers(-200, 200, (1, 16))
    _, high = V.bounds(q, number, lows, highs)
    best, read = V.read_until_certain(q[0], high[0], -np.inf, v, np.arange(len(v)), 10)
    exact = v @ q[0]
    assert best == [(int(exact[i]), int(i)) for i in np.lexsort((np.arange(len(v)), -exact))[:10]]
    assert read < len(v) // 10


def test_copies_of_query_blocks_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 64)
    monkeypatch.setattr(V, "QUERY_BLOCK", 8)
    df = spark.createDataFrame([(i, e, 1, "x", "y", "z") for i, e in vectors(4, 400, 4)], SCHEMA)
    found = V.top_k(df, F.col("id") % 50 == 0, 3)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [g#" in plan
    assert "BroadcastHashJoin [g#" not in plan
    assert found.count() == 24


def pair(v, ids, rows, q, q_ids, q_rows, **more):
    number, lows, highs = V.approximate(v)
    return {"q_ids": V._bytes(q_ids), "q_rows": V._bytes(q_rows), "q_vectors": V._bytes(q), "ids": V._bytes(ids), "rows": V._bytes(rows), "cells": number.tobytes(),
            "lows": V._bytes(lows), "highs": V._bytes(highs), "vectors": V._bytes(v)} | more


def test_a_query_block_is_answered_once_for_consecutive_data_blocks():
    rng = np.random.default_rng(3)
    v, q = rng.integers(-300, 300, (600, 5)), rng.integers(-300, 300, (7, 5))
    v[:7] = q  # the queries are rows, too
    at, none = np.arange(600), {"bar_rows": V._bytes(np.zeros(0, np.int64)), "bars": b""}
    pairs = [pair(v[i:i + 200], at[i:i + 200] + 5, at[i:i + 200], q[j], j + 5, j, **none) for j in (np.arange(4), np.arange(4, 7)) for i in (0, 200, 400)]
    batch = pa.RecordBatch.from_pylist(pairs)
    lows = list(V._scan(3)(iter([batch.slice(0, 2), batch.slice(2)])))
    assert [len(b) for b in lows] == [12, 9]
    exact = (q @ v.T).astype(float)
    exact[np.arange(7), np.arange(7)] = -np.inf
    kth = np.sort(exact, axis=1)[:, -3]
    assert all(min(r["low"] for b in lows for r in b.to_pylist() if r["q_row"] == i) <= kth[i] for i in range(7))
    found = list(V._read(3)(iter([batch.slice(0, 2), batch.slice(2)])))
    assert [len(b) for b in found] == [12, 9]
    best = [np.lexsort((at, -exact[i]))[:3] for i in range(7)]
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == sorted(
        [(i, i + 5, int(n) + 5, int(exact[i, n])) for i in range(7) for n in best[i]], key=lambda r: (r[0], -r[3], r[2]))


def test_whole_numbers_are_stored_in_few_bytes():
    for size, values in ((1, [-128, 127]), (2, [-129, 0]), (2, [128]), (4, [1 << 15]), (4, [-(1 << 31)]), (8, [1 << 31]), (8, [-(1 << 63), (1 << 63) - 1])):
        stored = V._bytes(np.array(values, np.int64))
        assert len(stored) == 1 + size * len(values)
        assert V._ints(stored).tolist() == values
    assert V._ints(V._bytes(np.zeros((0, 3), np.int64))).tolist() == []
