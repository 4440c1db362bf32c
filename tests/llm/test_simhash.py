import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import simhash as H
from tests.llm.conftest import ODD


def fingerprint(text, k):
    """Bit by bit, from the definition."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def roots(fps, radius):
    fps = np.array(sorted(set(fps)), np.uint64)
    label = np.arange(len(fps))
    while True:
        new = np.array([label[np.bitwise_count(fps ^ f) <= radius].min() for f in fps])
        if (new == label).all():
            return dict(zip(fps.tolist(), label.tolist()))
        label = new


def check(rows, fps, ids, radius):
    comp = roots(fps, radius)
    least = {}
    for i, f in zip(ids, fps):
        c = comp[f]
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    want = sorted(((i, f"{f:016x}", least[comp[f]]) for i, f in zip(ids, fps)), key=str)
    assert sorted(((r.id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in rows), key=str) == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(set(comp.values())) and all(r.id == r.component_id for r in kept)


def test_odd_rows(odd_docs, no_docs):
    rows = H.near_components(odd_docs, 4, 4).collect()
    check(rows, [fingerprint(t, 4) for _, t in ODD], [i for i, _ in ODD], 4)
    assert H.near_dedup(odd_docs, 4, 4).columns == odd_docs.columns
    assert H.near_components(no_docs, 4, 4).count() == 0


@pytest.mark.parametrize("k", [1, 4])
def test_fingerprints_of_whole_texts(spark, k):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = docs.select("doc_id", "text", H.fingerprint_udf(k)("text").alias("fp")).collect()
    assert all(r.fp & (1 << 64) - 1 == fingerprint(r.text, k) for r in got)


def near_fingerprints(seed, n):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(20)]
    out = [rng.getrandbits(64) if rng.random() < 0.2 else rng.choice(base[:3]) if rng.random() < 0.3 else rng.choice(base) for _ in range(n)]
    for i in range(n):  # chains and balls
        for _ in range(rng.randint(0, 9)):
            out[i] ^= 1 << rng.randrange(64)
    return out


@pytest.mark.parametrize("radius,seed", [(0, 1), (1, 2), (3, 3), (4, 4), (4, 5), (7, 6)])
def test_components_of_given_fingerprints(spark, radius, seed):
    fps = near_fingerprints(seed, 400)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").distinct().repartition(4).cache()
    parts, thresholds = H.plan(df, radius)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert sum(thresholds) == radius - len(parts) + 1
    got = {r.node & (1 << 64) - 1: r.root for r in H.links(df, radius, parts, thresholds).collect()}
    want = roots(fps, radius)
    assert set(got) == set(want)
    assert len({(got[f], want[f]) for f in want}) == len(set(want.values())) == len(set(got.values()))


@pytest.mark.parametrize("thresholds", [[0, 0, 0, 0, 0], [1, 0, 0, 0], [-1, 1, 1, 0], [2, 1], [-1, 2, 1], [0, 2, 0]])
def test_any_allocation_finds_all_links(spark, thresholds):
    fps = near_fingerprints(9, 300)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long").distinct()
    m = len(thresholds)
    parts = [list(range(64 * i // m, 64 * (i + 1) // m)) for i in range(m)]
    got = {r.node & (1 << 64) - 1: r.root for r in H.links(df, sum(thresholds) + m - 1, parts, thresholds).collect()}
    want = roots(fps, sum(thresholds) + m - 1)
    assert len({(got[f], want[f]) for f in want}) == len(set(want.values())) == len(set(got.values()))


def test_dynamic_programming_is_optimal():
    rng = random.Random(3)
    for _ in range(50):
        m, total = rng.randint(1, 4), rng.randint(-1, 3)
        costs = [{t: rng.random() for t in range(-1, 3)} for _ in range(m)]
        import itertools
        want = min((sum(c[t] for c, t in zip(costs, ts)) for ts in itertools.product(range(-1, 3), repeat=m) if sum(ts) == total), default=float("inf"))
        assert abs(H.allocate(costs, total)[0] - want) < 1e-9 or H.allocate(costs, total)[0] == want


def test_correlated_bits_share_a_partition(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(500):
        f = rng.getrandbits(64)
        for a, b in ((0, 40), (5, 63), (20, 33)):  # these pairs agree
            f = f & ~(1 << b) | (f >> a & 1) << b
        rows.append((f - (1 << 64) if f >> 63 else f,))
    n, together = H.bit_statistics(spark.createDataFrame(rows, "fp long").repartition(3))
    assert n == 500
    parts = H.group_bits(n, together, 4)
    assert all(any({a, b} <= set(p) for p in parts) for a, b in ((0, 40), (5, 63), (20, 33)))


def test_near_copies_count_as_one(make_docs):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 500)}" for _ in range(3000)]
    texts = []
    for i in range(12):
        t = list(base)
        t[rng.randrange(3000)] = f"new{i}"
        texts.append(" ".join(t))
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(100 + i, " ".join(f"u{rng.random()}" for _ in range(50))) for i in range(5)])
    assert sorted(r.doc_id for r in H.near_dedup(docs, 4, 4).select("doc_id").collect()) == [0, 100, 101, 102, 103, 104]
    assert docs.filter(F.col("doc_id") < 100).count() == 12
