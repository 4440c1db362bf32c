"""The interval join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.intervals import overlaps


def pairs(left, right):
    ok = lambda s, e: s is not None and e is not None and s <= e
    return sorted((i, j) for i, s, e in left if ok(s, e) for j, u, v in right if ok(u, v) and s <= v and u <= e)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width,limit", [(7, 10**6), (50, 3), (10**6, 20)])
def test_against_all_pairs(spark, seed, width, limit):
    rng = random.Random(seed)

    def table(n):
        rows = []
        for i in range(n):
            s = rng.choice([rng.randint(-300, 300), 40])  # half of them in one place
            rows.append((i, s, s + rng.choice([0, 0, 5, 120, -3])))
        return rows + rows[:2] + [(n, None, 5), (n + 1, 5, None)]

    left, right = table(60), table(40)
    a = spark.createDataFrame(left, "i int, l_start bigint, l_end bigint").repartition(3)
    b = spark.createDataFrame(right, "j int, r_start bigint, r_end bigint")
    got = overlaps(a, b, width, limit=limit)
    assert sorted((r.i, r.j) for r in got.collect()) == pairs(left, right)
    assert overlaps(a.limit(0), b, width).count() == 0


def test_no_side_is_broadcast_by_wish(spark):
    a = spark.range(10).selectExpr("id i", "id l_start", "id + 3 l_end")
    plan = overlaps(a, a.selectExpr("i j", "l_start r_start", "l_end r_end"), 4)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()


@pytest.mark.parametrize("seed", range(3))
def test_totals_against_all_pairs(spark, seed):
    rng = random.Random(seed)

    def table(n):
        rows = []
        for i in range(n):
            s = rng.choice([rng.randint(-300, 300), 40])
            rows.append((i, s, s + rng.choice([0, 0, 5, 120, -3])))
        return rows + rows[:2] + [(n, None, 5), (n + 1, 5, None), (None, 7, 9)]

    left, right = table(60), table(40)
    a = spark.createDataFrame(left, "i int, l_start bigint, l_end bigint").repartition(3)
    b = spark.createDataFrame(right, "j int, r_start bigint, r_end bigint")
    want = {}
    ok = lambda s, e: s is not None and e is not None and s <= e
    for i, s, e in left:
        for r in right:
            if ok(s, e) and ok(*r[1:]) and s <= r[2] and r[1] <= e:
                n, t = want.get(r, (0, 0))
                want[r] = (n + 1, t + (i or 0))
    got = overlaps(a, b, 50, totals={"pairs": F.lit(1), "sum_i": F.col("i")}).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want and len(got) == len(want)
    assert overlaps(a.limit(0), b, 50, totals={"pairs": F.lit(1)}).count() == 0
    assert overlaps(a, b.limit(0), 50, totals={"pairs": F.lit(1)}).count() == 0


def test_totals_make_no_pairs(spark):
    a = spark.range(200_000).selectExpr("id i", "id l_start", "id l_end")
    b = spark.range(200_000).selectExpr("id j", "-id r_start", "200000 + id r_end")
    got = overlaps(a, b, 1000, totals={"pairs": F.lit(1)}).agg(F.count("*"), F.sum("pairs")).first()  # 4e10 pairs
    assert tuple(got) == (200_000, 200_000 * 200_000)
