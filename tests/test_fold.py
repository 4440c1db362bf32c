"""User-defined folds and reducers keep exact values and split hot keys."""

from collections import Counter

from quarry.operators.fold import SumFold, fold, reduce_sorted

BIG = (1 << 60) + 1


class LastSeen:
    """The last non-null value, as it came."""

    transform_ddl = state_ddl = "v bigint, n bigint"

    def identity(self):
        return dict(v=None, n=0)

    def step(self, transform, event):
        return dict(v=event["v"] if event["v"] is not None else transform["v"], n=transform["n"] + 1)

    def compose(self, first, then):
        return dict(v=then["v"] if then["v"] is not None else first["v"], n=first["n"] + then["n"])

    def final(self, transform):
        return transform


def rows(spark):
    return spark.createDataFrame([("a", 1, BIG), ("a", 2, None), ("b", 1, BIG + 2), ("c", 1, None), (None, 1, BIG - 2)], "k string, i int, v bigint")


def test_integers_stay_exact_beside_nulls(spark):
    want = {"a": (BIG, 2), "b": (BIG + 2, 1), "c": (None, 1), None: (BIG - 2, 1)}
    assert {r.k: (r.v, r.n) for r in fold(rows(spark), "k", ["i"], LastSeen(), 3).collect()} == want

    def seen(key, group):
        got = [r["v"] for r in group]
        yield {"k": key[0], "v": next((v for v in reversed(got) if v is not None), None), "n": len(got)}

    assert {r.k: (r.v, r.n) for r in reduce_sorted(rows(spark), ["k"], seen, "k string, v bigint, n bigint").collect()} == want


def test_a_reducer_sees_each_group_once_and_in_order(spark):
    df = spark.range(5000).selectExpr("id % 3 k", "5000 - id i", "id v").repartition(7)

    def check(key, group):
        got = [r["i"] for r in group]
        yield {"k": key[0], "n": len(got), "sorted": got == sorted(got)}

    assert sorted(tuple(r) for r in reduce_sorted(df, ["k"], check, "k bigint, n int, sorted boolean").collect()) == [(0, 1667, True), (1, 1667, True), (2, 1666, True)]


def test_a_hot_key_is_folded_in_many_blocks(spark):
    df = spark.range(20000).selectExpr("if(id < 19000, 0, id) k", "id i")
    ones = df.selectExpr("k", "i", "1L v")
    sums = Counter({r.k: r.v for r in fold(ones, "k", ["i"], SumFold(["v"]), 8).collect()})
    assert sums[0] == 19000 and sum(sums.values()) == 20000
    blocks = df.repartitionByRange(8, "k", "i").selectExpr("k", "spark_partition_id() p").filter("k = 0").distinct().count()
    assert blocks >= 6
