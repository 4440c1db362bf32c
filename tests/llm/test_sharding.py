from collections import Counter, defaultdict

import pytest

from quarry.llm import sharding as S


def run(spark, groups, shards):
    rows = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "row long, group string").repartition(4)
    out = S.shard(rows, shards)
    return out, out.collect()


@pytest.mark.parametrize("groups,shards", [
    ([], 5), (["a"], 5), ([None] * 7, 3), (["a", "b", None] * 3, 40), (["hot"] * 400 + [f"g{i // 3}" for i in range(300)] + [f"s{i}" for i in range(500)], 10),
])
def test_law_and_slots(spark, groups, shards):
    out, rows = run(spark, groups, shards)
    assert sorted(r.row for r in rows) == list(range(len(groups)))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))


def test_links_stay_together_unless_the_quota_forbids(spark):
    groups = ["hot"] * 300 + [f"g{i // 4}" for i in range(200)] + [f"s{i}" for i in range(400)]  # 900 rows, 10 shards of 90
    out, rows = run(spark, groups, 10)
    where = defaultdict(Counter)
    for r in rows:
        where[groups[r.row]][r.shard] += 1
    small = [c for g, c in where.items() if g.startswith("g")]
    assert sum(len(c) == 1 for c in small) >= 0.8 * len(small)
    assert sum(c for c in sorted(where["hot"].values(), reverse=True)[:4]) >= 240
    cut = S.cut_edges(out).first()
    assert cut.edges == 300 * 299 / 2 + 50 * 6 + 0
    inside = sum(n * (n - 1) / 2 for c in where.values() for n in c.values())
    assert cut.cut == cut.edges - inside
    assert cut.cut < 0.75 * cut.edges  # a hash alone cuts nine tenths


def test_a_third_of_the_rows_fills_its_shards_of_40(spark):
    groups = ["hot"] * 2000 + [f"g{i // 4}" for i in range(800)] + [None] * 3200  # 6000 rows, 40 shards of 150
    out, rows = run(spark, groups, 40)
    where = defaultdict(Counter)
    for r in rows:
        where[groups[r.row]][r.shard] += 1
    assert sum(c for c in sorted(where["hot"].values(), reverse=True)[:15]) >= 1900
    small = [c for g, c in where.items() if g and g.startswith("g")]
    assert sum(len(c) == 1 for c in small) >= 0.8 * len(small)
    assert max(Counter(r.shard for r in rows).values()) == 150
