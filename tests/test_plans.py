"""Physical-plan properties the operators rely on at scale (checked with the executed plan text)."""

from .conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_view_counts_combine_on_the_map_side(spark):
    from quarry.plans.aggregates import a1

    p = _plan(a1(spark, SF_SMALL))
    assert "partial_count" in p and p.count("Exchange hashpartitioning") == 1


def test_replay_is_one_shuffle_by_photo(spark):
    from quarry.plans.eventsourcing import e2

    p = _plan(e2(spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1 and "partial_max_by" in p


def test_ring_lookup_is_bucketed_broadcast_join(spark):
    from quarry.plans.partitioning import j10

    p = _plan(j10(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "_bucket" in p and "NestedLoopJoin" not in p.split("BroadcastExchange")[0]


def test_top_n_per_key_uses_group_limit(spark):
    from quarry.plans.windows import w8

    assert "WindowGroupLimit" in _plan(w8(spark, SF_SMALL))


def test_top_k_is_take_ordered(spark):
    from quarry.plans.topk import t1

    assert "TakeOrderedAndProject" in _plan(t1(spark, SF_SMALL))


def test_nested_field_is_pruned_in_the_scan(spark):
    from pyspark.sql import functions as F

    from quarry.sources.tables import Tables

    o = Tables(spark, SF_SMALL).orders.select(F.struct("o_orderkey", "o_custkey").alias("s")).select("s.o_custkey")
    p = _plan(o)
    assert "ReadSchema: struct<o_custkey:bigint>" in p
