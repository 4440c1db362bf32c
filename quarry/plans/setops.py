"""SURVEY §2.8 set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.joins import J2_SQL, followed_brands, followed_brands_by_documents
from quarry.plans.registry import register
from quarry.sources.derived import events_x
from quarry.sources.tables import Tables


@register("U1_union_same_shape", """
SELECT CAST(event_id % 4 AS INTEGER) AS server, count(*) AS n, max(ts) AS latest FROM events GROUP BY 1""")
def u1(spark, sf):
    """Union of same-shape sources (one per server) and a count per source."""
    ex = events_x(Tables(spark, sf).events).select("server", "ts", "event_id")
    parts = [ex.filter(F.col("server") == s) for s in range(4)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("server").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))


@register("U2_union_missing_columns", """
SELECT src, count(*) AS n, count(value) AS with_value, count(o_totalprice) AS with_price FROM (
  SELECT 'events' AS src, value, NULL::DOUBLE AS o_totalprice FROM events
  UNION ALL SELECT 'orders', NULL::DOUBLE, o_totalprice FROM orders) GROUP BY src""")
def u2(spark, sf):
    """Union with different columns; columns missing on one side become null."""
    t = Tables(spark, sf)
    a = t.events.select(F.lit("events").alias("src"), "value", "event_id")
    b = t.orders.select(F.lit("orders").alias("src"), "o_totalprice", "o_orderkey")
    u = a.unionByName(b, allowMissingColumns=True)
    return u.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"),
                                F.count("o_totalprice").alias("with_price"))


@register("U3_intersect", """
SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier""")
def u3(spark, sf):
    """Set intersection: nations that have both customers and suppliers."""
    t = Tables(spark, sf)
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).intersect(
        t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@register("U4_subtract", """
SELECT event_id FROM events EXCEPT SELECT event_id FROM events WHERE event_type = 'purchase'""")
def u4(spark, sf):
    """Set difference: event ids without the charged (purchase) ones."""
    ev = Tables(spark, sf).events
    return ev.select("event_id").subtract(ev.filter(F.col("event_type") == "purchase").select("event_id"))


@register("U5_set_equality_subset", f"""
WITH a AS ({J2_SQL}), b AS ({J2_SQL})
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS a_minus_b,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS b_minus_a""")
def u5(spark, sf):
    """Set equality / subset test of two formulations (J2 vs J3) by two differences."""
    t = Tables(spark, sf)
    a, b = followed_brands(t), followed_brands_by_documents(t)
    amb = a.subtract(b).agg(F.count(F.lit(1)).alias("a_minus_b"))
    bma = b.subtract(a).agg(F.count(F.lit(1)).alias("b_minus_a"))
    return amb.crossJoin(bma)


@register("U6_distinct", "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem")
def u6(spark, sf):
    """Distinct pairs (order, part) of the order lines."""
    return Tables(spark, sf).lineitem.select("l_orderkey", "l_partkey").distinct()
