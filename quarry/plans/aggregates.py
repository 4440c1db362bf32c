"""SURVEY §2.5 aggregations (A1-A24) bound to the driver tables.

Aggregations are plain ``groupBy().agg()``: Spark plans a partial
HashAggregate before the exchange (the map-side combine), so a hot key costs
one partial row per map task, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import ratio2, stable_hash
from quarry.plans.registry import register
from quarry.operators.documents import positioned
from quarry.plans.sqlx import EX, SPANS, h, positioned_sql
from quarry.sources.derived import events_x, spans, status_of
from quarry.sources.tables import TABLES, Tables, table


def view_counts(ex):
    """A1 core: views per path (map ``path -> 1``, combine, reduce = sum)."""
    return ex.filter("is_view").groupBy("path").agg(F.count(F.lit(1)).alias("views"))


@register("A1_views_per_path", f"WITH {EX} SELECT path, count(*) AS views FROM ex WHERE is_view GROUP BY path")
def a1(spark, sf):
    """Count of view events per photo path."""
    return view_counts(events_x(Tables(spark, sf).events))


@register("A2_features_per_path", f"""
WITH {EX}
SELECT path, count(*) AS views, count(DISTINCT user_id) AS viewers,
       round(100.0 * sum(CASE WHEN user_id % 3 <> 2 THEN 1 ELSE 0 END) / count(*)) / 100.0 AS app_share
FROM ex WHERE is_view GROUP BY path""")
def a2(spark, sf):
    """Views, distinct viewers and share of views from the app (rounded to 2) per path."""
    ex = events_x(Tables(spark, sf).events).filter("is_view")
    app = F.when(F.col("user_id") % 3 != 2, 1).otherwise(0)
    return ex.groupBy("path").agg(
        F.count(F.lit(1)).alias("views"), F.countDistinct("user_id").alias("viewers"),
        ratio2(F.sum(app), F.count(F.lit(1))).alias("app_share"))


@register("A5_mean_quantity_by_flag", """
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity) * 100) / 100 AS mean_qty, max(l_quantity) AS max_qty
FROM lineitem GROUP BY l_returnflag""")
def a5_flag(spark, sf):
    """Max and mean per group (the skew-summary aggregate on a fact table)."""
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), (F.round(F.avg("l_quantity") * 100, 0) / 100).alias("mean_qty"),
        F.max("l_quantity").alias("max_qty"))


@register("A7_parts_per_order", f"""
SELECT * FROM {positioned_sql('lineitem', 'l_orderkey', 'l_partkey', 'part', distinct=False)}""")
def a7(spark, sf):
    """Collect ids per group as a sorted list (duplicates kept), one row per position."""
    li = Tables(spark, sf).lineitem
    return positioned(li, ["l_orderkey"], "l_partkey", "part", distinct=False)


@register("A8_conditional_counts", f"""
WITH {EX}
SELECT server, count(*) AS n, count(*) FILTER (WHERE is_view) AS views,
       count(*) FILTER (WHERE event_type = 'error') AS errors,
       count(*) FILTER (WHERE value > 20) AS big_values, round(sum(value) * 100) / 100 AS total_value
FROM ex GROUP BY server""")
def a8(spark, sf):
    """Several conditional counts in one pass per server."""
    ex = events_x(Tables(spark, sf).events)
    return ex.groupBy("server").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_view")).alias("views"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("value") > 20).alias("big_values"),
        (F.round(F.sum("value") * 100, 0) / 100).alias("total_value"))


@register("A9_distinct_error_users", f"""
WITH {EX} SELECT count(DISTINCT user_id) AS users, count(*) AS lines FROM ex WHERE status >= 500""")
def a9(spark, sf):
    """Number of groups (distinct users) among server-error requests."""
    ex = events_x(Tables(spark, sf).events).filter(status_of(F.col("event_type")) >= 500)
    return ex.agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("lines"))


@register("A13_object_counts", """
SELECT obj, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS obj FROM part) GROUP BY obj""")
def a13(spark, sf):
    """Count of list elements over all rows (objects = words of the part name)."""
    p = Tables(spark, sf).part
    return (p.select(F.explode(F.split("p_name", " ")).alias("obj"))
            .groupBy("obj").agg(F.count(F.lit(1)).alias("n")))


@register("A15_redelivered_keys", """
SELECT event_id, count(*) AS n
FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_id % 10 = 3)
GROUP BY event_id HAVING count(*) > 1""")
def a15(spark, sf):
    """Keys processed more than once in a redelivered stream."""
    from quarry.sources.derived import redelivered
    ev = Tables(spark, sf).events.select("event_id")
    return (redelivered(ev).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


@register("A16_photo_popularity", """
WITH ap AS (SELECT DISTINCT l_orderkey AS photo_id, l_partkey AS album_id FROM lineitem),
fol AS (SELECT l_partkey AS album_id, count(DISTINCT l_suppkey) AS followers FROM lineitem GROUP BY l_partkey),
pop AS (SELECT photo_id, max(followers) AS popularity FROM ap JOIN fol USING (album_id) GROUP BY photo_id)
SELECT o_orderkey AS photo_id, coalesce(popularity, 0) AS popularity
FROM orders LEFT JOIN pop ON o_orderkey = photo_id""")
def a16(spark, sf):
    """Per photo: followers of the most followed album holding it; 0 when in no album."""
    t = Tables(spark, sf)
    li = t.lineitem
    # the maximum does not mind repeated pairs, so no distinct
    ap = li.select(F.col("l_orderkey").alias("photo_id"), F.col("l_partkey").alias("album_id"))
    fol = li.groupBy(F.col("l_partkey").alias("album_id")).agg(F.countDistinct("l_suppkey").alias("followers"))
    pop = ap.join(fol, "album_id").groupBy("photo_id").agg(F.max("followers").alias("popularity"))
    return (t.orders.select(F.col("o_orderkey").alias("photo_id"))
            .join(pop, "photo_id", "left")
            .select("photo_id", F.coalesce("popularity", F.lit(0).cast("bigint")).alias("popularity")))


@register("A17_most_active_user", """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 1""")
def a17(spark, sf):
    """Most active key and its count (ties: smallest key)."""
    ev = Tables(spark, sf).events
    return (ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("user_id")).limit(1))


@register("A18_partitions_per_member", f"""
WITH {EX}
SELECT server AS member, array_to_string(list_sort(list(DISTINCT kpart)), ',') AS partitions,
       count(*) AS messages
FROM ex GROUP BY server""")
def a18(spark, sf):
    """Members (servers) -> sorted list of the key partitions they hold, as text."""
    ex = events_x(Tables(spark, sf).events)
    return ex.groupBy(F.col("server").alias("member")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_set("kpart")), lambda x: x.cast("string")))
        .alias("partitions"),
        F.count(F.lit(1)).alias("messages"))


@register("A19_mean_span_ms_per_host", f"""
WITH {SPANS}
SELECT host, count(*) AS spans, round(avg(duration_s) * 1000 * 1000) / 1000 AS mean_ms FROM spans GROUP BY host""")
def a19(spark, sf):
    """Mean span time per host in milliseconds, with the span count."""
    s = spans(Tables(spark, sf).lineitem)
    return s.groupBy("host").agg(F.count(F.lit(1)).alias("spans"),
                                 (F.round(F.avg("duration_s") * 1000 * 1000, 0) / 1000).alias("mean_ms"))


@register("A21_table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def a21(spark, sf):
    """Row count of every table as one report."""
    parts = [table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
             for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("A23_last_activity_clipped", """
SELECT o_custkey, least(max(o_orderdate), TIMESTAMP '2000-01-01 00:00:00') AS last_active
FROM orders GROUP BY o_custkey""")
def a23(spark, sf):
    """Last activity per customer, clipped to an upper bound."""
    o = Tables(spark, sf).orders
    return o.groupBy("o_custkey").agg(
        F.least(F.max("o_orderdate"), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")).alias("last_active"))


@register("A24_answers_by_instance", f"""
WITH {EX}
SELECT CASE WHEN status = 200 THEN 'web-' || CAST(server + 1 AS VARCHAR)
            ELSE 'error ' || CAST(status AS VARCHAR) END AS answer, count(*) AS n
FROM ex GROUP BY 1""")
def a24(spark, sf):
    """Answers per instance; failures counted under ``error <code>``."""
    ex = events_x(Tables(spark, sf).events)
    st = status_of(F.col("event_type"))
    ans = F.when(st == 200, F.concat(F.lit("web-"), (F.col("server") + 1).cast("string"))) \
        .otherwise(F.concat(F.lit("error "), st.cast("string")))
    return ex.groupBy(ans.alias("answer")).agg(F.count(F.lit(1)).alias("n"))


@register("A4_latest_per_server", f"""
WITH {EX}, m AS (SELECT server, max(ts) AS latest FROM ex GROUP BY server)
SELECT count(*) AS servers, min(latest) AS min_latest FROM m""")
def a4(spark, sf):
    """Two-level aggregate: latest time per server, then server count and min of the maxima."""
    ex = events_x(Tables(spark, sf).events)
    m = ex.groupBy("server").agg(F.max("ts").alias("latest"))
    return m.agg(F.count(F.lit(1)).alias("servers"), F.min("latest").alias("min_latest"))


@register("X17_messages_per_partition", f"""
SELECT CAST({h('user_id')} % 6 AS INTEGER) AS kpart, count(*) AS n FROM events GROUP BY 1""")
def x17(spark, sf):
    """Messages per key partition (key = user; shows the skew of a hot user)."""
    ev = Tables(spark, sf).events
    return ev.groupBy((stable_hash("user_id") % 6).cast("int").alias("kpart")).agg(F.count(F.lit(1)).alias("n"))
