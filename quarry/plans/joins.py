"""SURVEY §2.4 joins (J1-J16, J10/J11/J12 live with partitioning / lambda).

Join strategy is left to Catalyst + AQE: a side that is small at runtime is
broadcast (size checked against ``autoBroadcastJoinThreshold``), a large one
is sort-merge joined, and AQE splits skewed partitions.  Explicit
``broadcast()`` is used only for tables whose size is bounded by a parameter
(e.g. the incident windows of J15).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import floor_hours
from quarry.operators.documents import album_documents, photo_documents
from quarry.operators.intervals import overlaps
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, PHOTO_DOC, positioned_sql
from quarry.sources.derived import events_x, friendships
from quarry.sources.tables import Tables


@register("J1_inner_join_filter", """
SELECT o_orderkey, c_name, o_totalprice FROM orders, customer
WHERE o_custkey = c_custkey AND c_mktsegment = 'BUILDING' AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'""")
def j1(spark, sf):
    """Inner equi join plus filters on both sides (filters pushed below the join)."""
    t = Tables(spark, sf)
    o = t.orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    c = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


J2_SQL = """
SELECT DISTINCT c_custkey, p_brand
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey WHERE c_nationkey = 7"""


def followed_brands(t):
    """Customer -> orders -> lineitem -> part, 3 joins, DISTINCT."""
    c = t.customer.filter(F.col("c_nationkey") == 7).select("c_custkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_brand")
    return (c.join(o, c.c_custkey == o.o_custkey).join(li, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey")).select("c_custkey", "p_brand").distinct())


@register("J2_many_to_many_distinct", J2_SQL)
def j2(spark, sf):
    """Many-to-many over 4 tables with DISTINCT: brands bought by the customers of one nation."""
    return followed_brands(Tables(spark, sf))


def followed_brands_by_documents(t):
    """The same answer in application steps over denormalised documents.

    albums (parts) hold follower lists (customers via orders); step 1 keeps
    albums whose follower list contains a wanted customer (array_contains on
    the exploded list), step 2 fetches those albums by id (semi join).
    """
    li = t.lineitem.select("l_orderkey", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    followers = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                 .groupBy("l_partkey", "o_custkey").agg(F.count(F.lit(1)).alias("_n")))
    wanted = t.customer.filter(F.col("c_nationkey") == 7).select(F.col("c_custkey").alias("o_custkey"))
    hits = followers.join(wanted, "o_custkey", "left_semi")
    albums = t.part.select("p_partkey", "p_brand").join(
        hits.select(F.col("l_partkey").alias("p_partkey")).distinct(), "p_partkey", "left_semi")
    return (hits.join(albums, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("o_custkey").alias("c_custkey"), "p_brand").distinct())


@register("J3_same_set_in_steps", J2_SQL)
def j3(spark, sf):
    """J2's answer computed as semi-join steps; must give the same set (oracle = J2 SQL)."""
    return followed_brands_by_documents(Tables(spark, sf))


@register("J4_denormalised_photo_documents", f"""
WITH {PHOTO_DOC}
SELECT photo_id, path, format, title, objects, user_id, account_name, camera_id, manufacturer FROM doc""")
def j4(spark, sf):
    """Denormalise: orders with the embedded user struct and optional camera struct."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    return d.select("photo_id", "path", "format", "title", "objects", F.col("user.user_id").alias("user_id"),
                    F.col("user.account_name").alias("account_name"), F.col("camera.camera_id").alias("camera_id"),
                    F.col("camera.manufacturer").alias("manufacturer"))


@register("J5_album_documents", f"""
WITH ph AS {positioned_sql('lineitem', 'l_partkey', 'l_orderkey', 'photo')},
fo AS {positioned_sql('lineitem', 'l_partkey', 'l_suppkey', 'follower')},
l AS (SELECT coalesce(ph.l_partkey, fo.l_partkey) AS l_partkey, coalesce(ph.pos, fo.pos) AS pos, photo, follower
      FROM ph FULL OUTER JOIN fo ON ph.l_partkey = fo.l_partkey AND ph.pos = fo.pos)
SELECT p_partkey AS album_id, p_name AS title, pos, photo, follower FROM part LEFT JOIN l ON p_partkey = l_partkey""")
def j5(spark, sf):
    """Denormalise one-to-many: per album the sorted photo and follower ids by position; albums without stay."""
    t = Tables(spark, sf)
    return album_documents(t.part, t.lineitem)


@register("J6_two_name_lookups", f"""
WITH {EX}
SELECT event_id, u.c_name AS user_name, f.c_name AS friend_name
FROM ex JOIN customer u ON ex.user_id = u.c_custkey JOIN customer f ON (ex.user_id + ex.k) = f.c_custkey
WHERE event_type = 'click'""")
def j6(spark, sf):
    """Lookup of names for two keys of each event (user and friend = user + k)."""
    t = Tables(spark, sf)
    ex = events_x(t.events).filter(F.col("event_type") == "click")
    u = t.customer.select(F.col("c_custkey").alias("u_key"), F.col("c_name").alias("user_name"))
    f = t.customer.select(F.col("c_custkey").alias("f_key"), F.col("c_name").alias("friend_name"))
    return (ex.join(u, ex.user_id == u.u_key).join(f, (F.col("user_id") + F.col("k")) == F.col("f_key"))
            .select("event_id", "user_name", "friend_name"))


@register("J7_left_lookup_default_zero", """
SELECT p_partkey, coalesce(q, 0) AS sold FROM part
LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey""")
def j7(spark, sf):
    """Left lookup with 0 default: quantity sold per part, parts without sales give 0."""
    t = Tables(spark, sf)
    q = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return (t.part.join(q, F.col("p_partkey") == F.col("l_partkey"), "left")
            .select("p_partkey", F.coalesce("q", F.lit(0.0)).alias("sold")))


@register("J8_semi_join_id_list", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""")
def j8(spark, sf):
    """Semi join by an id list (``$in``): orders having a line with quantity >= 49."""
    t = Tables(spark, sf)
    ids = t.lineitem.filter(F.col("l_quantity") >= 49).select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(ids, "o_orderkey", "left_semi")


@register("J9_anti_join_missing", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')""")
def j9(spark, sf):
    """Anti join: expected but missing (customers without an order since 2001)."""
    t = Tables(spark, sf)
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    return t.customer.select("c_custkey").join(
        recent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@register("J9b_unknown_token_401", f"""
WITH {EX}
SELECT CASE WHEN c_custkey IS NULL THEN 401 ELSE 200 END AS status, count(*) AS n
FROM ex LEFT JOIN customer ON ex.user_id * 11 = c_custkey GROUP BY 1""")
def j9b(spark, sf):
    """Unknown token -> 401: requests whose token (user * 11) is not a known customer."""
    t = Tables(spark, sf)
    ex = events_x(t.events).select((F.col("user_id") * 11).alias("token"))
    j = ex.join(t.customer.select("c_custkey"), F.col("token") == F.col("c_custkey"), "left")
    st = F.when(F.col("c_custkey").isNull(), 401).otherwise(200)
    return j.groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("J13_undirected_adjacency", """
WITH e AS (SELECT DISTINCT o_custkey AS a, l_suppkey + 1000000 AS b
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
u AS (SELECT a AS node, b AS neighbour FROM e UNION SELECT b, a FROM e)
SELECT node, neighbour, count(*) OVER (PARTITION BY node) AS degree FROM u""")
def j13(spark, sf):
    """Undirected adjacency from edge pairs: one row per node and neighbour, both directions, with the node's degree."""
    t = Tables(spark, sf)
    e = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .select(F.col("o_custkey").alias("a"), (F.col("l_suppkey") + 1000000).alias("b")).distinct())
    both = e.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("neighbour")),
                                      F.struct(F.col("b").alias("node"), F.col("a").alias("neighbour")))).alias("x")).select("x.*").distinct()
    return both.join(both.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "node")


def incident_windows(ex, n: int):
    """Fixture's incidents: the ``n`` hours with most errors, ``[start, start + 1 h]``; earlier hour first on ties."""
    hours = ex.filter(F.col("event_type") == "error").groupBy(floor_hours("ts", 1).alias("start")).agg(F.count(F.lit(1)).alias("errors"))
    return hours.orderBy(F.desc("errors"), "start").limit(n).select("start", (F.col("start") + F.expr("INTERVAL 1 HOUR")).alias("end"))


@register("J15_events_in_incident_windows", f"""
WITH {EX},
h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS errors FROM ex WHERE event_type = 'error' GROUP BY 1),
w AS (SELECT start, start + INTERVAL 1 HOUR AS "end" FROM h ORDER BY errors DESC, start LIMIT 2)
SELECT w.start AS incident_start, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors
FROM ex JOIN w ON ex.ts >= w.start AND ex.ts <= w."end" GROUP BY w.start""")
def j15(spark, sf):
    """Mark events inside known incident windows (both ends closed) and count them per incident."""
    ex = events_x(Tables(spark, sf).events)
    w = incident_windows(ex, 2)
    j = ex.join(F.broadcast(w), (ex.ts >= w.start) & (ex.ts <= w.end))
    return j.groupBy(F.col("start").alias("incident_start")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))


@register("J15b_events_in_many_windows", f"""
WITH {EX}, w AS (SELECT event_id AS window_id, ts AS start, ts + INTERVAL 1 HOUR * (1 + user_id % 5) AS "end" FROM ex WHERE event_type = 'error')
SELECT w.window_id, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors
FROM ex JOIN w ON ex.ts >= w.start AND ex.ts <= w."end" GROUP BY 1""")
def j15b(spark, sf):
    """Events inside many overlapping windows (one for each error, 1 to 5 h long), both sides large: an interval join that gives
    the totals of each window without its pairs."""
    ex = events_x(Tables(spark, sf).events)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    hour = 3_600_000_000
    points = ex.select("event_type", at.alias("l_start"), at.alias("l_end"))
    windows = ex.filter(F.col("event_type") == "error").select(F.col("event_id").alias("window_id"), at.alias("r_start"), (at + hour * (1 + F.col("user_id") % 5)).alias("r_end"))
    totals = {"events": F.lit(1), "errors": (F.col("event_type") == "error").cast("int")}
    return overlaps(points, windows, 2 * hour, totals=totals).groupBy("window_id").agg(F.sum("events").alias("events"), F.sum("errors").alias("errors"))


@register("J16_bundled_lookup_calls", """
WITH idx AS (SELECT DISTINCT lower(w) AS word, doc_id FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[^[:alpha:]]+')) AS w FROM documents) WHERE w <> ''),
q AS (SELECT DISTINCT lower(p) AS word FROM (SELECT unnest(string_split(p_name, ' ')) AS p FROM part)),
hits AS (SELECT q.word, count(idx.doc_id) AS n FROM q LEFT JOIN idx ON q.word = idx.word GROUP BY q.word)
SELECT word, n AS found, 1 + least(n, 1) AS calls_bundled, 1 + n AS calls_per_row FROM hits""")
def j16(spark, sf):
    """Inverted-index search then fetch: one set-based join replaces one call per hit."""
    t = Tables(spark, sf)
    words = F.array_distinct(F.transform(F.split("text", r"[^\p{L}]+"), F.lower))
    idx = t.documents.select("doc_id", F.explode(words).alias("word")).filter(F.col("word") != "")
    q = t.part.select(F.explode(F.split("p_name", " ")).alias("p")).select(F.lower("p").alias("word")).distinct()
    hits = q.join(idx, "word", "left").groupBy("word").agg(F.count("doc_id").alias("n"))
    return hits.select("word", F.col("n").alias("found"), (1 + F.least("n", F.lit(1))).alias("calls_bundled"),
                       (1 + F.col("n")).alias("calls_per_row"))
