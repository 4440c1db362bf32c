"""SURVEY §2.3 projections, filters and predicates.

Filters are written as column predicates so Catalyst pushes them into the
parquet scan (``PushedFilters``); ranges are preferred over functions of the
column (P10) because only the former can be pushed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import parse_access
from quarry.operators.documents import photo_documents
from quarry.operators.keyed_table import KeyedTable
from quarry.operators.ordering import prefix_running
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, PHOTO_DOC
from quarry.session import scratch_path
from quarry.sources.derived import access_lines, events_x, lake_lines
from quarry.sources.tables import Tables

ACCOUNT = "Customer#000000007"


@register("P1_nested_field_equality", f"""
WITH {PHOTO_DOC} SELECT photo_id, path, segment FROM doc WHERE account_name = '{ACCOUNT}'""")
def p1(spark, sf):
    """Equality on a nested field: photos whose embedded user has a given account name."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    return d.filter(F.col("user.account_name") == ACCOUNT).select("photo_id", "path",
                                                                   F.col("user.segment").alias("segment"))


@register("P2_vertical_partitions_rejoined", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority FROM orders""")
def p2(spark, sf):
    """Vertical partitioning into two column subsets sharing the key, and the 1:1 re-join."""
    o = Tables(spark, sf).orders
    a = o.select("o_orderkey", "o_custkey", "o_orderdate")
    b = o.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return a.join(b, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                          "o_orderpriority")


@register("P3_half_open_time_range", """
SELECT event_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'""")
def p3(spark, sf):
    """Half-open time range ``a <= ts < b`` (pushed to the parquet scan)."""
    ev = Tables(spark, sf).events
    lo, hi = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")
    return ev.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).select("event_id", "ts", "event_type")


@register("P4_in_list_classify", """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'app' ELSE 'web' END AS client, count(*) AS n
FROM orders GROUP BY 1""")
def p4(spark, sf):
    """IN-list predicate used to classify rows (app vs web by a value set)."""
    o = Tables(spark, sf).orders
    cls = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "app").otherwise("web")
    return o.groupBy(cls.alias("client")).agg(F.count(F.lit(1)).alias("n"))


@register("P5_is_view_on_log_lines", f"""
WITH {EX} SELECT path, count(*) AS views FROM ex WHERE status IN (200, 304) GROUP BY path""")
def p5(spark, sf):
    """Is-a-view predicate on raw access lines: GET, path under /st/, status 200 or 304."""
    a = access_lines(Tables(spark, sf).events).select(parse_access("line").alias("r"))
    v = a.filter((F.col("r.method") == "GET") & F.col("r.path").startswith("/st/") & F.col("r.status").isin(200, 304))
    return v.groupBy(F.col("r.path").alias("path")).agg(F.count(F.lit(1)).alias("views"))


@register("P6_substring_of_line", f"""
WITH {EX} SELECT count(*) AS lines, count(*) FILTER (WHERE status IN (200, 304)) AS views FROM ex WHERE k = 42""")
def p6(spark, sf):
    """Substring match of a raw line (``"GET /st/42 ``): lines and views of one photo."""
    a = access_lines(Tables(spark, sf).events)
    hit = a.filter(F.col("line").contains('"GET /st/42 ')).select(parse_access("line").alias("r"))
    return hit.agg(F.count(F.lit(1)).alias("lines"),
                   F.count_if(F.col("r.status").isin(200, 304)).alias("views"))


@register("P7_case_insensitive_regex", f"""
WITH {EX}
SELECT CASE WHEN event_type = 'error' THEN 'nginx' ELSE 'upload' END AS service, count(*) AS n
FROM ex WHERE event_type IN ('error', 'purchase') GROUP BY 1""")
def p7(spark, sf):
    """Case-insensitive regex line filter ``(?i)error|fatal|critical`` over the log lake, per service."""
    lines = lake_lines(Tables(spark, sf).events)
    return lines.filter(F.col("line").rlike("(?i)error|fatal|critical")).groupBy("service").agg(
        F.count(F.lit(1)).alias("n"))


@register("P8_label_regex_anchored", """
SELECT source, count(*) AS n FROM documents WHERE regexp_full_match(source, 'src1.*') GROUP BY source""")
def p8(spark, sf):
    """Label matcher ``source =~ "src1.*"``: the regex is anchored at both ends."""
    d = Tables(spark, sf).documents
    return d.filter(F.col("source").rlike("^(?:src1.*)$")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("P9_extracted_field_compare", f"""
WITH {EX} SELECT status, count(*) AS n FROM ex WHERE status >= 500 GROUP BY status""")
def p9(spark, sf):
    """Numeric comparison on a field extracted from the line (``status >= 500``)."""
    a = access_lines(Tables(spark, sf).events)
    st = F.regexp_extract("line", r"\" (\d{3}) ", 1).try_cast("int")
    return a.filter(st >= 500).groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("P10_date_equality_as_range", """
SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-05-28'""")
def p10(spark, sf):
    """Date equality on a timestamp, written as a pushable half-open range."""
    o = Tables(spark, sf).orders
    lo = F.lit("1997-05-28 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1997-05-29 00:00:00").cast("timestamp_ntz")
    return o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select("o_orderkey", "o_totalprice")


def lookup_status(requests, table, req_col: str, key_col: str, cols: list[str]):
    """One row per request; found -> 200 with the row, absent -> 404 with nulls."""
    j = requests.join(table.select(F.col(key_col).alias("_k"), *cols), F.col(req_col) == F.col("_k"), "left")
    return j.select(req_col, F.when(F.col("_k").isNotNull(), 200).otherwise(404).alias("status"), *cols)


@register("P11_lookup_absent_is_404", """
SELECT c_custkey * 10 AS request_id, CASE WHEN o_orderkey IS NULL THEN 404 ELSE 200 END AS status, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey * 10 = o_orderkey""")
def p11(spark, sf):
    """Lookup of one key per request; an absent key is reported as 404, not dropped."""
    t = Tables(spark, sf)
    req = t.customer.select((F.col("c_custkey") * 10).alias("request_id"))
    return lookup_status(req, t.orders, "request_id", "o_orderkey", ["o_totalprice"])


def bulk_lookup(requests, table, pos_col: str, id_col: str, key_col: str, cols: list[str]):
    """One row per request, position and id text; ids that are not numeric or not in ``table`` give no row,
    an id asked for twice is answered twice, and ``pos`` keeps the order of the request at any length."""
    ids = requests.withColumn("id", F.trim(id_col).try_cast("bigint")).filter(F.col("id").isNotNull())
    return ids.join(table.select(F.col(key_col).alias("id"), *cols), "id").drop(id_col).withColumnRenamed(pos_col, "pos")


_REQ_SRC = """(SELECT request, unnest([k2, CASE WHEN k2 % 8 = 0 THEN k2 ELSE 7 END]) AS k2, unnest([0, 1]) AS twice
  FROM (SELECT o_custkey AS request, o_orderkey * 2 AS k2 FROM orders))"""


@register("P12_bulk_lookup_in_request_order", f"""
WITH req AS (SELECT request, k2, row_number() OVER (PARTITION BY request ORDER BY -k2, twice) - 1 AS pos FROM {_REQ_SRC})
SELECT request, pos, k2 AS id, o_totalprice FROM req JOIN orders ON k2 = o_orderkey
UNION ALL SELECT request, pos + 1000000, k2, o_totalprice FROM req JOIN orders ON k2 = o_orderkey WHERE k2 % 16 = 0""")
def p12(spark, sf):
    """Bulk lookup: per customer a list of ids in descending order, some of them twice and some missing, followed by
    texts that are no numbers and by ids asked for again."""
    o = Tables(spark, sf).orders
    k2 = F.col("o_orderkey") * 2
    asked = o.select(F.col("o_custkey").alias("request"), F.posexplode(F.array(k2, F.when(k2 % 8 == 0, k2).otherwise(F.lit(7)))).alias("twice", "k2"))
    asked = asked.withColumn("down", -F.col("k2"))
    req = prefix_running(asked, ["request"], ["request", "down", "twice"]).select("request", (F.col("_rank") - 1).cast("bigint").alias("at"), "k2")
    text = req.select("request", "at", F.concat(F.lit(" "), F.col("k2").cast("string")).alias("id_text"))
    again = req.select("request", (F.col("at") + 1000000).alias("at"), F.when(F.col("k2") % 16 == 0, F.col("k2").cast("string")).otherwise(F.lit("x")).alias("id_text"))
    return bulk_lookup(text.unionByName(again), o, "at", "id_text", "o_orderkey", ["o_totalprice"]).select("request", "pos", "id", "o_totalprice")


@register("P13_first_row_matching", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 ORDER BY o_orderkey LIMIT 1""")
def p13(spark, sf):
    """First row (in key order) that satisfies a predicate."""
    o = Tables(spark, sf).orders
    return o.filter(F.col("o_totalprice") > 400000).select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(1)


@register("P14_non_null_filter", f"""
WITH {PHOTO_DOC} SELECT format, count(*) AS n FROM doc WHERE camera_id IS NOT NULL GROUP BY format""")
def p14(spark, sf):
    """Non-null filter: photos that have a camera, per format."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    return d.filter(F.col("camera").isNotNull()).groupBy("format").agg(F.count(F.lit(1)).alias("n"))


@register("P15_drop_empty_results", """
WITH w AS (SELECT l_orderkey, list_sort(list(DISTINCT p_name)) AS names
           FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name LIKE 'red %' GROUP BY l_orderkey)
SELECT l_orderkey, CAST(len(names) AS INTEGER) AS n_found FROM w WHERE len(names) > 0""")
def p15(spark, sf):
    """Emit only non-empty model results: orders with at least one 'red ...' part."""
    t = Tables(spark, sf)
    red = t.part.filter(F.col("p_name").startswith("red ")).select("p_partkey", "p_name")
    j = t.lineitem.join(red, F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("l_orderkey").agg(F.countDistinct("p_name").cast("int").alias("n_found"))


@register("P16_delete_by_id_list", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 0)""")
def p16(spark, sf):
    """Delete by an id list: the new version keeps the rows not in the list (anti join)."""
    t = Tables(spark, sf)
    gone = t.customer.filter(F.col("c_nationkey") == 0).select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(gone, "o_custkey", "left_anti").select("o_orderkey",
                                                                                                "o_custkey")


@register("P16b_delete_from_keyed_table", """
SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 7 THEN 'reopened' ELSE o_orderstatus END AS status, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 0) OR o_orderkey % 100 = 7""")
def p16b(spark, sf):
    """Delete by an id list, then store some rows anew, in a stored table: deletions mark positions, only the buckets
    of the new rows are written."""
    t = Tables(spark, sf)
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    gone = t.customer.filter(F.col("c_nationkey") == 0).select(F.col("c_custkey").alias("o_custkey"))
    doomed = t.orders.select("o_orderkey", "o_custkey").join(gone, "o_custkey", "left_semi").select("o_orderkey")
    table = KeyedTable(spark, scratch_path(spark, "p16b-table"), ["o_orderkey"], rows.schema.simpleString()[7:-1].replace(":", " "), buckets=16).create()
    newest = {c: F.max_by(c, F.col("status") == "reopened") for c in ("status", "o_totalprice")}
    table.merge(rows, newest)
    table.delete(doomed)
    table.merge(rows.filter(F.col("o_orderkey") % 100 == 7).withColumn("status", F.lit("reopened")), newest)
    return table.rows()
