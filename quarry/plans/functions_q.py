"""SURVEY §2.9 scalar functions (F1-F28), each applied to a whole driver table.

Parser queries read the synthesised text; the oracle recomputes the expected
fields from the original columns, which makes it an independent check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import core as fn
from quarry.operators.documents import photo_documents
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, ESLOG, PHOTO_DOC, h
from quarry.sources.derived import access_lines, es_log, events_x, lake_lines
from quarry.sources.tables import Tables


@register("F1_stable_hash", f"SELECT o_orderkey, {h('o_orderkey')} AS h, {h('o_orderkey')} % 4 AS node FROM orders")
def f1(spark, sf):
    """Stable hash: first 8 hex digits of MD5 of the text form as an integer."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", fn.stable_hash("o_orderkey").alias("h"),
                    (fn.stable_hash("o_orderkey") % 4).alias("node"))


@register("F2_list_text_split_join", """
WITH t AS (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN '' ELSE replace(p_name, ' ', ';') END AS packed FROM part)
SELECT p_partkey, CAST(CASE WHEN packed = '' THEN 0 ELSE len(string_split(packed, ';')) END AS INTEGER) AS n_items,
       packed AS joined FROM t""")
def f2(spark, sf):
    """Split ``;``-packed list text (empty text = empty list) and join it back."""
    p = Tables(spark, sf).part
    packed = F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(F.array_join(F.split("p_name", " "), ";"))
    lst = p.select("p_partkey", fn.split_list(packed).alias("items"))
    return lst.select("p_partkey", F.size("items").alias("n_items"), fn.join_list("items").alias("joined"))


@register("F3_month_day_text", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def f3(spark, sf):
    """Month and day text of a timestamp."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", fn.month_text("o_orderdate").alias("month"), fn.day_text("o_orderdate").alias("day"))


@register("F4_floor_6_hours", """
SELECT event_id, time_bucket(INTERVAL 6 HOUR, ts) AS w6, time_bucket(INTERVAL 6 HOUR, ts) AS window_start FROM events""")
def f4(spark, sf):
    """Floor to 6 hours on the epoch grid; equal to the start of ``window(ts, '6 hours')``."""
    ev = Tables(spark, sf).events
    return ev.select("event_id", fn.floor_hours("ts", 6).alias("w6"),
                     F.window("ts", "6 hours").start.cast("timestamp_ntz").alias("window_start"))


@register("F5_hour_key_of_iso_text", f"""
WITH {EX}, {ESLOG} SELECT seq, substr(time, 1, 13) AS hour FROM eslog""")
def f5(spark, sf):
    """Hour key = first 13 characters of the ISO time text."""
    es = es_log(Tables(spark, sf).events)
    return es.select("seq", fn.hour_key("time").alias("hour"))


@register("F6_epoch_millis_nanos", "SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_ns(ts) AS ns FROM events")
def f6(spark, sf):
    """Epoch milliseconds and nanoseconds of a timestamp."""
    ev = Tables(spark, sf).events
    return ev.select("event_id", fn.epoch_millis("ts").alias("ms"), fn.epoch_nanos("ts").alias("ns"))


@register("F7_log_time_six_formats", f"""
WITH {EX}
SELECT event_id, CASE
    WHEN event_type IN ('view', 'click', 'error') THEN date_trunc('second', ts)
    WHEN event_type = 'purchase' THEN ts
    ELSE make_timestamp(2021, month(ts), day(ts), hour(ts), minute(ts), floor(second(ts))) END AS t
FROM ex
UNION ALL SELECT event_id, date_trunc('second', ts) FROM ex WHERE k % 50 = 0""")
def f7(spark, sf):
    """Timestamp from 6 log layouts, first matching wins; syslog lines get the year 2021."""
    lines = lake_lines(Tables(spark, sf).events)
    return lines.select("event_id", fn.log_time("line").alias("t"))


@register("F8_access_time_to_utc", "SELECT event_id, date_trunc('second', ts) AS t FROM events")
def f8(spark, sf):
    """Access-log time ``dd/MMM/yyyy:HH:mm:ss +0000`` to a UTC timestamp."""
    a = access_lines(Tables(spark, sf).events)
    return a.select("event_id", fn.access_time(F.regexp_extract("line", r"\[([^\]]+)\]", 1)).alias("t"))


@register("F9_access_log_fields", f"""
WITH {EX}
SELECT event_id, '192.0.2.' || CAST(user_id AS VARCHAR) AS ip, 'u' || CAST(user_id AS VARCHAR) AS "user",
       date_trunc('second', ts) AS time, 'GET' AS method, path, status FROM ex""")
def f9(spark, sf):
    """Access-log regex: ip, user, time, method, path, status (size parsed, not kept)."""
    a = access_lines(Tables(spark, sf).events).select("event_id", fn.parse_access("line").alias("r"))
    return a.select("event_id", "r.ip", "r.user", "r.time", "r.method", "r.path", "r.status")


@register("F10_whitespace_fields", f"""
WITH {EX} SELECT path AS f7, '"GET' AS f6, CAST(status AS VARCHAR) AS f9, count(*) AS n FROM ex GROUP BY 1, 2, 3""")
def f10(spark, sf):
    """awk-style whitespace fields ``$6`` (quote prefix ``"GET``), ``$7`` and ``$9``."""
    a = access_lines(Tables(spark, sf).events)
    return a.groupBy(fn.field("line", 7).alias("f7"), fn.field("line", 6).alias("f6"),
                     fn.field("line", 9).alias("f9")).agg(F.count(F.lit(1)).alias("n"))


ACCESS_PATTERN = '<ip> - <user> [<_>] "<method> <path> <_>" <status> <_>'


@register("F11_pattern_parser", f"""
WITH {EX}
SELECT event_id, '192.0.2.' || CAST(user_id AS VARCHAR) AS ip, 'GET' AS method, path,
       CAST(status AS VARCHAR) AS status FROM ex""")
def f11(spark, sf):
    """Pattern parser: literal text with ``<name>`` captures and ``<_>`` skips."""
    a = access_lines(Tables(spark, sf).events)
    p = a.select("event_id", fn.parse_pattern("line", ACCESS_PATTERN).alias("p"))
    return p.select("event_id", "p.ip", "p.method", "p.path", "p.status")


@register("F12_named_group_regexp", f"""
WITH {EX}
SELECT event_id, '192.0.2.' || CAST(user_id AS VARCHAR) AS client, 'GET' AS method, path FROM ex
WHERE event_type = 'error'""")
def f12(spark, sf):
    """Named-group regexp parser on nginx error lines (client, method, path)."""
    lines = lake_lines(Tables(spark, sf).events).filter(F.col("file") == "error")
    p = lines.select("event_id", fn.parse_regexp(
        "line", r'client: (\S+), request: "(\S+) (\S+)', ["client", "method", "path"]).alias("p"))
    return p.select("event_id", "p.client", "p.method", "p.path")


@register("F13_json_line_parser", f"""
WITH {EX}
SELECT event_id, CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'android' END AS platform,
       '3.' || CAST(k % 3 AS VARCHAR) AS app_version, 'Upload.swift:' || CAST(k % 5 * 10 AS VARCHAR) AS location,
       user_id AS "user"
FROM ex WHERE event_type = 'purchase'""")
def f13(spark, sf):
    """JSON line parser to typed columns (crash reports of the upload service)."""
    lines = lake_lines(Tables(spark, sf).events).filter(F.col("service") == "upload")
    j = lines.select("event_id", F.from_json("line", "platform string, app_version string, location string, "
                                                     "user bigint").alias("j"))
    return j.select("event_id", "j.platform", "j.app_version", "j.location", "j.user")


@register("F14_logfmt_parser", f"""
WITH {EX}
SELECT event_id, 'info' AS level, 'upload' AS service, 'deployed version 3.' || CAST(event_id % 9 AS VARCHAR) AS msg,
       'app-1' AS host FROM ex WHERE k % 50 = 0""")
def f14(spark, sf):
    """logfmt parser: ``k=v`` and ``k="quoted text"`` pairs to a map."""
    lines = lake_lines(Tables(spark, sf).events).filter(F.col("service") == "deploy")
    m = lines.select("event_id", fn.logfmt("line").alias("m"))
    return m.select("event_id", m.m["level"].alias("level"), m.m["service"].alias("service"),
                    m.m["msg"].alias("msg"), m.m["host"].alias("host"))


@register("F15_json_payload_round_trip", f"""
WITH {EX}, {ESLOG} SELECT seq, type, es_user AS "user", es_path AS path, es_title AS title, operation FROM eslog""")
def f15(spark, sf):
    """JSON encode (event payload) and decode back to typed fields."""
    es = es_log(Tables(spark, sf).events)
    j = es.select("seq", "type", F.from_json("data", "user int, path string, title string, operation string").alias("d"))
    return j.select("seq", "type", "d.user", "d.path", "d.title", "d.operation")


def notation(type_col, id_col, data_col):
    """F16: ``type(id=…, k=v, …)``, values rendered as JSON (strings quoted)."""
    rx = r'"(\w+)":("(?:[^"\\]|\\.)*"|[^,}]+)'
    keys = F.regexp_extract_all(data_col, F.lit(rx), 1)
    vals = F.regexp_extract_all(data_col, F.lit(rx), 2)
    args = F.transform(F.arrays_zip(keys.alias("k"), vals.alias("v")), lambda e: F.concat(e["k"], F.lit("="), e["v"]))
    return F.concat(type_col, F.lit("(id="), id_col.cast("string"),
                    F.when(F.size(args) > 0, F.concat(F.lit(", "), F.array_join(args, ", "))).otherwise(F.lit("")),
                    F.lit(")"))


@register("F16_event_notation", f"""
WITH {EX}, {ESLOG}
SELECT seq, type || '(id=' || CAST(photo_id AS VARCHAR) || ', user=' || CAST(es_user AS VARCHAR)
       || CASE WHEN es_path IS NOT NULL THEN ', path="' || es_path || '"' ELSE '' END
       || CASE WHEN es_title IS NOT NULL THEN ', title="' || es_title || '"' ELSE '' END
       || CASE WHEN operation IS NOT NULL THEN ', operation="' || operation || '"' ELSE '' END || ')' AS event
FROM eslog""")
def f16(spark, sf):
    """Event notation ``type(id=…, k=v, …)`` from the JSON payload."""
    es = es_log(Tables(spark, sf).events)
    return es.select("seq", notation(F.col("type"), F.col("photo_id"), F.col("data")).alias("event"))


@register("F17_default_text", f"""
WITH {PHOTO_DOC} SELECT photo_id, coalesce(nullif(title, ''), '(no title)') AS title FROM doc""")
def f17(spark, sf):
    """Default text: empty or missing title -> ``(no title)``."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    return d.select("photo_id", fn.default_text("title").alias("title"))


@register("F18_last_path_element", f"""
WITH {PHOTO_DOC} SELECT photo_id, CAST(photo_id AS VARCHAR) || '.jpg' AS file FROM doc""")
def f18(spark, sf):
    """Last element of a slash-separated path."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    return d.select("photo_id", fn.last_path_element("path").alias("file"))


@register("F19_url_query_param", """
SELECT page_id,
  url_decode(replace(regexp_extract_all(url, '[?&]page=([^&#]*)', 1)[-1], '+', ' ')) AS page,
  url_decode(replace(regexp_extract_all(url, '[?&]ref=([^&#]*)', 1)[-1], '+', ' ')) AS ref,
  url_encode('q=' || CAST(page_id AS VARCHAR) || ' &x') AS encoded
FROM pages""")
def f19(spark, sf):
    """URL query parameter decode (last duplicate wins, absent -> null) and encode."""
    p = Tables(spark, sf).pages
    return p.select("page_id", fn.url_param("url", "page").alias("page"), fn.url_param("url", "ref").alias("ref"),
                    fn.url_encode(F.concat(F.lit("q="), F.col("page_id").cast("string"), F.lit(" &x"))).alias("encoded"))


@register("F20_json_text_escaping", """
SELECT conv_id, turn, CAST(to_json({'text': text}) AS VARCHAR) AS js FROM conversations""")
def f20(spark, sf):
    """JSON text escaping of free text (quotes, backslash, control characters)."""
    c = Tables(spark, sf).conversations
    return c.select("conv_id", "turn", F.to_json(F.struct("text")).alias("js"))


@register("F21_prefix_id_and_strip", """
SELECT o_orderkey, 'a/' || CAST(o_orderkey AS VARCHAR) AS ref, o_orderkey AS back FROM orders""")
def f21(spark, sf):
    """Prefix an id as ``a/<id>`` and strip it again."""
    o = Tables(spark, sf).orders.select("o_orderkey", fn.prefixed_id("a/", "o_orderkey").alias("ref"))
    return o.select("o_orderkey", "ref", fn.strip_prefix("a/", "ref").cast("bigint").alias("back"))


@register("F22_sha256_pseudonym", "SELECT c_custkey, substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 12) AS pseudonym FROM customer")
def f22(spark, sf):
    """Truncated SHA-256 pseudonym (12 hex digits) of a user id."""
    c = Tables(spark, sf).customer
    return c.select("c_custkey", fn.pseudonym("c_custkey").alias("pseudonym"))


@register("F23_round_and_percent", """
SELECT o_orderstatus, round(100.0 * count(*) / (SELECT count(*) FROM orders)) / 100.0 AS share,
       round(100.0 * 100.0 * count(*) / (SELECT count(*) FROM orders)) / 100.0 AS percent,
       CAST(CAST(round(100.0 * count(*) / (SELECT count(*) FROM orders)) AS BIGINT) AS VARCHAR) || ' %' AS percent_text
FROM orders GROUP BY 1""")
def f23(spark, sf):
    """Round a share to 2 decimals, as percent and as percent text."""
    o = Tables(spark, sf).orders
    total = o.agg(F.count(F.lit(1)).alias("total"))
    c = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).crossJoin(total)
    return c.select("o_orderstatus", fn.ratio2("n", "total").alias("share"),
                    fn.round2(F.lit(100.0) * F.col("n") / F.col("total")).alias("percent"),
                    F.concat(F.round(F.lit(100.0) * F.col("n") / F.col("total")).cast("bigint").cast("string"), F.lit(" %")).alias("percent_text"))


@register("F24_client_from_user_agent", f"""
WITH {EX}
SELECT CASE user_id % 3 WHEN 0 THEN 'ios/3.' || CAST(k % 3 AS VARCHAR) WHEN 1 THEN 'android/3.' || CAST(k % 3 AS VARCHAR)
       ELSE 'web' END AS client, count(*) AS n FROM ex GROUP BY 1""")
def f24(spark, sf):
    """Client name from the user-agent text of the access log."""
    a = access_lines(Tables(spark, sf).events)
    ua = F.regexp_extract("line", r'"([^"]*)"$', 1)
    return a.groupBy(fn.client_from_user_agent(ua).alias("client")).agg(F.count(F.lit(1)).alias("n"))


@register("F25_integer_fields_of_record", f"""
WITH {EX}
SELECT event_id, 'event_id ' || CAST(event_id AS VARCHAR) || ', k ' || CAST(k AS VARCHAR) AS ints FROM ex""")
def f25(spark, sf):
    """Integer-valued keys of a JSON record as ``k v`` list text (sorted by key)."""
    ex = events_x(Tables(spark, sf).events)
    rec = ex.select("event_id", F.to_json(F.struct("event_id", "event_type", "value", "k")).alias("rec"))
    m = rec.select("event_id", fn.int_fields("rec").alias("m"))
    kv = F.transform(F.sort_array(F.map_entries("m")),
                     lambda e: F.concat(e["key"], F.lit(" "), e["value"].cast("string")))
    return m.select("event_id", F.array_join(kv, ", ").alias("ints"))


@register("F26_message_size_per_encoding", """
SELECT o_orderkey, CAST(strlen(CAST(to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus,
          'o_orderpriority': o_orderpriority}) AS VARCHAR)) AS INTEGER) AS json_bytes,
       CAST(strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) AS INTEGER) AS csv_bytes
FROM orders""")
def f26(spark, sf):
    """Bytes of one record as JSON and as CSV text (compact separators)."""
    o = Tables(spark, sf).orders
    s = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.select("o_orderkey", F.octet_length(F.to_json(s)).alias("json_bytes"),
                    F.octet_length(F.to_csv(s)).alias("csv_bytes"))


def _requests(ex):
    meth = F.when(F.col("event_type") == "purchase", F.lit("POST")).otherwise(F.lit("GET"))
    path = (F.when(F.col("event_type") == "view", F.concat(F.lit("/api/photos/"), F.col("k").cast("string")))
            .when(F.col("event_type") == "click",
                  F.concat(F.lit("/api/photos/"), F.col("k").cast("string"), F.lit("/keywords")))
            .when(F.col("event_type") == "signup", F.lit("/api/search"))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("/api/photos/"), F.col("k").cast("string")))
            .otherwise(F.lit("/api/other")))
    return ex.select(meth.alias("method"), path.alias("path"))


@register("F27_route_class", f"""
WITH {EX}
SELECT CASE event_type WHEN 'view' THEN 'photo' WHEN 'click' THEN 'keywords' WHEN 'signup' THEN 'search'
       ELSE 'not_found' END AS route, count(*) AS n FROM ex GROUP BY 1""")
def f27(spark, sf):
    """Route class of a request by ordered URL patterns and method; no match -> not_found (404)."""
    r = _requests(events_x(Tables(spark, sf).events))
    return r.groupBy(fn.route_class("method", "path").alias("route")).agg(F.count(F.lit(1)).alias("n"))


@register("F28_report_text_to_map", f"""
WITH {EX}
SELECT server, count(*) FILTER (WHERE is_view) AS views, count(*) FILTER (WHERE event_type = 'error') AS errors FROM ex GROUP BY 1""")
def f28(spark, sf):
    """Parse a ``name=number`` report text into a map (report built per server)."""
    ex = events_x(Tables(spark, sf).events)
    rep = ex.groupBy("server").agg(F.concat(
        F.lit("Job counters\n  views="), F.count_if(F.col("is_view")).cast("string"),
        F.lit("\n  errors="), F.count_if(F.col("event_type") == "error").cast("string"), F.lit("\n")).alias("report"))
    m = rep.select("server", fn.report_to_map("report").alias("m"))
    return m.select("server", m.m["views"].alias("views"), m.m["errors"].alias("errors"))
