"""SURVEY §2.12 log-lake queries (L1-L11) and topk T3 over the multi-format lake.

Lines are synthesised from ``events`` (one line per event in the layout of
the service that logs it); the Spark side parses the text, the oracle reads
the original columns.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.core import logfmt, parse_access
from quarry.operators import loglake as ll
from quarry.operators.lake_store import LakeStore
from quarry.plans.registry import register
from quarry.plans.sqlx import EX
from quarry.session import scratch_path
from quarry.sources.derived import access_lines, lake_lines, redelivered
from quarry.sources.tables import Tables

END = "2024-01-30 00:00:00"
DAY = "2024-01-07"

LT = ("CASE WHEN event_type IN ('view', 'click', 'error') THEN date_trunc('second', ts) "
      "WHEN event_type = 'purchase' THEN ts "
      "ELSE make_timestamp(2021, month(ts), day(ts), hour(ts), minute(ts), floor(second(ts))) END")

LAKE = f"""{EX},
lake AS (
  SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'error') THEN 'nginx'
                        WHEN event_type = 'purchase' THEN 'upload' ELSE 'auth' END AS service,
         CASE WHEN event_type IN ('view', 'click') THEN 'access' WHEN event_type = 'error' THEN 'error' END AS file,
         CASE WHEN event_type IN ('view', 'click', 'error') THEN 'web-' || CAST(server + 1 AS VARCHAR) END AS host,
         {LT} AS t, event_type, k, user_id, status, path
  FROM ex
  UNION ALL SELECT event_id, 'deploy', NULL, NULL, date_trunc('second', ts), 'deploy', k, user_id, NULL, path
  FROM ex WHERE k % 50 = 0)"""


def _lake(spark, sf, events=None):
    return ll.ingest(lake_lines(events if events is not None else Tables(spark, sf).events))


def _store(spark, sf):
    """The lake with its chunk directory, as the ingest stores it."""
    return LakeStore.build(_lake(spark, sf), scratch_path(spark, "lake-store"))


@register("L1_ingest_labels_time", f"""
WITH {LAKE} SELECT service, file, host, count(*) AS lines, min(t) AS first_ts, max(t) AS last_ts FROM lake GROUP BY 1, 2, 3""")
def l1(spark, sf):
    """Ingest: labels + time parsed from the line + raw line; summary per stream."""
    lk = _lake(spark, sf)
    return lk.groupBy("service", "file", "host").agg(F.count(F.lit(1)).alias("lines"), F.min("ts").alias("first_ts"),
                                                    F.max("ts").alias("last_ts"))


@register("L2_identical_lines_once", f"""
WITH {LAKE}, shipped AS (SELECT * FROM lake UNION ALL SELECT * FROM lake WHERE event_id % 10 = 3)
SELECT service, count(*) AS shipped, (SELECT count(*) FROM lake l WHERE l.service = s.service) AS stored
FROM shipped s GROUP BY service""")
def l2(spark, sf):
    """Identical line, time and labels are stored once (lines shipped twice after a retry)."""
    ev = Tables(spark, sf).events
    shipped = _lake(spark, sf, redelivered(ev))
    stored = ll.dedupe(shipped)
    a = shipped.groupBy("service").agg(F.count(F.lit(1)).alias("shipped"))
    b = stored.groupBy("service").agg(F.count(F.lit(1)).alias("stored"))
    return a.join(b, "service")


@register("L3_lines_per_source_in_range", f"""
WITH {LAKE} SELECT service, file, count(*) AS lines FROM lake
WHERE t > TIMESTAMP '{END}' - INTERVAL 3 DAY AND t <= TIMESTAMP '{END}' GROUP BY 1, 2""")
def l3(spark, sf):
    """Lines per source in the range ``(END - 3d, END]`` (left-open, right-closed), from the chunks of a stored lake that meet it."""
    after = str(datetime.fromisoformat(END) - timedelta(days=3))
    return _store(spark, sf).between(after, END).groupBy("service", "file").agg(F.count(F.lit(1)).alias("lines"))


@register("L4_server_errors_per_hour", f"""
WITH {EX}, h AS (SELECT make_timestamp(CAST(ceil(epoch_us(date_trunc('second', ts)) / 3600000000) AS BIGINT) * 3600000000) AS step,
                        count(*) AS n FROM ex WHERE status >= 500 GROUP BY 1)
SELECT step, n FROM h WHERE n > 1""")
def l4(spark, sf):
    """Server errors (5xx) per hour step: buckets ``(h - 1 h, h]``, empty hours absent, only > 1."""
    lk = ll.ingest(access_lines(Tables(spark, sf).events))
    st = parse_access("line")["status"]
    h = lk.filter(st >= 500).groupBy(ll.hour_step(F.col("ts")).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    return h.filter(F.col("n") > 1)


@register("L5_top3_error_requests", f"""
WITH {EX} SELECT 'GET' AS method, path, CAST(status AS VARCHAR) AS status, count(*) AS n FROM ex
WHERE status >= 500 GROUP BY 1, 2, 3 ORDER BY n DESC, method, path, status LIMIT 3""")
def l5(spark, sf):
    """Top 3 (method, path, status) of server errors from the parsed access lines."""
    lk = access_lines(Tables(spark, sf).events).select(parse_access("line").alias("r"))
    c = (lk.filter(F.col("r.status") >= 500)
         .groupBy(F.col("r.method").alias("method"), F.col("r.path").alias("path"),
                  F.col("r.status").cast("string").alias("status"))
         .agg(F.count(F.lit(1)).alias("n")))
    return c.orderBy(F.desc("n"), "method", "path", "status").limit(3)


@register("L6_error_lines_per_service_one_day", f"""
WITH {LAKE} SELECT service, count(*) AS n FROM lake
WHERE event_type IN ('error', 'purchase') AND t > TIMESTAMP '{DAY}' AND t <= TIMESTAMP '{DAY}' + INTERVAL 1 DAY GROUP BY 1""")
def l6(spark, sf):
    """Lines with error/fatal/critical per service within one day, from the chunks of that day that may hold such lines."""
    day = datetime.fromisoformat(DAY)
    found = _store(spark, sf).holding(["error", "fatal", "critical"], str(day), str(day + timedelta(days=1)))
    return found.groupBy("service").agg(F.count(F.lit(1)).alias("n"))


@register("P6b_rare_text_by_chunk_filter", f"""
WITH {LAKE} SELECT file, count(*) AS lines, min(t) AS first_ts, max(t) AS last_ts FROM lake
WHERE service = 'nginx' AND k = 42 GROUP BY file""")
def p6b(spark, sf):
    """Substring search over the whole lake: the chunks whose filters may hold ``"GET /st/42 `` are read, no others."""
    found = _store(spark, sf).holding(['"GET /st/42 '])
    return found.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("L7_errors_by_image_format", f"""
WITH {LAKE} SELECT CASE k % 3 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'heic' ELSE 'png' END AS format, count(*) AS n
FROM lake WHERE file = 'error' GROUP BY 1""")
def l7(spark, sf):
    """Errors by the image format extracted with a regexp from the error lines."""
    lk = _lake(spark, sf).filter((F.col("file") == "error") & F.col("line").contains("error"))
    fmt = F.regexp_extract("line", r"format=(\w+)", 1)
    return lk.groupBy(fmt.alias("format")).agg(F.count(F.lit(1)).alias("n"))


@register("L8_top3_crashes", f"""
WITH {LAKE} SELECT CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'android' END AS platform, '3.' || CAST(k % 3 AS VARCHAR) AS app_version,
  'Upload.swift:' || CAST(k % 5 * 10 AS VARCHAR) AS location, count(*) AS n
FROM lake WHERE service = 'upload' GROUP BY 1, 2, 3 ORDER BY n DESC, platform, app_version, location LIMIT 3""")
def l8(spark, sf):
    """Top 3 (platform, version, location) of the JSON crash reports."""
    lk = _lake(spark, sf).filter(F.col("service") == "upload")
    j = lk.select(F.from_json("line", "platform string, app_version string, location string").alias("j")).select("j.*")
    c = j.groupBy("platform", "app_version", "location").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "platform", "app_version", "location").limit(3)


@register("L9_deploy_lines_in_time_order", f"""
WITH {LAKE}, d AS (SELECT t AS ts, event_id, 'deployed' AS kind, 'deployed version 3.' || CAST(event_id % 9 AS VARCHAR) AS msg FROM lake
                   WHERE service = 'deploy' ORDER BY t, event_id LIMIT 10),
u AS (SELECT t AS ts, event_id, 'served' AS kind, 'crash at Upload.swift:' || CAST(k % 5 * 10 AS VARCHAR) AS msg FROM lake
      WHERE service = 'upload' ORDER BY t, event_id LIMIT 10)
SELECT ts, kind, msg FROM d UNION ALL SELECT ts, kind, msg FROM u""")
def l9(spark, sf):
    """Lines about the upload service: its deployments (substring filter, logfmt), and the lines that it wrote itself
    (JSON), of each the first 10 in time order."""
    lk = _lake(spark, sf)
    deploy = lk.filter((F.col("service") == "deploy") & F.col("line").contains("service=upload"))
    m = deploy.select("ts", "event_id", logfmt("line").alias("m")).orderBy("ts", "event_id").limit(10)
    own = lk.filter(F.col("service") == "upload").orderBy("ts", "event_id").limit(10).select("ts", F.from_json("line", "event string, location string").alias("j"))
    return m.select("ts", F.lit("deployed").alias("kind"), m.m["msg"].alias("msg")).unionByName(
        own.select("ts", F.lit("served").alias("kind"), F.concat_ws(" at ", "j.event", "j.location").alias("msg")))


@register("L10_failed_logins_by_address", f"""
WITH {LAKE}, a AS (SELECT '198.51.100.' || CAST(user_id % 7 AS VARCHAR) AS ip, t FROM lake WHERE event_type = 'signup'),
top AS (SELECT ip, count(*) AS n FROM a GROUP BY ip ORDER BY n DESC, ip LIMIT 3)
SELECT top.ip, n, min(t) AS first_ts, max(t) AS last_ts FROM top JOIN a USING (ip) GROUP BY top.ip, n""")
def l10(spark, sf):
    """Failed logins by address (top 3), with the first and last time of each."""
    lk = _lake(spark, sf).filter((F.col("service") == "auth") & F.col("line").contains("Failed password"))
    a = lk.select(F.regexp_extract("line", r"from (\S+) port", 1).alias("ip"), F.col("ts").alias("t"))
    top = a.groupBy("ip").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ip").limit(3)
    return top.join(a, "ip").groupBy("ip", "n").agg(F.min("t").alias("first_ts"), F.max("t").alias("last_ts"))


@register("L11_templates_without_parser")
def l11(spark, sf):
    """Log templates per service without a parser (a prefix tree built level by level)."""
    return ll.templates(_lake(spark, sf))


@register("L11b_template_sizes", f"""
WITH {LAKE} SELECT service, CAST(count(*) AS BIGINT) AS lines,
       TRUE AS all_placed FROM lake GROUP BY service""")
def l11b(spark, sf):
    """The sizes of a service's templates add up to its lines, and every line fits its template, position by position."""
    fits = F.forall(F.arrays_zip("tokens", "template"), lambda x: x["template"].isin("<*>") | (x["template"] == x["tokens"]))
    return ll.placed_lines(_lake(spark, sf)).groupBy("service").agg(F.sum("n").alias("lines"), F.bool_and(fits).alias("all_placed"))


@register("L11c_top3_templates")
def l11c(spark, sf):
    """Number of templates of each service and its 3 most frequent ones (ties by text)."""
    found = ll.templates(_lake(spark, sf))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("service").orderBy(F.desc("size"), "template"))).filter("rank <= 3")
    return first.join(found.groupBy("service").agg(F.count(F.lit(1)).alias("templates")), "service")


@register("T3_topk_sum_by", f"""
WITH {LAKE} SELECT host, count(*) AS lines FROM lake WHERE file = 'access' GROUP BY host ORDER BY lines DESC, host LIMIT 3""")
def t3(spark, sf):
    """``topk(3, sum by (host) (count_over_time(access lines)))`` with a host tie-break."""
    lk = _lake(spark, sf).filter(F.col("file") == "access")
    return lk.groupBy("host").agg(F.count(F.lit(1)).alias("lines")).orderBy(F.desc("lines"), "host").limit(3)
