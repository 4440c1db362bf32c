"""SURVEY §2.14 monitoring queries (M1-M9) and consumer lag X16.

Components process the events: view -> object-detector, click ->
friend-detector, signup -> photo-uploader, purchase -> db-writer; an error
event is a failed message of object-detector (servers 0, 1) or
friend-detector (servers 2, 3).  Latency = events.value / 10 seconds.
Spans come from lineitem (FIXTURES §3).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import stable_hash
from quarry.operators import monitoring as mon
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, SPANS, h
from quarry.sources.derived import events_x, spans
from quarry.sources.tables import Tables

COMPONENT_SQL = """CASE event_type WHEN 'view' THEN 'object-detector' WHEN 'click' THEN 'friend-detector'
  WHEN 'signup' THEN 'photo-uploader' WHEN 'purchase' THEN 'db-writer'
  ELSE CASE WHEN server IN (0, 1) THEN 'object-detector' ELSE 'friend-detector' END END"""


def component(ex):
    et = F.col("event_type")
    return (F.when(et == "view", "object-detector").when(et == "click", "friend-detector")
            .when(et == "signup", "photo-uploader").when(et == "purchase", "db-writer")
            .when(F.col("server").isin(0, 1), "object-detector").otherwise("friend-detector"))


def _msgs(spark, sf):
    ex = events_x(Tables(spark, sf).events)
    return ex.withColumn("component", component(ex)).withColumn("failed", F.col("event_type") == "error") \
        .withColumn("seconds", F.col("value") / 10.0)


@register("M1_processed_and_failed", f"""
WITH {EX}, m AS (SELECT {COMPONENT_SQL} AS component, event_type = 'error' AS failed FROM ex),
p AS (SELECT component, count(*) AS processed FROM m WHERE NOT failed GROUP BY 1),
f AS (SELECT component, count(*) AS failed FROM m WHERE failed GROUP BY 1)
SELECT component, processed, coalesce(f.failed, 0) AS failed FROM p LEFT JOIN f USING (component)""")
def m1(spark, sf):
    """Processed and failed messages per component (failed defaults to 0)."""
    m = _msgs(spark, sf)
    p = m.filter(~F.col("failed")).groupBy("component").agg(F.count(F.lit(1)).alias("processed"))
    f = m.filter("failed").groupBy("component").agg(F.count(F.lit(1)).alias("failed"))
    return p.join(f, "component", "left").select("component", "processed",
                                                 F.coalesce("failed", F.lit(0).cast("bigint")).alias("failed"))


def _hist_sql():
    cases = " ".join(f"WHEN value / 10.0 <= {b} THEN {i}" for i, b in enumerate(mon.SECONDS))
    les = ", ".join(f"({i}, {float(b)})" for i, b in enumerate(mon.SECONDS)) + f", ({len(mon.SECONDS)}, 'infinity'::DOUBLE)"
    return f"""{EX},
m AS (SELECT {COMPONENT_SQL} AS component, CAST(CASE {cases} ELSE {len(mon.SECONDS)} END AS INTEGER) AS b FROM ex),
les AS (SELECT CAST(b AS INTEGER) AS b, CAST(le AS DOUBLE) AS le FROM (VALUES {les}) v(b, le)),
grid AS (SELECT component, b, le FROM (SELECT DISTINCT component FROM m), les),
c AS (SELECT component, b, count(*) AS n FROM m GROUP BY 1, 2),
hist AS (SELECT g.component, g.b, g.le, coalesce(c.n, 0) AS bucket_count,
         CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.component ORDER BY g.b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_count
         FROM grid g LEFT JOIN c USING (component, b))"""


@register("M2_cumulative_histogram", f"WITH {_hist_sql()} SELECT component, le, cum_count FROM hist")
def m2(spark, sf):
    """Cumulative histogram of processing seconds per component (15 bounds plus +Inf, ``<= le``)."""
    hst = mon.cumulative_histogram(_msgs(spark, sf), ["component"], "seconds", mon.SECONDS)
    return hst.select("component", "le", "cum_count")


@register("M3_histogram_quantile_p95", f"""
WITH {_hist_sql()},
t AS (SELECT component, max(cum_count) AS total FROM hist GROUP BY 1),
hh AS (SELECT hist.*, total, 0.95 * total AS rank,
         coalesce(lag(le) OVER (PARTITION BY component ORDER BY b), 0.0) AS lower,
         coalesce(lag(cum_count) OVER (PARTITION BY component ORDER BY b), 0) AS cum_prev FROM hist JOIN t USING (component)),
hit AS (SELECT component, min(b) AS b FROM hh WHERE cum_count >= rank GROUP BY 1)
SELECT component, CASE WHEN total = 0 THEN NULL WHEN le = 'infinity'::DOUBLE THEN lower
                       ELSE lower + (le - lower) * (rank - cum_prev) / bucket_count END AS quantile
FROM hh JOIN hit USING (component, b)""")
def m3(spark, sf):
    """95th percentile of processing seconds per component by linear interpolation in the histogram."""
    hst = mon.cumulative_histogram(_msgs(spark, sf), ["component"], "seconds", mon.SECONDS)
    return mon.histogram_quantile(hst, ["component"], 0.95)


def consumer_lag(ex):
    """Per partition, high watermark (max offset + 1) minus the committed offset (>= 0)."""
    g = ex.groupBy("kpart").agg((F.max("event_id") + 1).alias("high_watermark"), F.max("event_id").alias("_m"))
    committed = F.col("_m") - stable_hash("kpart") % 100
    return g.select("kpart", "high_watermark", committed.alias("committed"),
                    (F.col("high_watermark") - F.greatest(committed, F.lit(0))).alias("lag"))


LAG_SQL = f"""g AS (SELECT kpart, max(event_id) + 1 AS high_watermark, max(event_id) - {h('kpart')} % 100 AS committed
        FROM ex GROUP BY kpart)"""


@register("X16_consumer_lag", f"""
WITH {EX}, {LAG_SQL} SELECT kpart, high_watermark, committed, high_watermark - greatest(committed, 0) AS lag FROM g""")
def x16(spark, sf):
    """Consumer lag per partition: high watermark - committed offset (a negative commit counts as 0)."""
    return consumer_lag(events_x(Tables(spark, sf).events))


@register("M4_lag_and_max_backlog", f"""
WITH {EX}, {LAG_SQL},
b AS (SELECT kpart, max(n) AS max_hourly FROM (SELECT kpart, date_trunc('hour', ts) AS hr, count(*) AS n FROM ex GROUP BY 1, 2) GROUP BY 1)
SELECT kpart, high_watermark - greatest(committed, 0) AS lag, max_hourly FROM g JOIN b USING (kpart)""")
def m4(spark, sf):
    """Lag per partition and its max over time (largest hourly backlog of the partition)."""
    ex = events_x(Tables(spark, sf).events)
    b = (ex.groupBy("kpart", F.date_trunc("hour", "ts").alias("hr")).agg(F.count(F.lit(1)).alias("n"))
         .groupBy("kpart").agg(F.max("n").alias("max_hourly")))
    return consumer_lag(ex).join(b, "kpart").select("kpart", "lag", "max_hourly")


@register("M5_traffic_and_error_rates", f"""
WITH {EX}, m AS (SELECT {COMPONENT_SQL} AS component, event_type = 'error' AS failed,
                        make_timestamp(CAST(ceil(epoch_us(ts) / 3600000000) AS BIGINT) * 3600000000) AS step FROM ex)
SELECT component, step, count(*) FILTER (WHERE NOT failed) / 3600.0 AS traffic_rate,
       count(*) FILTER (WHERE failed) / 3600.0 AS error_rate FROM m GROUP BY 1, 2""")
def m5(spark, sf):
    """Per component and hour step ``(h - 1 h, h]``: processed and failed messages per second."""
    from quarry.operators.loglake import hour_step
    m = _msgs(spark, sf)
    return m.groupBy("component", hour_step(F.col("ts")).alias("step")).agg(
        (F.count_if(~F.col("failed")) / F.lit(3600.0)).alias("traffic_rate"),
        (F.count_if(F.col("failed")) / F.lit(3600.0)).alias("error_rate"))


def otlp_documents(lineitem):
    """Nested OTLP export: one resourceSpans document per (trace, host) with its spans."""
    s = spans(lineitem)
    ns = lambda c: (F.unix_micros(F.col(c).cast("timestamp")) * 1000).cast("string")
    attr = lambda k, v: F.struct(F.lit(k).alias("key"), F.struct(v.alias("stringValue")).alias("value"))
    span = F.struct(F.col("trace_id").cast("string").alias("traceId"), F.col("span_no").cast("string").alias("spanId"),
                    F.col("name").alias("name"), ns("start").alias("startTimeUnixNano"),
                    ns("end").alias("endTimeUnixNano"),
                    F.array(attr("queue.wait_s", (F.col("l_partkey") % 50 / 10.0).cast("string")),
                            attr("kafka.partition", (F.col("l_suppkey") % 6).cast("string"))).alias("attributes"))
    g = s.groupBy("trace_id", "host").agg(F.collect_list(span).alias("spans"))
    return g.select(F.struct(F.array(attr("service.name", F.lit("object-detector")),
                                     attr("service.instance.id", F.col("host"))).alias("attributes")).alias("resource"),
                    F.array(F.struct(F.col("spans").alias("spans"))).alias("scopeSpans"))


@register("M6_flatten_otlp", f"""
WITH {SPANS}
SELECT CAST(trace_id AS VARCHAR) AS trace_id, 'object-detector' AS service, host, name,
       CAST(epoch_us(start) * 1000 AS VARCHAR) AS start_ns, CAST(epoch_us("end") * 1000 AS VARCHAR) AS end_ns,
       CAST(l_partkey % 50 / 10.0 AS VARCHAR) AS wait_s
FROM spans""")
def m6(spark, sf):
    """Flatten OTLP: resource -> scope -> spans, attribute lists -> maps."""
    flat = mon.flatten_otlp(otlp_documents(Tables(spark, sf).lineitem))
    return flat.select("trace_id", "service", "host", "name", "start_ns", "end_ns",
                       F.col("attrs")["queue.wait_s"].alias("wait_s"))


@register("M7_trace_durations", f"""
WITH {SPANS} SELECT trace_id, count(*) AS spans, epoch_us(max("end")) - epoch_us(min(start)) AS duration_us
FROM spans GROUP BY trace_id""")
def m7(spark, sf):
    """Trace duration = max(end) - min(start) per trace (the longest one is T6)."""
    s = spans(Tables(spark, sf).lineitem)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return s.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"),
                                     (F.max(us("end")) - F.min(us("start"))).alias("duration_us"))


@register("M8_span_timeline", f"""
WITH {SPANS}
SELECT trace_id, span_no, name, epoch_us(start) - min(epoch_us(start)) OVER (PARTITION BY trace_id) AS offset_us,
       duration_s, l_partkey % 50 / 10.0 AS wait_s
FROM spans""")
def m8(spark, sf):
    """Span timeline relative to the trace start, with the queue-wait attribute."""
    s = spans(Tables(spark, sf).lineitem)
    us = F.unix_micros(F.col("start").cast("timestamp"))
    first = s.groupBy("trace_id").agg(F.min(us).alias("first_us"))  # combined before the shuffle: a trace may be large
    return s.join(first, "trace_id").select("trace_id", "span_no", "name", (us - F.col("first_us")).alias("offset_us"), "duration_s",
                    (F.col("l_partkey") % 50 / 10.0).alias("wait_s"))


@register("M9_span_mean_by_instance_group", f"""
WITH {SPANS}
SELECT CASE WHEN host = 'host-0' THEN 'slow' ELSE 'normal' END AS instance_group, count(*) AS spans,
       round(1000 * avg(duration_s) * 1000) / 1000 AS mean_ms
FROM spans WHERE name = 'R' GROUP BY 1""")
def m9(spark, sf):
    """Mean duration of one span name by instance group (the slow instance vs the others)."""
    s = spans(Tables(spark, sf).lineitem).filter(F.col("name") == "R")
    grp = F.when(F.col("host") == "host-0", "slow").otherwise("normal")
    return s.groupBy(grp.alias("instance_group")).agg(
        F.count(F.lit(1)).alias("spans"), (F.round(F.lit(1000) * F.avg("duration_s") * 1000, 0) / 1000).alias("mean_ms"))
