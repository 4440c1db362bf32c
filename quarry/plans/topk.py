"""SURVEY §2.7 sorts, limits, top-k.

Top-k is ``orderBy(...).limit(k)``, planned as TakeOrderedAndProject: every
task keeps its own k best rows and only those reach the final merge.  Every
ordering ends in a total tie-break so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.core import field, floor_hours
from quarry.plans.aggregates import view_counts
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, SPANS
from quarry.sources.derived import access_lines, events_x, spans, status_of
from quarry.sources.tables import Tables


def top_k(df, k: int, *order):
    """Top ``k`` rows by ``order`` (Columns); add a total tie-break to ``order``."""
    return df.orderBy(*order).limit(k)


@register("T1_top5_viewed_paths", f"""
WITH {EX} SELECT path, count(*) AS views FROM ex WHERE is_view GROUP BY path ORDER BY views DESC, path LIMIT 5""")
def t1(spark, sf):
    """Top 5 paths by views, ties by path ascending (``sort -k2,2nr -k1,1 | head -5``)."""
    return top_k(view_counts(events_x(Tables(spark, sf).events)), 5, F.desc("views"), F.asc("path"))


@register("T2_top5_field7_reverse_ties", f"""
WITH {EX}
SELECT path AS field7, count(*) AS n FROM ex GROUP BY path ORDER BY n DESC, field7 DESC LIMIT 5""")
def t2(spark, sf):
    """Top 5 of whitespace field 7 of the access log; ties in reverse text order."""
    lines = access_lines(Tables(spark, sf).events)
    c = lines.groupBy(field("line", 7).alias("field7")).agg(F.count(F.lit(1)).alias("n"))
    return top_k(c, 5, F.desc("n"), F.desc("field7"))


@register("T4_top3_objects_per_6h_window", f"""
WITH {EX},
c AS (SELECT to_timestamp(floor(epoch(ts) / 21600) * 21600)::TIMESTAMP AS window_start, k, count(*) AS n
      FROM ex GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, k) AS rank FROM c)
SELECT window_start, k, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def t4(spark, sf):
    """Top 3 keys per 6-hour window by count (ties: smaller key first)."""
    ex = events_x(Tables(spark, sf).events)
    c = ex.groupBy(floor_hours("ts", 6).alias("window_start"), "k").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("window_start").orderBy(F.desc("n"), F.asc("k"))
    return c.withColumn("rank", F.row_number().over(w)).filter("rank <= 3")


@register("T6_longest_trace", f"""
WITH {SPANS},
d AS (SELECT trace_id, epoch_us(max("end")) - epoch_us(min(start)) AS duration_us FROM spans GROUP BY trace_id),
top AS (SELECT * FROM d ORDER BY duration_us DESC, trace_id LIMIT 1)
SELECT s.trace_id, s.span_no, s.name, s.host, s.start, top.duration_us
FROM spans s JOIN top USING (trace_id)""")
def t6(spark, sf):
    """Argmax: the spans of the trace with the longest duration (ties: smallest trace id)."""
    s = spans(Tables(spark, sf).lineitem)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    d = s.groupBy("trace_id").agg((F.max(us("end")) - F.min(us("start"))).alias("duration_us"))
    top = top_k(d, 1, F.desc("duration_us"), F.asc("trace_id"))
    return s.join(F.broadcast(top), "trace_id").select("trace_id", "span_no", "name", "host", "start", "duration_us")


@register("T7_first_lines_in_time_order", f"""
WITH {EX}
SELECT ts, event_id FROM ex WHERE status >= 500 ORDER BY ts, event_id LIMIT 20""")
def t7(spark, sf):
    """First N (20) server-error lines in forward time order."""
    ex = events_x(Tables(spark, sf).events).filter(status_of(F.col("event_type")) >= 500)
    return top_k(ex.select("ts", "event_id"), 20, F.asc("ts"), F.asc("event_id"))


@register("T8_vocabulary", """
SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part ORDER BY word""")
def t8(spark, sf):
    """Distinct sorted vocabulary of list elements (words of part names)."""
    p = Tables(spark, sf).part
    return p.select(F.explode(F.split("p_name", " ")).alias("word")).distinct().orderBy("word")


@register("T9_first_last_error_time", f"""
WITH {EX} SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM ex WHERE event_type = 'error'""")
def t9(spark, sf):
    """First and last time of a filtered set."""
    ev = Tables(spark, sf).events.filter(F.col("event_type") == "error")
    return ev.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
