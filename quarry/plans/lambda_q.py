"""Lambda architecture queries (A3, X6-X11, X24, J11) at a snapshot of the stream.

Snapshot: the speed layer has seen the events up to ``CUT``; the archiver
has written the lake up to ``LAKE_CUT``.  ``FINAL`` is a cut after the end
of the stream (all watermarks archived).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import lambda_arch as la
from quarry.plans.registry import register
from quarry.plans.sqlx import EX
from quarry.session import scratch_path
from quarry.sources.derived import redelivered
from quarry.sources.tables import Tables
from quarry.streaming.jobs import current_version, publish
from quarry.streaming.topic import run_available

CUT, LAKE_CUT, FINAL = "2024-01-20 13:30:00", "2024-01-20 12:45:00", "2100-01-01 00:00:00"
START = "2024-01-01 00:00:00"


def sql_layers(lake_cut: str = LAKE_CUT, cut: str = CUT) -> str:
    return f"""{EX},
req AS (SELECT 'request' AS type, server, ts AS time, user_id AS "user", 'GET' AS method, path, status, event_id AS "offset" FROM ex),
endt AS (SELECT max(time) AS "end" FROM req),
lake AS (SELECT type, server, time, "user", method, path, status FROM req WHERE time <= TIMESTAMP '{lake_cut}'
         UNION ALL SELECT 'watermark', s.server, e."end", NULL, NULL, NULL, NULL
         FROM (SELECT DISTINCT server FROM req) s, endt e WHERE e."end" <= TIMESTAMP '{lake_cut}'),
lat AS (SELECT server, max(time) AS t FROM lake GROUP BY server),
hz AS (SELECT CASE WHEN count(*) < 4 THEN NULL WHEN min(t) = (SELECT "end" FROM endt) THEN min(t)
                   ELSE date_trunc('hour', min(t)) END AS horizon FROM lat),
batch AS (SELECT path, count(*) AS views, count(DISTINCT "user") AS viewers FROM lake, hz
          WHERE type = 'request' AND method = 'GET' AND path LIKE '/st/%' AND status IN (200, 304) AND time < horizon
          GROUP BY path),
speed AS (SELECT date_trunc('hour', time) AS hour, path, count(*) AS views FROM req
          WHERE time <= TIMESTAMP '{cut}' AND status IN (200, 304) GROUP BY 1, 2),
serving AS (SELECT path, coalesce(b.views, 0) AS batch, coalesce(s.speed, 0) AS speed,
                   coalesce(b.views, 0) + coalesce(s.speed, 0) AS views
            FROM batch b FULL OUTER JOIN (
              SELECT path, CAST(sum(views) AS BIGINT) AS speed FROM speed, hz
              WHERE hour >= date_trunc('hour', coalesce(horizon, TIMESTAMP '{START}')) GROUP BY path) s USING (path))"""


def _layers(spark, sf, lake_cut=LAKE_CUT, cut=CUT, events=None):
    ev = events if events is not None else Tables(spark, sf).events
    req = la.requests(ev)
    lk = la.lake(req, lake_cut)
    hz = la.horizon(lk, req)
    return req, lk, hz


@register("A3_batch_counts_before_horizon", f"WITH {sql_layers()} SELECT * FROM batch")
def a3(spark, sf):
    """Exact batch counts before the horizon: views and distinct viewers per path."""
    _, lk, hz = _layers(spark, sf)
    return la.batch_views(lk, hz)


@register("X6_speed_layer_buckets", f"WITH {sql_layers()} SELECT * FROM speed")
def x6(spark, sf):
    """Speed layer as a stream: each micro-batch adds its views per (hour, path) under its own number, so a repeated
    batch replaces itself; a bucket is the sum of its increments, whatever the batches were."""
    topic, out = scratch_path(spark, "topic-x6"), scratch_path(spark, "x6-buckets")
    req = la.requests(Tables(spark, sf).events)
    req.repartition(4, "offset").write.parquet(topic)

    def add(batch, batch_id):
        la.speed_buckets(batch, CUT).write.mode("overwrite").parquet(f"{out}/batch={batch_id:08d}")

    stream = spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1).parquet(topic)
    run_available(stream.writeStream.foreachBatch(add), scratch_path(spark, "x6-ck"))
    return spark.read.parquet(out).groupBy("hour", "path").agg(F.sum("views").alias("views"))


@register("X6b_speed_latest_per_server", f"""
WITH {sql_layers()} SELECT server, arg_max(time, "offset") AS latest FROM req WHERE time <= TIMESTAMP '{CUT}' GROUP BY server""")
def x6b(spark, sf):
    """Speed layer: the last time seen per server (time of the highest offset)."""
    req, _, _ = _layers(spark, sf)
    seen = req.filter(F.col("time") <= F.lit(CUT).cast("timestamp_ntz"))
    return seen.groupBy("server").agg(F.max_by("time", "offset").alias("latest"))


@register("X7_batch_horizon", f"WITH {sql_layers()} SELECT * FROM hz")
def x7(spark, sf):
    """Horizon: all servers must have data; min of their latest time cut to the hour (END kept)."""
    _, _, hz = _layers(spark, sf)
    return hz


@register("X7b_horizon_at_end", f"WITH {sql_layers(FINAL, FINAL)} SELECT * FROM hz")
def x7b(spark, sf):
    """Horizon after the whole stream is archived: exactly END (watermarks reached)."""
    _, _, hz = _layers(spark, sf, FINAL, FINAL)
    return hz


@register("X8_watermark_punctuation", f"""
WITH {sql_layers(FINAL, FINAL)}
SELECT server, max(time) FILTER (WHERE type = 'request') AS latest_request, max(time) AS latest_any,
       count(*) FILTER (WHERE type = 'watermark') AS watermarks FROM lake GROUP BY server""")
def x8(spark, sf):
    """Punctuation rows: counted in the per-server latest time, excluded from request counts."""
    _, lk, _ = _layers(spark, sf, FINAL, FINAL)
    return lk.groupBy("server").agg(F.max(F.when(F.col("type") == "request", F.col("time"))).alias("latest_request"),
                                    F.max("time").alias("latest_any"),
                                    F.count_if(F.col("type") == "watermark").alias("watermarks"))


@register("X9_serving_view", f"WITH {sql_layers()} SELECT * FROM serving")
def x9(spark, sf):
    """Serving view: batch result plus the speed buckets at or after the horizon hour."""
    req, lk, hz = _layers(spark, sf)
    return la.serving_view(la.batch_views(lk, hz), la.speed_buckets(req, CUT), hz, START)


@register("J11_merge_batch_and_speed", f"""
WITH {sql_layers()} SELECT path, batch, speed FROM serving WHERE batch = 0 OR speed = 0""")
def j11(spark, sf):
    """Full outer merge of batch and speed per key: keys present on one side only get 0 on the other."""
    return x9(spark, sf).filter((F.col("batch") == 0) | (F.col("speed") == 0)).select("path", "batch", "speed")


@register("X10_atomic_batch_replace", f"WITH {sql_layers()} SELECT * FROM batch")
def x10(spark, sf):
    """A batch run writes a new version and then publishes its pointer; readers follow the highest one."""
    _, lk, hz = _layers(spark, sf)
    base = scratch_path(spark, "x10")
    older = la.batch_views(_layers(spark, sf, "2024-01-10 00:00:00")[1], hz)
    older.write.parquet(f"{base}/run=1")
    publish(spark, base, 1, f"{base}/run=1")
    la.batch_views(lk, hz).write.parquet(f"{base}/run=2")
    publish(spark, base, 2, f"{base}/run=2")  # after the new version is complete
    return current_version(spark, base)


@register("X11_redelivery_error", f"""
WITH {EX},
t AS (SELECT path, count(*) AS truth FROM ex WHERE status IN (200, 304) GROUP BY path),
s AS (SELECT path, count(*) AS shown FROM (SELECT * FROM ex UNION ALL SELECT * FROM ex WHERE event_id % 10 = 3)
      WHERE status IN (200, 304) GROUP BY path)
SELECT path, shown, truth, shown - truth AS error FROM t JOIN s USING (path)""")
def x11(spark, sf):
    """Redelivery after a crash: the speed layer counts the uncommitted range again; error = shown - true."""
    ev = Tables(spark, sf).events
    truth = la.speed_buckets(la.requests(ev), FINAL).groupBy("path").agg(F.sum("views").alias("truth"))
    shown = la.speed_buckets(la.requests(redelivered(ev)), FINAL).groupBy("path").agg(F.sum("views").alias("shown"))
    return shown.join(truth, "path").select("path", "shown", "truth", (F.col("shown") - F.col("truth")).alias("error"))


CUTS = [f"2024-01-{d:02d} 00:00:00" for d in range(3, 31, 3)]
LAKE_LAG_H = 1


@register("X24_timeline_per_snapshot", f"""
WITH {EX},
req AS (SELECT server, ts AS time, status FROM ex),
endt AS (SELECT max(time) AS "end" FROM req),
cuts AS (SELECT CAST(c AS TIMESTAMP) AS cut FROM (VALUES {', '.join(f"('{c}')" for c in CUTS)}) v(c)),
lat AS (SELECT cut, server, max(time) AS t FROM cuts, req WHERE time <= cut - INTERVAL {LAKE_LAG_H} HOUR GROUP BY 1, 2),
hz AS (SELECT cut, CASE WHEN count(*) < 4 THEN NULL WHEN min(t) = (SELECT "end" FROM endt) THEN min(t)
              ELSE date_trunc('hour', min(t)) END AS horizon FROM lat GROUP BY cut),
c AS (SELECT cuts.cut, hz.horizon FROM cuts LEFT JOIN hz USING (cut)),
v AS (SELECT c.cut,
        count(*) FILTER (WHERE time < horizon) AS batch,
        count(*) FILTER (WHERE time <= c.cut AND time >= date_trunc('hour', coalesce(horizon, TIMESTAMP '{START}'))) AS speed,
        count(*) FILTER (WHERE time <= c.cut) AS truth
      FROM c, req WHERE status IN (200, 304) GROUP BY c.cut)
SELECT cut, batch, speed, batch + speed AS total, batch + speed - truth AS error FROM v""")
def x24(spark, sf):
    """Timeline of batch, speed, total and error at a list of snapshot times.

    Events are first reduced to per (server, hour) counts and maxima, so the
    cut table (bounded by the parameter list) multiplies only that small table.
    """
    req = la.requests(Tables(spark, sf).events)
    end = la.end_time(req)
    hourly = req.groupBy("server", F.date_trunc("hour", "time").cast("timestamp_ntz").alias("hour")).agg(
        F.max("time").alias("t"), F.count_if(la.is_view()).alias("views"))
    cuts = spark.createDataFrame([(c,) for c in CUTS], "cut string").select(F.col("cut").cast("timestamp_ntz").alias("cut"))
    lag = F.expr(f"INTERVAL {LAKE_LAG_H} HOUR")
    # cuts are whole hours and the lake lags whole hours: a full hour is in or out as a whole
    lat = (hourly.crossJoin(F.broadcast(cuts)).filter(F.col("hour") < F.col("cut") - lag)
           .groupBy("cut", "server").agg(F.max("t").alias("t")))
    hz = lat.groupBy("cut").agg(F.count(F.lit(1)).alias("servers"), F.min("t").alias("min_t")).crossJoin(end)
    hz = hz.select("cut", F.when(F.col("servers") < 4, F.lit(None)).when(F.col("min_t") == F.col("end"), F.col("min_t"))
                   .otherwise(F.date_trunc("hour", "min_t")).cast("timestamp_ntz").alias("horizon"))
    c = cuts.join(hz, "cut", "left")
    hv = hourly.groupBy("hour").agg(F.sum("views").alias("views"))
    hstart = F.date_trunc("hour", F.coalesce("horizon", F.lit(START).cast("timestamp_ntz")))
    v = hv.crossJoin(F.broadcast(c)).groupBy("cut").agg(
        F.coalesce(F.sum(F.when(F.col("hour") < F.col("horizon"), F.col("views"))), F.lit(0)).alias("batch"),
        F.coalesce(F.sum(F.when((F.col("hour") < F.col("cut")) & (F.col("hour") >= hstart), F.col("views"))), F.lit(0))
        .alias("speed"),
        F.coalesce(F.sum(F.when(F.col("hour") < F.col("cut"), F.col("views"))), F.lit(0)).alias("truth"))
    return v.select("cut", "batch", "speed", (F.col("batch") + F.col("speed")).alias("total"),
                    (F.col("batch") + F.col("speed") - F.col("truth")).alias("error"))
