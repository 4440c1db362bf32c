"""SURVEY §2.6 window functions (W1, W3-W5, W8-W12) and the global sort T5.

Running values over a per-key or global order use the blockwise prefix
operators of :mod:`quarry.operators.ordering`; a plain ``Window`` is used only
when its partition is bounded (top-N per key with ``row_number() <= N``,
which Spark plans with a partial WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.late import late_flags
from quarry.operators.monitoring import max_over_time
from quarry.operators.ordering import count_decreases, count_in_range, global_row_number, prefix_running, running_last
from quarry.plans.registry import register
from quarry.plans.sqlx import ARRIVAL, EX, ES
from quarry.sources.derived import ES_TYPE, arrival_key, events_x
from quarry.sources.tables import Tables

DAY_US = 86400 * 1_000_000


@register("W1_order_violations_keyed_vs_not", f"""
WITH {EX},
e AS (SELECT user_id AS photo_id, event_id AS seq, {ES} AS type, {ARRIVAL} AS arrival FROM ex WHERE event_type <> 'view'),
u AS (SELECT photo_id, seq < lag(seq) OVER (PARTITION BY photo_id ORDER BY arrival, seq) AS d FROM e),
v AS (SELECT photo_id, arg_max(type, {{'a': arrival, 's': seq}}) AS applied_last, arg_max(type, seq) AS true_last FROM e GROUP BY 1)
SELECT 'keyed' AS mode, CAST(0 AS BIGINT) AS photos_out_of_order, CAST(0 AS BIGINT) AS deleted_still_visible
UNION ALL SELECT 'unkeyed', (SELECT count(DISTINCT photo_id) FROM u WHERE d),
  (SELECT count(*) FROM v WHERE applied_last <> 'deletePhoto' AND true_last = 'deletePhoto')""")
def w1(spark, sf):
    """Per photo: events applied out of order, and deleted photos still visible, keyed vs unkeyed.

    Keyed delivery applies each photo's events in producer order (seq); without
    a key they are applied in (hash-scattered) arrival order.
    """
    from quarry.sources.derived import _map_col
    ex = events_x(Tables(spark, sf).events).filter(F.col("event_type") != "view")
    e = ex.select(F.col("user_id").alias("photo_id"), F.col("event_id").alias("seq"),
                  _map_col(F.col("event_type"), ES_TYPE).alias("type"), arrival_key().alias("arrival"))

    def stats(mode, order):
        dec = count_decreases(e, order, "seq", ["photo_id"])
        bad = dec.agg(F.count_if(F.col("decreases") > 0).alias("photos_out_of_order"))
        last = F.struct(*[F.col(c) for c in order])
        vis = e.groupBy("photo_id").agg(F.max_by("type", last).alias("applied"), F.max_by("type", "seq").alias("true"))
        vis = vis.agg(F.count_if((F.col("applied") != "deletePhoto") & (F.col("true") == "deletePhoto"))
                      .alias("deleted_still_visible"))
        return bad.crossJoin(vis).select(F.lit(mode).alias("mode"), "photos_out_of_order", "deleted_still_visible")

    return stats("keyed", ["seq"]).unionByName(stats("unkeyed", ["arrival", "seq"]))


@register("W3_late_events_exact", f"""
WITH a AS (SELECT event_id, epoch_us(ts) AS t, (epoch_us(ts) // 21600000000) * 21600000000 AS w, {ARRIVAL} AS arrival FROM events),
r AS (SELECT *, max(t) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max,
             row_number() OVER (PARTITION BY w ORDER BY arrival, event_id) AS rn FROM a)
SELECT make_timestamp(w) AS window_start, count(*) FILTER (WHERE NOT (rn > 1 AND w + 28800000000 < prev_max)) AS counted,
       count(*) FILTER (WHERE rn > 1 AND w + 28800000000 < prev_max) AS late
FROM r GROUP BY w""")
def w3(spark, sf):
    """Late events per 6-hour window under out-of-order arrival (reported at window end + 2 h)."""
    ev = Tables(spark, sf).events.select("event_id", "ts").withColumn("arrival", arrival_key())
    f = late_flags(ev, "ts", ["arrival", "event_id"])
    return f.groupBy("window_start").agg(F.count_if(~F.col("late")).alias("counted"),
                                         F.count_if(F.col("late")).alias("late"))


RL_WINDOW_S, RL_LIMIT = 6 * 3600, 3


@register("W4_sliding_rate_limit", f"""
WITH r AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
             RANGE BETWEEN {RL_WINDOW_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS in_window FROM events)
SELECT event_id, user_id, in_window, CASE WHEN in_window > {RL_LIMIT} THEN 429 ELSE 200 END AS status FROM r""")
def w4(spark, sf):
    """Sliding-window limit: requests of the user in ``(t - W, t]`` (rejected ones count too); > limit -> 429.

    Window and limit are parameters (the gateway uses 1 s and 20; the events
    here are sparser, so 6 h and 3 are used to produce rejections).
    """
    ev = Tables(spark, sf).events.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    c = count_in_range(ev, ["user_id"], "us", "event_id", RL_WINDOW_S * 1_000_000, name="in_window")
    return c.select("event_id", "user_id", "in_window",
                    F.when(F.col("in_window") > RL_LIMIT, 429).otherwise(200).alias("status"))


@register("W5_attempt_number", """
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS attempt
FROM events WHERE event_type = 'error'""")
def w5(spark, sf):
    """Attempt number of each failed upload per user, in time order."""
    ev = Tables(spark, sf).events.filter(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    r = prefix_running(ev, ["user_id"], ["ts", "event_id"])
    return r.select("event_id", "user_id", F.col("_rank").alias("attempt"))


@register("W8_last_n_per_key", """
SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS rn FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn <= 3""")
def w8(spark, sf):
    """Last 3 orders per customer (``row_number() <= N``: partial top-N before the shuffle)."""
    o = Tables(spark, sf).orders
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return o.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rn")).filter("rn <= 3")


N_KP = 6


@register("W9_progress_every_25th", f"""
WITH {EX}, r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n,
  {', '.join(f'CAST(sum(CASE WHEN kpart = {p} THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS p{p}' for p in range(N_KP))}
  FROM ex)
SELECT CAST(n AS BIGINT) AS n, {', '.join(f'p{p}' for p in range(N_KP))} FROM r WHERE n % 25 = 0""")
def w9(spark, sf):
    """Progress rows: at every 25th message, the running count of messages per partition."""
    ex = events_x(Tables(spark, sf).events).select("event_id", "kpart")
    g = prefix_running(ex, [], ["event_id"]).withColumnRenamed("_rank", "n")
    k = prefix_running(g, ["kpart"], ["event_id"]).withColumnRenamed("_rank", "kn")
    for p in range(N_KP):
        k = k.withColumn(f"_c{p}", F.when(F.col("kpart") == p, F.col("kn")))
    r = running_last(k, [], ["event_id"], [f"_c{p}" for p in range(N_KP)])
    return r.filter(F.col("n") % 25 == 0).select(
        "n", *[F.coalesce(F.col(f"_c{p}_last"), F.lit(0)).cast("bigint").alias(f"p{p}") for p in range(N_KP)])


@register("W10_counter_increase_rate", f"""
WITH s AS (SELECT event_type, event_id, ts, CAST(ceil(epoch_us(ts) / {DAY_US}) AS BIGINT) AS bucket,
             row_number() OVER (PARTITION BY event_type, (epoch_us(ts) - 1704067200000000) // {10 * DAY_US} ORDER BY ts, event_id) AS v
           FROM events),
d AS (SELECT *, lag(v) OVER w AS pv, lag(bucket) OVER w AS pb FROM s WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT event_type, make_timestamp(bucket * {DAY_US}) AS eval_time,
       CAST(coalesce(sum(CASE WHEN pb = bucket THEN CASE WHEN v >= pv THEN v - pv ELSE v END END), 0) AS BIGINT) AS increase,
       coalesce(sum(CASE WHEN pb = bucket THEN CASE WHEN v >= pv THEN v - pv ELSE v END END), 0) / 86400.0 AS rate
FROM d GROUP BY 1, 2""")
def w10(spark, sf):
    """Counter increase and rate over 1-day ranges ``(t - 1d, t]`` per type; a drop is a reset.

    The counter is the running count of events per type, restarting every 10
    days (a process restart).  Only deltas between samples inside the range
    count (no extrapolation).
    """
    ev = Tables(spark, sf).events.select("event_type", "event_id", "ts")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ev = (ev.withColumn("bucket", F.ceil(us / F.lit(DAY_US)).cast("bigint"))
          .withColumn("epoch10", F.floor((us - F.lit(1704067200000000)) / F.lit(10 * DAY_US)).cast("bigint")))
    c = prefix_running(ev, ["event_type", "epoch10"], ["ts", "event_id"]).withColumnRenamed("_rank", "v")
    p = running_last(c.withColumn("_pv", F.col("v")).withColumn("_pb", F.col("bucket")), ["event_type"],
                     ["ts", "event_id"], ["_pv", "_pb"], exclusive=True, suffix="_prev")
    delta = F.when(F.col("_pb_prev") == F.col("bucket"),
                   F.when(F.col("v") >= F.col("_pv_prev"), F.col("v") - F.col("_pv_prev")).otherwise(F.col("v")))
    g = p.groupBy("event_type", "bucket").agg(F.coalesce(F.sum(delta), F.lit(0)).alias("increase"))
    return g.select("event_type", F.timestamp_micros(F.col("bucket") * F.lit(DAY_US)).cast("timestamp_ntz").alias("eval_time"),
                    F.col("increase").cast("bigint").alias("increase"), (F.col("increase") / F.lit(86400.0)).alias("rate"))


@register("W11_max_over_time_of_sum", f"""
WITH {EX}, g AS (SELECT server, kpart, date_trunc('hour', ts) AS step, count(*) AS lag FROM ex GROUP BY 1, 2, 3),
s AS (SELECT server, step, CAST(sum(lag) AS BIGINT) AS total FROM g GROUP BY 1, 2)
SELECT server, max(total) AS max_total FROM s GROUP BY server""")
def w11(spark, sf):
    """Max over time of a gauge summed by component (per-partition backlog per hour)."""
    ex = events_x(Tables(spark, sf).events)
    g = ex.groupBy("server", "kpart", F.date_trunc("hour", "ts").alias("step")).agg(F.count(F.lit(1)).alias("lag"))
    s = g.groupBy("server", "step").agg(F.sum("lag").alias("total"))
    return s.groupBy("server").agg(F.max("total").alias("max_total"))


@register("W11b_max_over_time_at_each_step", f"""
WITH {EX}, s AS (SELECT server, CAST(ceil(epoch_us(ts) / 60000000) AS BIGINT) AS i, count(*) AS total FROM ex GROUP BY 1, 2)
SELECT server, make_timestamp(i * 60000000) AS step, total,
       max(total) OVER (PARTITION BY server ORDER BY i RANGE BETWEEN 359 PRECEDING AND CURRENT ROW) AS max_over_time FROM s""")
def w11b(spark, sf):
    """Max over time of a summed gauge, ``[6h:1m]`` at every step: the busiest minute of each server in the 6 hours before."""
    ex = events_x(Tables(spark, sf).events)
    return max_over_time(ex, ["server"], "ts", F.count(F.lit(1)), 6 * 3600, 60)


ANCHOR = 133422131


@register("W12_dense_global_number", f"""
SELECT o_orderkey, {ANCHOR} - 1 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS photo_no FROM orders""")
def w12(spark, sf):
    """Dense global number in time order, anchored so that the first row gets a given number."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    r = global_row_number(o, ["o_orderdate", "o_orderkey"])
    return r.select("o_orderkey", (F.lit(ANCHOR - 1) + F.col("row_no")).alias("photo_no"))


@register("T5_global_stable_sort", f"""
WITH {EX} SELECT event_id, server, row_number() OVER (ORDER BY ts, server, event_id) AS pos FROM ex""")
def t5(spark, sf):
    """Global stable sort by time of 4 server sources, which one scan reads (position by blockwise numbering)."""
    ex = events_x(Tables(spark, sf).events).select("event_id", "ts", "server")
    r = global_row_number(ex, ["ts", "server", "event_id"], name="pos")
    return r.select("event_id", "server", "pos")
