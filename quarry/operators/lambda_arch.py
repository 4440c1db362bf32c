"""Lambda architecture over the view log: lake, batch layer, speed layer, serving view.

All layers are DataFrame aggregates over the same events:

* lake     - requests archived up to a time, plus one ``watermark`` punctuation
             row per server at the end of the stream (X8);
* horizon  - only when every server has data: the minimum over servers of their
             latest time, cut to the hour, except exactly END (X7);
* batch    - exact views / distinct viewers per path before the horizon (A3);
* speed    - +1 per view in the (hour, path) bucket, for events up to the cut (X6);
* serving  - batch + speed buckets with ``hour >= horizon hour`` (X9, J11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.derived import N_SERVERS, events_x, status_of


def requests(events: DataFrame) -> DataFrame:
    """View-log requests: type, server, time, user, method, path, status, offset (event id)."""
    ex = events_x(events)
    return ex.select(F.lit("request").alias("type"), "server", F.col("ts").alias("time"),
                     F.col("user_id").alias("user"), F.lit("GET").alias("method"), "path",
                     status_of(F.col("event_type")).alias("status"), F.col("event_id").alias("offset"))


def is_view(method="method", path="path", status="status"):
    """P5: GET of a path under /st/ answered with 200 or 304."""
    return (F.col(method) == "GET") & F.col(path).startswith("/st/") & F.col(status).isin(200, 304)


def end_time(req: DataFrame) -> DataFrame:
    return req.agg(F.max("time").alias("end"))


def lake(req: DataFrame, lake_cut) -> DataFrame:
    """Requests archived up to ``lake_cut`` plus per-server watermark rows at END once reached."""
    cut = F.lit(lake_cut).cast("timestamp_ntz")
    arch = req.filter(F.col("time") <= cut)
    end = end_time(req)
    marks = (req.select("server").distinct().crossJoin(end).filter(F.col("end") <= cut)
             .select(F.lit("watermark").alias("type"), "server", F.col("end").alias("time"),
                     F.lit(None).cast("bigint").alias("user"), F.lit(None).cast("string").alias("method"),
                     F.lit(None).cast("string").alias("path"), F.lit(None).cast("int").alias("status"),
                     F.lit(None).cast("bigint").alias("offset")))
    return arch.unionByName(marks)


def horizon(lake_df: DataFrame, req: DataFrame, partitions: int = N_SERVERS) -> DataFrame:
    """One row ``horizon`` (null while a server has no data)."""
    latest = lake_df.groupBy("server").agg(F.max("time").alias("t"))
    agg = latest.agg(F.count(F.lit(1)).alias("servers"), F.min("t").alias("min_t"))
    h = F.when(F.col("servers") < partitions, F.lit(None)).when(
        F.col("min_t") == F.col("end"), F.col("min_t")).otherwise(F.date_trunc("hour", "min_t"))
    return agg.crossJoin(end_time(req)).select(h.cast("timestamp_ntz").alias("horizon"))


def batch_views(lake_df: DataFrame, hz: DataFrame) -> DataFrame:
    """A3: exact views and distinct viewers per path before the horizon."""
    v = lake_df.filter((F.col("type") == "request") & is_view()).crossJoin(F.broadcast(hz))
    return v.filter(F.col("time") < F.col("horizon")).groupBy("path").agg(
        F.count(F.lit(1)).alias("views"), F.countDistinct("user").alias("viewers"))


def speed_buckets(req: DataFrame, cut) -> DataFrame:
    """Views per (hour, path) of the events seen up to ``cut``."""
    seen = req.filter(F.col("time") <= F.lit(cut).cast("timestamp_ntz"))
    return seen.filter(is_view()).groupBy(F.date_trunc("hour", "time").cast("timestamp_ntz").alias("hour"), "path").agg(
        F.count(F.lit(1)).alias("views"))


def serving_view(batch: DataFrame, speed: DataFrame, hz: DataFrame, default_horizon) -> DataFrame:
    """Per path ``batch + speed`` with speed buckets at or after the horizon hour."""
    h = hz.select(F.coalesce("horizon", F.lit(default_horizon).cast("timestamp_ntz")).alias("h"))
    sp = (speed.crossJoin(F.broadcast(h)).filter(F.col("hour") >= F.date_trunc("hour", "h"))
          .groupBy("path").agg(F.sum("views").alias("speed")))
    b = batch.select("path", F.col("views").alias("batch"))
    j = b.join(sp, "path", "full_outer")
    return j.select("path", F.coalesce("batch", F.lit(0)).alias("batch"), F.coalesce("speed", F.lit(0)).alias("speed"),
                    (F.coalesce("batch", F.lit(0)) + F.coalesce("speed", F.lit(0))).alias("views"))
