"""Metrics and traces as DataFrames (M1-M9): histograms, quantiles, OTLP flattening.

Histogram bucket counts are a plain aggregate (bucket index from a CASE on
the fixed bounds), cumulated by a window over at most ``len(bounds) + 1``
rows per label; ``histogram_quantile`` interpolates linearly inside the
bucket where the rank falls, starting the first bucket at 0 and answering
the highest finite bound when the rank lands in ``+Inf``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Latency histogram bounds in seconds (15 buckets plus +Inf).
SECONDS = [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1, 1.5, 2, 3, 5, 10, 20, 30, 60]


def bucket_index(value: Column, bounds: list[float]) -> Column:
    """Index of the first bound with ``value <= bound``; ``len(bounds)`` for +Inf."""
    expr = None
    for i, b in enumerate(bounds):
        cond = value <= F.lit(float(b))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(bounds)))


def cumulative_histogram(df: DataFrame, label_cols: list[str], value_col: str, bounds: list[float]) -> DataFrame:
    """M2: ``(labels, b, le, bucket_count, cum_count)`` for every label and every bucket (0-filled)."""
    spark = df.sparkSession
    les = spark.createDataFrame([(i, float(b)) for i, b in enumerate(bounds)] + [(len(bounds), float("inf"))],
                                "b int, le double")
    counts = df.groupBy(*label_cols, bucket_index(F.col(value_col), bounds).alias("b")).agg(
        F.count(F.lit(1)).alias("bucket_count"))
    labels = df.select(*label_cols).distinct()
    grid = labels.crossJoin(F.broadcast(les))
    full = grid.join(counts, [*label_cols, "b"], "left").withColumn(
        "bucket_count", F.coalesce("bucket_count", F.lit(0).cast("bigint")))
    w = Window.partitionBy(*label_cols).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    return full.withColumn("cum_count", F.sum("bucket_count").over(w))


def histogram_quantile(hist: DataFrame, label_cols: list[str], q: float) -> DataFrame:
    """M3: the ``q`` quantile per label from a cumulative histogram (PromQL semantics)."""
    tot = hist.groupBy(*label_cols).agg(F.max("cum_count").alias("total"))
    h = hist.join(tot, label_cols)
    w = Window.partitionBy(*label_cols).orderBy("b")
    h = h.withColumn("lower", F.coalesce(F.lag("le").over(w), F.lit(0.0))).withColumn(
        "cum_prev", F.coalesce(F.lag("cum_count").over(w), F.lit(0).cast("bigint")))
    h = h.withColumn("rank", F.lit(q) * F.col("total"))
    hit = h.filter(F.col("cum_count") >= F.col("rank")).groupBy(*label_cols).agg(F.min("b").alias("b"))
    r = h.join(hit, [*label_cols, "b"])
    finite_max = F.col("lower")  # the bound before +Inf is the highest finite bound
    val = (F.when(F.col("total") == 0, F.lit(None).cast("double"))
           .when(F.col("le") == float("inf"), finite_max)
           .otherwise(F.col("lower") + (F.col("le") - F.col("lower"))
                      * (F.col("rank") - F.col("cum_prev")) / F.col("bucket_count")))
    return r.select(*label_cols, val.alias("quantile"))


def flatten_otlp(doc: DataFrame) -> DataFrame:
    """M6: OTLP ``resourceSpans`` -> one row per span with resource labels and an attribute map."""
    rs = doc.select(
        F.map_from_entries(F.transform("resource.attributes", lambda a: F.struct(a["key"], a["value"]["stringValue"])))
        .alias("res"), F.explode("scopeSpans").alias("scope"))
    sp = rs.select("res", F.explode("scope.spans").alias("s"))
    return sp.select(
        F.col("s.traceId").alias("trace_id"), F.col("res")["service.name"].alias("service"),
        F.col("res")["service.instance.id"].alias("host"), F.col("s.name").alias("name"),
        F.col("s.startTimeUnixNano").alias("start_ns"), F.col("s.endTimeUnixNano").alias("end_ns"),
        F.map_from_entries(F.transform("s.attributes", lambda a: F.struct(a["key"], a["value"]["stringValue"])))
        .alias("attrs"))


def max_over_time(samples: DataFrame, labels: list[str], ts: str, value: Column, range_s: int, step_s: int) -> DataFrame:
    """``max_over_time(<value> by (labels)[range:step])`` at every step that has a value.

    ``value`` is an aggregate over the samples in ``(step - step_s, step]``; the
    result has ``labels``, ``step``, ``total`` and ``max_over_time``, the largest
    total of the steps in ``(step - range_s, step]``.  ``range_s`` is a multiple of
    ``step_s``; a step without samples has no value, samples without a time have no step.

    Time is cut into panes of one range, so a range is the end of one pane and the
    start of the next.  Each pane gets its totals and those of the pane before, at
    the step where they leave the range; the answer is the larger of a running
    maximum forwards (own totals) and one backwards (totals that have not left).
    A pane holds at most two ranges of steps, whatever the number of samples.
    """
    width = range_s // step_s
    if width * step_s != range_s or width < 1:
        raise ValueError(f"a range of {range_s} s is no multiple of {step_s} s")
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    stepped = samples.filter(F.col(ts).isNotNull()).withColumn("_step", F.ceil(us / F.lit(step_s * 1_000_000)).cast("bigint"))
    totals = stepped.groupBy(*labels, "_step").agg(value.alias("total"))
    pane = F.floor(F.col("_step") / width).cast("bigint")
    own = F.struct(pane.alias("pane"), F.col("_step").alias("at"), F.lit(0).alias("left"))
    later = F.struct((pane + 1).alias("pane"), (F.col("_step") + width).alias("at"), F.lit(1).alias("left"))
    dealt = totals.select(*labels, "_step", "total", F.explode(F.array(own, later)).alias("_p")).select("*", "_p.*").drop("_p")
    part = Window.partitionBy(*labels, "pane")
    whole = (Window.unboundedPreceding, Window.currentRow)
    before = F.max(F.when(F.col("left") == 0, F.col("total"))).over(part.orderBy("at", "left").rowsBetween(*whole))
    # backwards, own totals come first among equals: a total that leaves at this step is out
    after = F.max(F.when(F.col("left") == 1, F.col("total"))).over(part.orderBy(F.desc("at"), "left").rowsBetween(*whole))
    best = dealt.select(*labels, "_step", "total", "left", F.greatest(before, after).alias("max_over_time")).filter(F.col("left") == 0)
    step = F.timestamp_micros(F.col("_step") * F.lit(step_s * 1_000_000)).cast("timestamp_ntz").alias("step")
    return best.select(*labels, step, "total", "max_over_time")
