"""Partitioning analytics: node assignment strategies and the consistent-hash ring.

The ring lookup is a range join: a key hash ``h`` belongs to the first ring
point strictly greater than ``h`` (``bisect_right``), wrapping to the first
point.  The ring is turned into half-open intervals ``[lo, hi)`` and each
interval is exploded into the 2^24-wide buckets it overlaps, so the join is
an equi join on ``bucket = h >> 24`` plus a range filter - never a nested
loop.  The ring has ``nodes x points`` rows, a size fixed by parameters, so
it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.core import stable_hash

HASH_SPACE = 1 << 32
BUCKET_SHIFT = 24


def ring_points(spark: SparkSession, nodes: int, points: int = 100) -> DataFrame:
    """Ring points ``(point, node)``: the stable hash of ``node<n>-<i>``."""
    base = spark.range(nodes * points).select(
        (F.col("id") / points).cast("int").alias("node"), (F.col("id") % points).cast("int").alias("i"))
    return base.select(stable_hash(F.concat(F.lit("node"), F.col("node").cast("string"), F.lit("-"),
                                            F.col("i").cast("string"))).alias("point"), "node")


def ring_intervals(spark: SparkSession, nodes: int, points: int = 100) -> DataFrame:
    """Half-open intervals ``[lo, hi)`` of key hashes per owning node, exploded to buckets.

    Sorting the ``nodes x points`` ring is a window without partition over a
    table whose size is fixed by the parameters (not by the data).
    """
    p = ring_points(spark, nodes, points)
    w = Window.orderBy("point", "node")
    r = p.withColumn("prev", F.lag("point").over(w)).withColumn("rank", F.row_number().over(w))
    first_node = r.filter(F.col("rank") == 1).select(F.col("node").alias("first_node"))
    last_point = r.agg(F.max("point").alias("last_point"))
    inner = r.select(F.coalesce("prev", F.lit(0)).alias("lo"), F.col("point").alias("hi"), "node")
    wrap = last_point.crossJoin(first_node).select(F.col("last_point").alias("lo"),
                                                   F.lit(HASH_SPACE).cast("bigint").alias("hi"),
                                                   F.col("first_node").alias("node"))
    iv = inner.unionByName(wrap).filter(F.col("lo") < F.col("hi"))
    return iv.withColumn("bucket", F.explode(F.sequence(
        F.shiftright("lo", BUCKET_SHIFT), F.shiftright(F.col("hi") - 1, BUCKET_SHIFT))))


def ring_node(df: DataFrame, key: Column | str, nodes: int, points: int = 100, name: str = "node") -> DataFrame:
    """Owner node of every row's key on a consistent-hash ring."""
    spark = df.sparkSession
    iv = ring_intervals(spark, nodes, points).select(
        F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
        F.col("node").alias(name))
    k = F.col(key) if isinstance(key, str) else key
    d = df.withColumn("_h", stable_hash(k)).withColumn("_bucket", F.shiftright("_h", BUCKET_SHIFT))
    j = d.join(F.broadcast(iv), (d["_bucket"] == iv["_bucket"]) & (d["_h"] >= iv["_lo"]) & (d["_h"] < iv["_hi"]))
    return j.drop("_h", "_bucket", "_lo", "_hi")


def month_range_nodes(months: DataFrame, month_col: str, nodes: int, first: int = 6) -> DataFrame:
    """The first ``first`` sorted months split into ``nodes`` equal ranges (extra months to the
    first ranges, as ``array_split``); later months go to the last node.

    The window runs over the distinct month list, which is small (one row per month).
    """
    w = Window.orderBy(month_col)
    m = months.select(month_col).distinct().withColumn("_rank", F.row_number().over(w))
    head = m.filter(F.col("_rank") <= first).withColumn("node", (F.ntile(nodes).over(w) - 1).cast("int"))
    tail = m.filter(F.col("_rank") > first).withColumn("node", F.lit(nodes - 1))
    return head.unionByName(tail).drop("_rank")
