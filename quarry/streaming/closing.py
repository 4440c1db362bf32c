"""A stream that reports each window once, when it closes, and counts late events exactly.

A window closes as soon as an event over ``allowed`` hours past its end has
arrived; what arrives for it later is late (the rule of W3).  The answer depends
on the order of arrival only, not on how the stream is cut into micro-batches:
inside a batch the flags come from the blockwise prefix operator
(:func:`late_flags`), and the state says what earlier batches had seen.  The
batches must follow each other in order of arrival; inside a batch rows may lie
in any order and any number of files.

State is a table per batch: counts by (window, object) of open windows, one row
for each closed window (its late events, and that it was seen), and the latest
event time; it grows with the objects of open windows, not with the events.  A
batch that runs again reads the state before it and writes the same files again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.late import late_flags
from quarry.session import delete_path

STATE = "window_start timestamp_ntz, obj string, n bigint, late bigint, reported boolean, latest timestamp_ntz"
REPORT = "window_start timestamp_ntz, total bigint, top string, batch int"


class WindowReporter:
    """``foreachBatch`` target for rows (ts, obj, arrival, event_id); reports and state lie in ``base``."""

    def __init__(self, spark: SparkSession, base: str, window_h: int = 6, allowed_h: int = 2, top: int = 3):
        self.spark, self.base, self.window_h, self.allowed_h, self.top = spark, base, window_h, allowed_h, top

    def state(self, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return self.spark.range(0).select(F.from_json(F.lit("{}"), STATE).alias("s")).select("s.*")
        return self.spark.read.schema(STATE).parquet(f"{self.base}/state/v={batch_id}")

    def reports(self) -> DataFrame:
        return self.spark.read.schema(REPORT).parquet(f"{self.base}/reports")

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.state(batch_id - 1)
        # what was seen before comes first: every window that had an event, and the latest time
        seen = before.select(F.explode(F.array_distinct(F.array("window_start", "latest"))).alias("ts")).distinct()
        first = seen.select("ts", F.lit(None).cast("string").alias("obj"), F.lit(-1 << 63).alias("arrival"), F.lit(-1).cast("bigint").alias("event_id"), F.lit(True).alias("known"))
        # messages are read and parsed once, and the order of arrival is gone through once
        rows = self.stored(batch.select("ts", "obj", "arrival", "event_id", F.lit(False).alias("known")).union(first), f"rows-{batch_id}")
        flags = late_flags(rows, "ts", ["arrival", "event_id"], self.window_h, self.allowed_h).filter("not known")
        now = flags.groupBy("window_start", "obj").agg(F.count_if(~F.col("late")).alias("n"), F.count_if(F.col("late")).alias("late"), F.max("ts").alias("latest"))
        now = self.stored(now, f"now-{batch_id}")
        both = before.select("window_start", "obj", "n", "late", "reported", "latest").union(now.select("window_start", "obj", "n", "late", F.lit(False), "latest"))
        # one row per (window, object); the latest time and the windows' marks belong to all their rows
        latest = both.agg(F.max("latest")).first()[0]
        marks = both.groupBy("window_start").agg(F.max("reported").alias("was"))
        counts = both.groupBy("window_start", "obj").agg(F.sum("n").alias("n"), F.sum("late").alias("late")).join(marks, "window_start")
        counts = counts.withColumn("latest", F.lit(latest).cast("timestamp_ntz"))
        closed = F.col("window_start") + F.expr(f"interval {self.window_h + self.allowed_h} hours") < F.col("latest")
        counts = self.stored(counts.withColumn("closed", closed), f"counts-{batch_id}")

        ranked = counts.filter("closed and not was and n > 0").withColumn("rn", F.row_number().over(Window.partitionBy("window_start").orderBy(F.desc("n"), "obj")))
        best = F.array_sort(F.collect_list(F.when(F.col("rn") <= self.top, F.struct("rn", F.concat_ws(" ", "obj", "n").alias("text")))))
        report = ranked.groupBy("window_start").agg(F.sum("n").alias("total"), F.array_join(F.transform(best, lambda x: x["text"]), ", ").alias("top"))
        report.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{self.base}/reports/v={batch_id}")
        # a closed window keeps its total and its late events only
        kept = counts.groupBy("window_start", F.when(~F.col("closed"), F.col("obj")).alias("obj")).agg(
            F.sum("n").alias("n"), F.sum("late").alias("late"), F.first("closed").alias("reported"), F.first("latest").alias("latest"))
        kept.write.mode("overwrite").parquet(f"{self.base}/state/v={batch_id}")
        for name in ("rows", "now", "counts"):
            delete_path(self.spark, f"{self.base}/{name}-{batch_id}")
        if batch_id > 1:  # the state before the last one is needed no more
            delete_path(self.spark, f"{self.base}/state/v={batch_id - 2}")
