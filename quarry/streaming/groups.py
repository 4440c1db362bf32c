"""Consumer groups of a topic on files, with stored commits and the lag of each partition.

An append writes files that each hold a contiguous range of offsets of one
partition, and a directory of them: partition, first and last offset, number of
messages.  A hot partition is many files.  A group reads the topic as a file
stream with a checkpoint of its own; when the results of a micro-batch are
stored, the files it held are written as the batch's commit.  A batch that is
run again commits the same files again.

A file stream may take files in any order, so the largest offset seen says
little.  The committed position of a partition is one after its last processed
message before the first unprocessed one (-1: none), as with a broker: whoever
starts there again misses nothing.  Positions come from the directory and the
commits, one row per file; no message is read for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.streaming.topic import read_topic, run_available

DIRECTORY = "partition int, file string, first bigint, last bigint, messages bigint"
DONE = "partition int, file string"


class GroupTopic:
    """A topic in the folder ``path``; offsets ascend within a partition from append to append."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, msgs: DataFrame, number: int, messages_per_file: int = 1_000_000) -> None:
        """Produce messages as append ``number``; an append that is run again replaces itself (before consumers see it)."""
        place = f"{self.path}/messages/append={number}"
        (msgs.withColumn("p", F.col("partition")).repartitionByRange("p", "offset").sortWithinPartitions("p", "offset")
         .write.mode("overwrite").option("maxRecordsPerFile", messages_per_file).partitionBy("p").parquet(place))
        stored = self.spark.read.option("recursiveFileLookup", True).schema("partition int, offset bigint").parquet(place)
        files = stored.groupBy("partition", F.col("_metadata.file_name").alias("file")).agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("messages"))
        files.write.mode("overwrite").parquet(f"{self.path}/directory/append={number}")

    def directory(self) -> DataFrame:
        return self.spark.read.schema(f"{DIRECTORY}, append bigint").parquet(f"{self.path}/directory").drop("append")

    def commit(self, group: str, batch: int, files: DataFrame) -> None:
        """Store the files of a micro-batch as processed by the group."""
        files.select("partition", "file").distinct().write.mode("overwrite").parquet(f"{self.path}/commits/{group}/batch={batch}")

    def committed(self, group: str) -> DataFrame:
        """The files that the group has processed; none for a group that has not."""
        place = f"{self.path}/commits/{group}"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], DONE)
        return self.spark.read.schema(f"{DONE}, batch bigint").parquet(place).select("partition", "file").distinct()

    def consume(self, group: str, process: Callable[[DataFrame, int], None], files_per_batch: int | None = None) -> None:
        """Hand all messages that the group has not processed to ``process(messages, batch)``, which stores its results;
        the group commits after it."""
        messages = read_topic(self.spark, f"{self.path}/messages", files_per_batch).select("*", F.col("_metadata.file_name").alias("file"))

        def run(batch: DataFrame, number: int) -> None:
            process(batch.drop("file"), number)
            self.commit(group, number, batch.select("partition", "file"))

        run_available(messages.writeStream.foreachBatch(run), f"{self.path}/groups/{group}")

    def positions(self, group: str) -> DataFrame:
        """Per partition: ``high_watermark`` (last offset + 1), ``committed`` (-1: none), ``lag`` (their difference in
        offsets, a negative position taken as 0) and ``waiting`` (messages in unprocessed files)."""
        done = self.committed(group).withColumn("done", F.lit(True))
        files = self.directory().join(done, ["partition", "file"], "left").withColumn("done", F.coalesce("done", F.lit(False)))
        ends = files.groupBy("partition").agg(
            (F.max("last") + 1).alias("high_watermark"), F.min(F.when(~F.col("done"), F.col("first"))).alias("open"),
            F.coalesce(F.sum(F.when(~F.col("done"), F.col("messages"))), F.lit(0)).alias("waiting"))
        before = (files.filter("done").join(ends.select("partition", "open"), "partition")
                  .filter(F.col("open").isNull() | (F.col("last") < F.col("open")))
                  .groupBy("partition").agg((F.max("last") + 1).alias("committed")))
        committed = F.coalesce(F.col("committed"), F.lit(-1).cast("bigint"))
        return ends.join(before, "partition", "left").select(
            "partition", "high_watermark", committed.alias("committed"),
            (F.col("high_watermark") - F.greatest(committed, F.lit(0))).alias("lag"), "waiting")
