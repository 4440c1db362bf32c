"""Message topics on files, with the columns of a broker message.

A topic folder holds Parquet files with ``key, value, topic, partition,
offset, timestamp, headers``.  ``readStream`` on it behaves like a consumer
reading from the earliest offset; the checkpoint folder plays the role of the
committed offsets of a consumer group (a new checkpoint = a new group that
replays from the beginning).  A broker connector can replace the file format
without changing the jobs.

The file source takes files in modification-time order, so a producer that
needs a strict order (event-time watermarks) appends its chunks one after
another (:func:`append_in_order`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

MESSAGE_DDL = ("key string, value string, topic string, partition int, offset bigint, timestamp timestamp, "
               "headers array<struct<key:string,value:string>>")


def to_messages(df: DataFrame, topic: str, key: Column, value: Column, partition: Column, offset: Column,
                timestamp: Column, headers: Column | None = None) -> DataFrame:
    """Rows -> broker messages (value = JSON text)."""
    h = headers if headers is not None else F.array().cast("array<struct<key:string,value:string>>")
    return df.select(key.cast("string").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
                     partition.cast("int").alias("partition"), offset.cast("bigint").alias("offset"),
                     timestamp.cast("timestamp").alias("timestamp"), h.alias("headers"))


def write_topic(msgs: DataFrame, path: str) -> None:
    """Produce all messages at once (order between files is not guaranteed)."""
    msgs.write.mode("append").parquet(path)


def append_in_order(msgs: DataFrame, path: str, chunks: int, order: Column | str = "offset") -> int:
    """Produce the messages as ``chunks`` appends, one after another, in ``order``; returns a chunk's width.

    Each chunk is one distributed write of an equal-width range of the (integer)
    order, so every file of chunk ``i`` is older than every file of chunk
    ``i + 1``; inside a chunk the file order is free, so a consumer meets disorder
    of one chunk's width at most.  This stands in for a producer that appends
    over time (a broker source needs none of it).
    """
    at = F.col(order) if isinstance(order, str) else order
    spark, stored = msgs.sparkSession, scratch_path(msgs.sparkSession, "to-append")
    lo, hi = (int(x) if x is not None else 0 for x in msgs.select(at.alias("at")).agg(F.min("at"), F.max("at")).first())
    width = (hi - lo) // chunks + 1
    dealt = msgs.withColumn("_chunk", F.floor((at - lo) / width).cast("int"))
    dealt.filter("_chunk is not null").write.partitionBy("_chunk").parquet(stored)  # a chunk is then read alone
    back = spark.read.schema(dealt.schema).parquet(stored)
    for i in range(chunks):
        back.filter(F.col("_chunk") == i).drop("_chunk").write.mode("append").parquet(f"{path}/chunk={i:05d}")
    return width


def files_per_chunk(spark: SparkSession, path: str, chunks: int) -> int:
    """Files of a topic of ``chunks`` appends that a consumer takes at a time to have about one batch per chunk, whatever
    number of files the chunks have: every batch costs a pass over the state, so their number should not grow with the topic."""
    return max(1, -(-len(spark.read.schema(MESSAGE_DDL).option("recursiveFileLookup", True).parquet(path).inputFiles()) // chunks))


def stage_chunks(msgs: DataFrame, chunks: int, order: Column) -> tuple[str, int]:
    """The messages in ``chunks`` folders of equal widths of the (integer) order, written in one pass; the staging
    folder and the number of chunks that hold messages.  :func:`release` hands them to consumers one by one."""
    lo, hi = (int(x) if x is not None else 0 for x in msgs.select(order.alias("at")).agg(F.min("at"), F.max("at")).first())
    width = (hi - lo) // chunks + 1
    path = scratch_path(msgs.sparkSession, "staged")
    msgs.withColumn("chunk", F.floor((order - lo) / width).cast("int")).write.partitionBy("chunk").parquet(path)
    return path, chunks


def release(spark: SparkSession, staged: str, chunk: int, path: str) -> bool:
    """Append a staged chunk to the topic by renaming its folder; false if it is empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    source = folder(f"{staged}/chunk={chunk}")
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder(path))
    return fs.exists(source) and fs.rename(source, folder(f"{path}/chunk={chunk}"))


def read_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(MESSAGE_DDL).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_available(query_builder, checkpoint: str):
    """Start a streaming query with ``availableNow`` and block until every file is processed."""
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
