"""A topic appended in order: its messages, and the number of batches that a consumer makes of it."""

import os

from pyspark.sql import functions as F

from quarry.streaming.topic import append_in_order, files_per_chunk, read_topic, run_available, to_messages


def messages(spark, n, partitions):
    rows = spark.range(n).repartition(partitions)
    at = F.when(F.col("id") % 50 != 7, F.timestamp_micros(F.col("id") * 1000))
    return to_messages(rows, "t", F.col("id"), F.col("id").cast("string"), F.lit(0), F.col("id"), at)


def test_batches_do_not_grow_with_the_files(spark, tmp_path):
    batches = []
    for partitions in (1, 12):
        topic, ck = f"{tmp_path}/topic{partitions}", f"{tmp_path}/ck{partitions}"
        width = append_in_order(messages(spark, 600, partitions), topic, 4, F.unix_micros("timestamp"))
        assert width == 599_000 // 4 + 1
        got = spark.read.option("recursiveFileLookup", True).parquet(topic)
        assert sorted(r.offset for r in got.collect()) == [i for i in range(600) if i % 50 != 7]
        for i in range(4):
            at = [r[0] for r in spark.read.parquet(f"{topic}/chunk={i:05d}").select(F.unix_micros("timestamp")).collect()]
            assert at and all(i * width <= t < (i + 1) * width for t in at)
        s = read_topic(spark, topic, files_per_chunk(spark, topic, 4))
        run_available(s.writeStream.foreachBatch(lambda b, k: b.count()), ck)
        batches.append(len([f for f in os.listdir(f"{ck}/commits") if f.isdigit()]))
    assert max(batches) <= 5


def test_an_empty_topic(spark, tmp_path):
    append_in_order(messages(spark, 0, 1), f"{tmp_path}/t", 3, F.unix_micros("timestamp"))
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/t").count() == 0
