"""Structured Streaming jobs of the photo service.

Every job reads a topic folder (:mod:`quarry.streaming.topic`) and writes
through a checkpointed sink, so a restarted job continues from its committed
offsets (X23) and a new checkpoint replays the topic (S17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.core import stable_hash
from quarry.operators.keyed_table import KeyedTable
from quarry.sources.derived import events_x
from quarry.streaming.topic import to_messages

EVENT_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Event times in message values keep their microseconds.
JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def traceparent(offset: Column) -> Column:
    """W3C-style trace context of a message: ``00-<trace 32 hex>-<span 16 hex>-01``."""
    return F.concat(F.lit("00-"), F.md5(offset.cast("string")), F.lit("-"),
                    F.substring(F.sha2(offset.cast("string"), 256), 1, 16), F.lit("-01"))


def events_messages(events: DataFrame, topic: str = "events") -> DataFrame:
    """Events as messages: key = user, value = JSON row, partition = h(user) % 6, offset = event id."""
    ex = events_x(events)
    value = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value", "props"), JSON_TIMES)
    hdr = F.array(F.struct(F.lit("traceparent").alias("key"), traceparent(F.col("event_id")).alias("value")))
    return to_messages(ex, topic, F.col("user_id"), value, F.col("kpart"), F.col("event_id"), F.col("ts"), hdr)


def parse_events(msgs: DataFrame) -> DataFrame:
    """Message value -> typed event columns (+ partition, offset, broker time, headers)."""
    return msgs.select(F.from_json("value", EVENT_DDL, JSON_TIMES).alias("e"), "partition", "offset", "timestamp", "headers") \
        .select("e.*", "partition", "offset", "timestamp", "headers")


def header(headers: Column, name: str) -> Column:
    """Value of one header (last one wins)."""
    return F.element_at(F.filter(headers, lambda h: h["key"] == name).getField("value"), -1)


# ---------------------------------------------------------------- sinks
def publish(spark: SparkSession, base: str, version: int, path: str) -> None:
    """Make ``path`` the current version: a new pointer file per version, never a replaced one, so a reader
    finds the old or the new version at any time."""
    spark.range(1).select(F.lit(path).alias("current")).coalesce(1).write.mode("overwrite").json(f"{base}/pointer/v={version:012d}")


def current_version(spark: SparkSession, base: str) -> DataFrame:
    """The table that the pointer with the highest version names."""
    best = spark.read.schema("current string, v bigint").json(f"{base}/pointer").agg(F.max_by("current", "v").alias("current"))
    return spark.read.parquet(best.first()["current"])


def upsert_table(spark: SparkSession, base: str, key: str, latest_cols: list[str], key_type: str = "bigint", buckets: int = 256) -> KeyedTable:
    """An empty table for :func:`upsert`: per text column the offset it came from, and a ``writes`` counter."""
    columns = ", ".join(f"{c} string, {c}_offset bigint" for c in latest_cols)
    return KeyedTable(spark, base, [key], f"{key} {key_type}, {columns}, writes bigint", buckets).create()


def upsert(table: KeyedTable, latest_cols: list[str]):
    """``foreachBatch`` upsert with a ``writes`` counter into a table of buckets.

    Per column the non-null value of the highest offset stays, whatever order
    batches come in; only the buckets of a batch's keys are written.  Batch ``n``
    makes version ``n + 1``; a batch that is run again changes nothing, and one
    whose predecessor is missing is an error.
    """
    combine = {"writes": F.sum("writes")}
    for c in latest_cols:
        combine |= {c: F.max_by(c, f"{c}_offset"), f"{c}_offset": F.max(f"{c}_offset")}

    def fn(batch: DataFrame, batch_id: int) -> None:
        if batch_id > table.version():
            raise ValueError(f"batch {batch_id} comes after version {table.version()}")
        offsets = {f"{c}_offset": F.when(F.col(c).isNotNull(), F.col("offset")) for c in latest_cols}
        table.merge(batch.withColumns({**offsets, "writes": F.lit(1)}), combine, batch_id + 1)

    return fn


def idempotent_archiver(base: str, partition_col: str = "server"):
    """Append each micro-batch to the lake as ``batch=<id>`` with overwrite: a rewritten
    batch replaces itself, and the checkpoint commits only after the files exist."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").partitionBy(partition_col)
         .parquet(f"{base}/batch={batch_id:08d}"))

    return fn


def split_dead_letters(base: str):
    """Parse failures go to a dead-letter folder, good rows to the output; the stream goes on."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        ok = F.col("e").isNotNull() & F.col("e.event_id").isNotNull()
        batch.filter(ok).select("e.*").write.mode("overwrite").parquet(f"{base}/ok/batch={batch_id:08d}")
        (batch.filter(~ok).select("value", "offset", F.lit("unparsable payload").alias("error"))
         .write.mode("overwrite").parquet(f"{base}/dead/batch={batch_id:08d}"))

    return fn


def consume_time(offset: Column, produced: Column) -> Column:
    """When a message was consumed (producer time + a keyed delay of up to 5 s)."""
    ms = stable_hash(offset) % 5000
    return (F.unix_micros(produced.cast("timestamp")) + ms * 1000).alias("_consumed_us")
