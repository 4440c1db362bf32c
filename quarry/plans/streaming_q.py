"""SURVEY §2.10 streaming and messaging semantics.

Each query materialises a topic from the driver tables into a fresh folder
below ``spark.checkpoint.dir``, runs the Structured Streaming job with
``availableNow`` and a checkpoint there, and returns the sink read back as a
batch DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.core import stable_hash
from quarry.operators.late import late_flags
from quarry.operators.model import detect, draw, vocabulary
from quarry.operators.ordering import count_decreases, global_row_number
from quarry.plans.registry import register
from quarry.plans.search import D3_SQL, _draw_sql
from quarry.plans.sqlx import ARRIVAL, EX, h
from quarry.session import scratch_path
from quarry.sources.derived import arrival_key, events_x, redelivered
from quarry.sources.tables import Tables
from quarry.streaming import jobs
from quarry.streaming.closing import WindowReporter
from quarry.streaming.groups import GroupTopic
from quarry.streaming.topic import append_in_order, files_per_chunk, read_topic, release, run_available, stage_chunks, to_messages, write_topic


def _events_topic(spark, sf, name="events", events=None, ordered_chunks=None, order_col="offset"):
    ev = events if events is not None else Tables(spark, sf).events
    msgs = jobs.events_messages(ev)
    path = scratch_path(spark, f"topic-{name}")
    if ordered_chunks:
        append_in_order(msgs, path, ordered_chunks, order_col)
    else:
        write_topic(msgs, path)
    return path


def _sink(spark, stream_df, name, mode="append", fmt="parquet"):
    out, ck = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ck")
    w = stream_df.writeStream.outputMode(mode).format(fmt).option("path", out)
    run_available(w, ck)
    return spark.read.parquet(out)


@register("S13_message_stream_source_sink", f"""
WITH {EX} SELECT event_id AS "offset", kpart AS partition, CAST(user_id AS VARCHAR) AS key, ts AS produced, user_id, event_type, value, props,
       '00-' || md5(CAST(event_id AS VARCHAR)) AS trace FROM ex""")
def s13(spark, sf):
    """Message stream: JSON value, text key and headers, read from the earliest offset, stored with a checkpoint, read back whole."""
    topic = _events_topic(spark, sf)
    got = _sink(spark, read_topic(spark, topic, max_files_per_trigger=4), "s13")
    e = F.from_json("value", jobs.EVENT_DDL, jobs.JSON_TIMES)
    m = got.select("offset", "partition", "key", F.col("timestamp").cast("timestamp_ntz").alias("produced"), e.alias("e"),
                   F.substring(jobs.header(F.col("headers"), "traceparent"), 1, 35).alias("trace"))
    return m.select("offset", "partition", "key", "produced", "e.user_id", "e.event_type", "e.value", "e.props", "trace")


@register("S17_replay_for_new_consumer", """
SELECT 'group-1' AS consumer_group, count(*) AS messages FROM events
UNION ALL SELECT 'group-2 (new, from the beginning)', count(*) FROM events""")
def s17(spark, sf):
    """A new consumer group (new checkpoint) replays the stored topic from the beginning."""
    topic = _events_topic(spark, sf)
    a = _sink(spark, read_topic(spark, topic).select("offset"), "s17a")
    b = _sink(spark, read_topic(spark, topic).select("offset"), "s17b")
    return (a.agg(F.count(F.lit(1)).alias("messages")).select(F.lit("group-1").alias("consumer_group"), "messages")
            .unionByName(b.agg(F.count(F.lit(1)).alias("messages"))
                         .select(F.lit("group-2 (new, from the beginning)").alias("consumer_group"), "messages")))


def _parts_topic(spark, sf):
    p = Tables(spark, sf).part
    msgs = to_messages(p, "new_photos", F.col("p_partkey"),
                       F.to_json(F.struct("p_partkey", "p_name")), (stable_hash("p_partkey") % 6),
                       F.col("p_partkey"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    path = scratch_path(spark, "topic-photos")
    write_topic(msgs, path)
    return path, p


def _detector_stream(spark, sf):
    path, p = _parts_topic(spark, sf)
    vocab = vocabulary(p.select(F.explode(F.split("p_name", " ")).alias("word")))
    s = read_topic(spark, path).select(F.from_json("value", "p_partkey bigint, p_name string").alias("m"), "offset")
    s = s.select("m.p_partkey", F.split("m.p_name", " ").alias("truth"), "offset")
    return detect(s, "p_partkey", "truth", vocab, 0.9, 0.1)


@register("X1_stateless_model_stage", f"WITH {D3_SQL} SELECT p_partkey, found FROM det")
def x1(spark, sf):
    """Stateless stage: consume photos, enrich with the detector (stream-static join to the vocabulary), produce."""
    d = _detector_stream(spark, sf)
    return _sink(spark, d.select("p_partkey", "found"), "x1")


@register("X2_independent_consumer_groups", """
SELECT 'object-detection' AS consumer_group, count(*) AS messages FROM events
UNION ALL SELECT 'friend-detection', count(*) FROM events""")
def x2(spark, sf):
    """Two consumer groups (two checkpoints) on one topic: each gets every message."""
    topic = _events_topic(spark, sf)
    q1 = read_topic(spark, topic).select("offset").writeStream.format("parquet")
    q2 = read_topic(spark, topic).select("offset").writeStream.format("parquet")
    o1, o2 = scratch_path(spark, "x2a"), scratch_path(spark, "x2b")
    a = q1.option("path", o1).option("checkpointLocation", scratch_path(spark, "x2a-ck")).trigger(availableNow=True).start()
    b = q2.option("path", o2).option("checkpointLocation", scratch_path(spark, "x2b-ck")).trigger(availableNow=True).start()
    a.awaitTermination()
    b.awaitTermination()
    ra = spark.read.parquet(o1).agg(F.count(F.lit(1)).alias("messages")).select(
        F.lit("object-detection").alias("consumer_group"), "messages")
    rb = spark.read.parquet(o2).agg(F.count(F.lit(1)).alias("messages")).select(
        F.lit("friend-detection").alias("consumer_group"), "messages")
    return ra.unionByName(rb)


@register("X3_running_totals", f"""
WITH {D3_SQL} SELECT obj, count(*) AS n FROM (SELECT unnest(found) AS obj FROM det) GROUP BY obj""")
def x3(spark, sf):
    """Running totals over all events so far (complete mode; each batch rewrites the totals)."""
    d = _detector_stream(spark, sf)
    totals = d.select(F.explode("found").alias("obj")).groupBy("obj").agg(F.count(F.lit(1)).alias("n"))
    out, ck = scratch_path(spark, "x3-out"), scratch_path(spark, "x3-ck")

    def fn(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        jobs.publish(spark, out, batch_id, f"{out}/v={batch_id}")

    run_available(totals.writeStream.outputMode("complete").foreachBatch(fn), ck)
    return jobs.current_version(spark, out)


@register("X4_native_watermark_windows", """
WITH c AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type AS obj, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, obj) AS rn FROM c)
SELECT window_start, CAST(sum(n) AS BIGINT) AS total, string_agg(obj || ' ' || n, ', ' ORDER BY rn) FILTER (WHERE rn <= 3) AS top
FROM r GROUP BY 1 HAVING window_start + INTERVAL 8 HOUR < (SELECT max(ts) FROM events)""")
def x4(spark, sf):
    """Tumbling 6 h event-time windows, reported once the latest time is over 2 h past their end: total and top 3.

    The producer appends in time order, one chunk a trigger; the watermark is the
    disorder it really has (a chunk's width) and 2 h, so no event is dropped in any
    number of micro-batches and the state stays bounded.  Each batch writes the
    counts it changed under its own number; the highest number holds.
    """
    path = scratch_path(spark, "topic-x4")
    width = append_in_order(jobs.events_messages(Tables(spark, sf).events), path, 6, F.unix_micros("timestamp"))
    s = jobs.parse_events(read_topic(spark, path, files_per_chunk(spark, path, 6))).withColumn("t", F.col("ts").cast("timestamp"))
    delay = f"{width // 1_000_000 + 1 + 2 * 3600} seconds"
    counts = s.withWatermark("t", delay).groupBy(F.window("t", "6 hours").alias("w"), F.col("event_type").alias("obj")).agg(
        F.count(F.lit(1)).alias("n"), F.max("t").alias("latest"))
    out = scratch_path(spark, "x4-out")

    def fn(batch, batch_id):
        batch.withColumn("b", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id:08d}")

    run_available(counts.writeStream.outputMode("update").foreachBatch(fn), scratch_path(spark, "x4-ck"))
    got = spark.read.parquet(out)
    final = got.groupBy("w", "obj").agg(F.max_by("n", "b").alias("n"))
    ranked = final.withColumn("rn", F.row_number().over(Window.partitionBy("w").orderBy(F.desc("n"), "obj")))
    top = F.array_sort(F.collect_list(F.when(F.col("rn") <= 3, F.struct("rn", F.concat_ws(" ", "obj", "n").alias("text")))))
    windows = ranked.groupBy("w").agg(F.sum("n").alias("total"), F.array_join(F.transform(top, lambda x: x["text"]), ", ").alias("top"))
    latest = got.agg(F.max("latest").alias("latest"))
    return (windows.crossJoin(F.broadcast(latest)).filter(F.col("w.end") + F.expr("interval 2 hours") < F.col("latest"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "total", "top"))


@register("X5_late_events_of_a_topic", f"""
WITH a AS (SELECT event_id, epoch_us(ts) AS t, (epoch_us(ts) // 21600000000) * 21600000000 AS w, {ARRIVAL} AS arrival FROM events),
r AS (SELECT *, max(t) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max,
             row_number() OVER (PARTITION BY w ORDER BY arrival, event_id) AS rn FROM a)
SELECT count(*) AS messages, count(*) FILTER (WHERE rn > 1 AND w + 28800000000 < prev_max) AS late FROM r""")
def x5(spark, sf):
    """Late events of an unordered topic: the stream archives messages with their arrival (one file a trigger),
    and an event is late if its window had been reported by then, whatever the micro-batches were."""
    msgs = jobs.events_messages(Tables(spark, sf).events)
    path = scratch_path(spark, "topic-x5")
    write_topic(msgs.repartition(4, "offset"), path)
    s = jobs.parse_events(read_topic(spark, path, max_files_per_trigger=1)).select("event_id", "ts", arrival_key().alias("arrival"))
    archive = _sink(spark, s, "x5")
    return late_flags(archive, "ts", ["arrival", "event_id"]).agg(F.count(F.lit(1)).alias("messages"), F.count_if("late").alias("late"))


def reported_windows(spark, sf, name, chunks=6):
    """The event topic in order of arrival (up to 8 h late), consumed a chunk at a time by the window reporter."""
    msgs = jobs.events_messages(Tables(spark, sf).events)
    staged, n = stage_chunks(msgs, chunks, arrival_key("offset", "timestamp"))
    topic, ck = scratch_path(spark, f"topic-{name}"), scratch_path(spark, f"{name}-ck")
    reporter = WindowReporter(spark, scratch_path(spark, f"{name}-out"))
    batches = 0
    for chunk in range(n):
        if release(spark, staged, chunk, topic):
            s = jobs.parse_events(read_topic(spark, topic)).select("ts", F.col("event_type").alias("obj"), arrival_key().alias("arrival"), "event_id")
            run_available(s.writeStream.foreachBatch(reporter), ck)
            batches += 1
    return reporter, batches


LATE_SQL = f"""a AS (SELECT event_id, event_type AS obj, epoch_us(ts) AS t, (epoch_us(ts) // 21600000000) * 21600000000 AS w, {ARRIVAL} AS arrival FROM events),
r AS (SELECT *, max(t) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max,
             row_number() OVER (PARTITION BY w ORDER BY arrival, event_id) AS rn FROM a),
f AS (SELECT *, rn > 1 AND w + 28800000000 < prev_max AS late FROM r)"""


@register("X4b_window_reports_at_closing", f"""
WITH {LATE_SQL},
c AS (SELECT w, obj, count(*) AS n FROM f WHERE NOT late GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, obj) AS place FROM c)
SELECT make_timestamp(w) AS window_start, CAST(sum(n) AS BIGINT) AS total, string_agg(obj || ' ' || n, ', ' ORDER BY place) FILTER (WHERE place <= 3) AS top
FROM k GROUP BY w HAVING w + 28800000000 < (SELECT max(t) FROM a)""")
def x4b(spark, sf):
    """Each 6 h window of an unordered topic is reported once, when an event over 2 h past its end arrives: total and top 3."""
    return reported_windows(spark, sf, "x4b")[0].reports().select("window_start", "total", "top")


@register("X5b_late_events_in_the_stream", f"""
WITH {LATE_SQL}
SELECT make_timestamp(w) AS window_start, count(*) FILTER (WHERE NOT late) AS counted, count(*) FILTER (WHERE late) AS late FROM f GROUP BY w""")
def x5b(spark, sf):
    """Counted and late events per window, kept by the stream itself; equal to W3 whatever the micro-batches are."""
    reporter, batches = reported_windows(spark, sf, "x5b")
    return reporter.state(batches - 1).groupBy("window_start").agg(F.sum("n").alias("counted"), F.sum("late").alias("late"))


CRASH_MOD = 1000


@register("X12_delivery_outcome_per_mode", f"""
WITH o AS (SELECT o_orderkey, o_orderkey % {CRASH_MOD} = 4 AS crash FROM orders)
SELECT 'at-most-once' AS mode, count(*) AS orders, count(*) FILTER (WHERE NOT crash) AS charges,
       count(*) FILTER (WHERE crash) AS lost, CAST(0 AS BIGINT) AS charged_twice FROM o
UNION ALL SELECT 'at-least-once', count(*), count(*) + count(*) FILTER (WHERE crash), 0, count(*) FILTER (WHERE crash) FROM o
UNION ALL SELECT 'idempotent', count(*), count(*), 0, 0 FROM o""")
def x12(spark, sf):
    """Delivery outcome per mode from an attempt log: the consumer crashes once on some orders.

    at-most-once commits before the work (the crashed order is lost);
    at-least-once commits after it (charged again after the restart);
    idempotent drops repeated order keys before charging.
    """
    o = Tables(spark, sf).orders.select("o_orderkey", (F.col("o_orderkey") % CRASH_MOD == 4).alias("crash"))
    attempts = o.select("o_orderkey", "crash", F.explode(F.when(F.col("crash"), F.array(F.lit(1), F.lit(2)))
                                                          .otherwise(F.array(F.lit(1)))).alias("attempt"))
    # attempt 1 of a crash order: at-most-once committed and crashed before charging;
    # at-least-once charged and crashed before committing, so attempt 2 charges again.
    amo = attempts.filter(~F.col("crash") & (F.col("attempt") == 1)).select("o_orderkey")
    alo = attempts.select("o_orderkey")
    idem = alo.dropDuplicates(["o_orderkey"])
    n = o.agg(F.count(F.lit(1)).alias("orders"))

    def outcome(mode, charges):
        per = charges.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("c"))
        s = per.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("charges"),
                    F.count_if(F.col("c") > 1).alias("charged_twice"), F.count(F.lit(1)).alias("charged_orders"))
        return n.crossJoin(s).select(F.lit(mode).alias("mode"), "orders", "charges",
                                     (F.col("orders") - F.col("charged_orders")).alias("lost"), "charged_twice")

    return outcome("at-most-once", amo).unionByName(outcome("at-least-once", alo)).unionByName(
        outcome("idempotent", idem))


@register("X13_idempotent_consumer", """
SELECT event_type, count(*) AS messages FROM events GROUP BY event_type""")
def x13(spark, sf):
    """Idempotent consumer on a redelivering stream: ``dropDuplicatesWithinWatermark`` on the offset.

    The topic is appended in time order; a redelivered message has the time of
    the first one, so state is needed for the producer's disorder only."""
    path = scratch_path(spark, "topic-x13")
    width = append_in_order(jobs.events_messages(redelivered(Tables(spark, sf).events)), path, 6, F.unix_micros("timestamp"))
    s = jobs.parse_events(read_topic(spark, path, files_per_chunk(spark, path, 6))).withColumn("t", F.col("timestamp").cast("timestamp"))
    d = s.withWatermark("t", f"{width // 1_000_000 + 1} seconds").dropDuplicatesWithinWatermark(["offset"])
    got = _sink(spark, d.select("event_type", "offset"), "x13")
    return got.groupBy("event_type").agg(F.count(F.lit(1)).alias("messages"))


def results_messages(spark, sf):
    """Detector results of both models as messages (objects and friends), with redeliveries."""
    t = Tables(spark, sf)
    p = t.part.select("p_partkey", F.split("p_name", " ").alias("truth"))
    vocab = vocabulary(p.select(F.explode("truth").alias("word")))
    obj = detect(p, "p_partkey", "truth", vocab, 0.9, 0.1).select(
        "p_partkey", F.array_join("found", ";").alias("objects"), F.lit(None).cast("string").alias("friends"))
    fr = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("l_suppkey")), lambda x: x.cast("string")), ";")
        .alias("friends")).select("p_partkey", F.lit(None).cast("string").alias("objects"), "friends")
    res = obj.withColumn("kind", F.lit(0)).unionByName(fr.withColumn("kind", F.lit(1)))
    again = res.filter(F.col("p_partkey") % 10 == 3).withColumn("kind", F.col("kind") + 2)  # redelivered after a restart
    res = res.unionByName(again)
    return to_messages(res, "results", F.col("p_partkey"), F.to_json(F.struct("p_partkey", "objects", "friends")),
                       stable_hash("p_partkey") % 6, F.col("p_partkey") * 4 + F.col("kind"),
                       F.lit("2024-01-01 00:00:00").cast("timestamp"))


def _results_topic(spark, sf):
    path = scratch_path(spark, "topic-results")
    write_topic(results_messages(spark, sf), path)
    return path


UPSERT_SQL = f"""WITH {D3_SQL},
r AS (SELECT p_partkey, array_to_string(found, ';') AS objects, NULL AS friends FROM det
      UNION ALL SELECT l_partkey, NULL, array_to_string(list_transform(list_sort(list(DISTINCT l_suppkey)), lambda x: CAST(x AS VARCHAR)), ';')
      FROM lineitem GROUP BY l_partkey),
rr AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE p_partkey % 10 = 3)
SELECT p_partkey, max(objects) AS objects, max(friends) AS friends, count(*) AS writes FROM rr GROUP BY p_partkey"""


@register("X14_upsert_sink_with_writes", UPSERT_SQL)
def x14(spark, sf):
    """Upsert sink: one row per photo merging both result kinds, with a ``writes`` counter; a repeated
    result leaves the values unchanged (foreachBatch merge into the buckets of the batch's keys)."""
    topic = _results_topic(spark, sf)
    s = read_topic(spark, topic, max_files_per_trigger=3).select(
        F.from_json("value", "p_partkey bigint, objects string, friends string").alias("m"), "offset").select(
        "m.*", "offset")
    columns = ["objects", "friends"]
    table = jobs.upsert_table(spark, scratch_path(spark, "x14-table"), "p_partkey", columns, buckets=16)
    run_available(s.writeStream.foreachBatch(jobs.upsert(table, columns)), scratch_path(spark, "x14-ck"))
    table.remove_old(keep=1)
    return table.rows().select("p_partkey", *columns, "writes")


@register("X15_ordering_with_and_without_key", """
WITH m AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM conversations),
a AS (SELECT conv_id, turn, (idx // 3) * (CASE idx % 3 WHEN 0 THEN 10 WHEN 1 THEN 13 ELSE 17 END) AS arrival FROM m),
d AS (SELECT conv_id, turn < lag(turn) OVER (PARTITION BY conv_id ORDER BY arrival, turn) AS dec FROM a)
SELECT 'with key' AS mode, CAST(0 AS BIGINT) AS conversations_out_of_order
UNION ALL SELECT 'without key', count(DISTINCT conv_id) FROM d WHERE dec""")
def x15(spark, sf):
    """Per-key order: with the conversation as key (one partition per key, sorted) turns apply in order;
    round-robin partitions consumed at different speeds reorder them (measured like W1)."""
    c = Tables(spark, sf).conversations.select("conv_id", "turn")
    keyed = (c.repartition(6, "conv_id").sortWithinPartitions("conv_id", "turn")
             .withColumn("arrival", F.monotonically_increasing_id()))
    k = count_decreases(keyed, ["arrival"], "turn", ["conv_id"]).agg(
        F.count_if(F.col("decreases") > 0).alias("conversations_out_of_order"))
    m = global_row_number(c, ["conv_id", "turn"], name="idx").withColumn("idx", F.col("idx") - 1)
    speed = F.when(F.col("idx") % 3 == 0, 10).when(F.col("idx") % 3 == 1, 13).otherwise(17)
    a = m.withColumn("arrival", F.floor(F.col("idx") / 3) * speed)
    u = count_decreases(a, ["arrival", "turn"], "turn", ["conv_id"]).agg(
        F.count_if(F.col("decreases") > 0).alias("conversations_out_of_order"))
    return k.select(F.lit("with key").alias("mode"), "conversations_out_of_order").unionByName(
        u.select(F.lit("without key").alias("mode"), "conversations_out_of_order"))


WORKERS = [1, 2, 3, 6, 8]


@register("X18_worker_load", f"""
WITH {EX}, p AS (SELECT kpart, count(*) AS n FROM ex GROUP BY kpart),
w AS (SELECT * FROM (VALUES {', '.join(f'({n})' for n in WORKERS)}) v(workers)),
a AS (SELECT workers, kpart, n, ntile(least(workers, 6)) OVER (PARTITION BY workers ORDER BY kpart) AS worker FROM w, p),
l AS (SELECT workers, worker, CAST(sum(n) AS BIGINT) AS load FROM a GROUP BY 1, 2)
SELECT workers, max(load) AS busiest, CAST(greatest(workers - 6, 0) AS INTEGER) AS idle FROM l GROUP BY workers""")
def x18(spark, sf):
    """Load of N workers: contiguous partition ranges per worker, extra workers idle; busiest worker."""
    ex = events_x(Tables(spark, sf).events)
    p = ex.groupBy(F.col("kpart").alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return worker_load(p, spark.createDataFrame([(n,) for n in WORKERS], "workers int"))


def worker_load(partition_counts, workers):
    """Range assignment of P partitions (``partition, n``) to each worker count in ``workers``:
    contiguous ranges, the first ``P % k`` workers take one partition more, workers beyond P idle.

    The partition table has one row per topic partition (small), so the window runs over it.
    """
    n_parts = partition_counts.agg(F.count(F.lit(1)).alias("_p"))
    a = workers.crossJoin(partition_counts).crossJoin(F.broadcast(n_parts))
    k = F.least(F.col("workers"), F.col("_p"))
    base, extra = F.floor(F.col("_p") / k), F.col("_p") % k
    rank = F.row_number().over(Window.partitionBy("workers").orderBy("partition")) - 1
    a = a.withColumn("_r", rank).withColumn(
        "worker", F.when(F.col("_r") < extra * (base + 1), F.floor(F.col("_r") / (base + 1)))
        .otherwise(extra + F.floor((F.col("_r") - extra * (base + 1)) / base)))
    load = a.groupBy("workers", "worker", "_p").agg(F.sum("n").alias("load"))
    return load.groupBy("workers", "_p").agg(F.max("load").alias("busiest")).select(
        "workers", "busiest", F.greatest(F.col("workers") - F.col("_p"), F.lit(0)).cast("int").alias("idle"))


def _orders_people(t):
    """Photos (orders) with their true people: the suppliers of their lines (ids + 1,000,000)."""
    people = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_set(F.col("l_suppkey") + 1_000_000)).alias("people"))
    return t.orders.select("o_orderkey", "o_custkey").join(people, "o_orderkey")


NOTIFY_SQL = f"""
ppl AS (SELECT l_orderkey AS o_orderkey, list_sort(list(DISTINCT l_suppkey + 1000000)) AS people FROM lineitem GROUP BY 1),
ph AS (SELECT o.o_orderkey, o.o_custkey, people FROM orders o JOIN ppl USING (o_orderkey)),
ns AS (SELECT max(s_suppkey) + 1 AS n FROM supplier),
det AS (SELECT o_orderkey, o_custkey,
          list_filter(people, lambda f: {_draw_sql('o_orderkey', 'CAST(f AS VARCHAR)')} < 0.85) AS kept,
          CASE WHEN {_draw_sql('o_orderkey', "'+'")} < 0.03 THEN 1000000 + {h("CAST(o_orderkey AS VARCHAR) || '|pick'")} % (SELECT n FROM ns) END AS extra
        FROM ph),
fr AS (SELECT o_orderkey, o_custkey, unnest(kept) AS friend FROM det
       UNION ALL SELECT o_orderkey, o_custkey, extra FROM det WHERE extra IS NOT NULL)"""


@register("X19_notifications", f"""
WITH {NOTIFY_SQL}
SELECT o_orderkey AS photo_id, s_name AS friend_name, c_name AS owner_name
FROM fr JOIN supplier ON friend - 1000000 = s_suppkey JOIN customer ON o_custkey = c_custkey""")
def x19(spark, sf):
    """Notifications: one row per detected friend on a photo, with friend and owner names (stream-static joins)."""
    t = Tables(spark, sf)
    ph = _orders_people(t)
    msgs = to_messages(ph, "new_photos", F.col("o_custkey"), F.to_json(F.struct("o_orderkey", "o_custkey", "people")),
                       stable_hash("o_custkey") % 6, F.col("o_orderkey"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    path = scratch_path(spark, "topic-x19")
    write_topic(msgs, path)
    s = read_topic(spark, path, max_files_per_trigger=4).select(
        F.from_json("value", "o_orderkey bigint, o_custkey bigint, people array<bigint>").alias("m")).select("m.*")
    key = F.col("o_orderkey")
    n_sup = t.supplier.agg((F.max("s_suppkey") + 1).alias("_ns"))
    s = s.crossJoin(F.broadcast(n_sup))
    kept = F.filter("people", lambda f: draw(key, f.cast("string")) < F.lit(0.85))
    extra = F.when(draw(key, "+") < F.lit(0.03),
                   F.lit(1_000_000) + stable_hash(F.concat(key.cast("string"), F.lit("|pick"))) % F.col("_ns"))
    found = F.when(extra.isNotNull(), F.concat(kept, F.array(extra))).otherwise(kept)
    fr = s.select("o_orderkey", "o_custkey", F.explode(found).alias("friend"))
    named = (fr.join(t.supplier.select("s_suppkey", "s_name"), F.col("friend") - 1_000_000 == F.col("s_suppkey"))
             .join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
             .select(F.col("o_orderkey").alias("photo_id"), F.col("s_name").alias("friend_name"),
                     F.col("c_name").alias("owner_name")))
    return _sink(spark, named, "x19")


@register("X20_failed_messages_dead_letter", """
SELECT 'ok' AS outcome, count(*) FILTER (WHERE event_type <> 'error') AS messages FROM events
UNION ALL SELECT 'dead-letter', count(*) FILTER (WHERE event_type = 'error') FROM events""")
def x20(spark, sf):
    """Failed messages are counted and skipped: unparsable payloads go to a dead-letter folder."""
    ev = Tables(spark, sf).events
    msgs = jobs.events_messages(ev).withColumn(
        "value", F.when(F.get_json_object("value", "$.event_type") == "error",
                        F.concat(F.lit("{broken "), F.col("value"))).otherwise(F.col("value")))
    path = scratch_path(spark, "topic-x20")
    write_topic(msgs, path)
    s = read_topic(spark, path, max_files_per_trigger=4).select(
        F.from_json("value", jobs.EVENT_DDL, jobs.JSON_TIMES).alias("e"), "value", "offset")
    base = scratch_path(spark, "x20")
    run_available(s.writeStream.foreachBatch(jobs.split_dead_letters(base)), scratch_path(spark, "x20-ck"))
    ok = spark.read.parquet(f"{base}/ok").agg(F.count(F.lit(1)).alias("messages")).select(
        F.lit("ok").alias("outcome"), "messages")
    dead = spark.read.parquet(f"{base}/dead").agg(F.count(F.lit(1)).alias("messages")).select(
        F.lit("dead-letter").alias("outcome"), "messages")
    return ok.unionByName(dead)


@register("X21_queue_wait", f"""
WITH {EX} SELECT kpart AS partition, count(*) AS messages,
  round(avg({h('event_id')} % 5000)) AS mean_wait_ms, max({h('event_id')} % 5000) AS max_wait_ms FROM ex GROUP BY kpart""")
def x21(spark, sf):
    """Queue wait = consume time - produce time, per partition (mean and max, ms)."""
    topic = _events_topic(spark, sf)
    s = read_topic(spark, topic, max_files_per_trigger=4)
    s = s.select("partition", (jobs.consume_time(F.col("offset"), F.col("timestamp")) -
                               F.unix_micros("timestamp")).alias("wait_us"))
    got = _sink(spark, s, "x21")
    return got.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"),
                                        F.round(F.avg(F.col("wait_us") / 1000), 0).alias("mean_wait_ms"),
                                        F.max(F.col("wait_us") / 1000).cast("bigint").alias("max_wait_ms"))


@register("X22_trace_context_propagation", """
SELECT event_id AS "offset", md5(CAST(event_id AS VARCHAR)) AS trace_id,
  substr(sha256(CAST(event_id AS VARCHAR)), 1, 16) AS upload_span,
  substr(sha256(CAST(event_id AS VARCHAR)), 1, 16) AS detector_parent,
  substr(md5(CAST(event_id AS VARCHAR) || '/detector'), 1, 16) AS writer_parent FROM events""")
def x22(spark, sf):
    """Trace context carried along each hop: each stage reads the parent from the header and
    forwards its own span id (columns kept through every stage)."""
    topic = _events_topic(spark, sf)
    s = read_topic(spark, topic, max_files_per_trigger=4)
    tp = jobs.header(F.col("headers"), "traceparent")
    det = s.select("offset", F.split(tp, "-").getItem(1).alias("trace_id"),
                   F.split(tp, "-").getItem(2).alias("detector_parent"))
    det = det.withColumn("detector_span", F.substring(F.md5(F.concat(F.col("offset").cast("string"),
                                                                      F.lit("/detector"))), 1, 16))
    fwd = det.withColumn("traceparent", F.concat(F.lit("00-"), "trace_id", F.lit("-"), "detector_span", F.lit("-01")))
    wr = fwd.select("offset", "trace_id", F.col("detector_parent").alias("upload_span"), "detector_parent",
                    F.split("traceparent", "-").getItem(2).alias("writer_parent"))
    return _sink(spark, wr, "x22")


@register("X23_commit_after_store_restart", """
SELECT count(*) AS stored, count(DISTINCT event_id) AS distinct_offsets FROM events""")
def x23(spark, sf):
    """Offsets are committed only after the results are stored: a restart from the checkpoint
    continues with the new files only; nothing is lost or stored twice."""
    ev = Tables(spark, sf).events
    msgs = jobs.events_messages(ev)
    path = scratch_path(spark, "topic-x23")
    mid = ev.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2).alias("m"))
    first = msgs.join(F.broadcast(mid), F.col("offset") <= F.col("m")).drop("m")
    second = msgs.join(F.broadcast(mid), F.col("offset") > F.col("m")).drop("m")
    out, ck = scratch_path(spark, "x23-out"), scratch_path(spark, "x23-ck")
    write_topic(first, f"{path}/run=1")
    run_available(read_topic(spark, path).select("offset").writeStream.format("parquet").option("path", out), ck)
    write_topic(second, f"{path}/run=2")
    run_available(read_topic(spark, path).select("offset").writeStream.format("parquet").option("path", out), ck)
    got = spark.read.parquet(out)
    return got.agg(F.count(F.lit(1)).alias("stored"), F.countDistinct("offset").alias("distinct_offsets"))


@register("S8_idempotent_lake_append", f"""
WITH {EX} SELECT event_id, ts, user_id, event_type, value, props, server FROM ex""")
def s8(spark, sf):
    """Archive the stream to the lake in per-batch folders; a rewritten batch replaces itself."""
    topic = _events_topic(spark, sf)
    s = jobs.parse_events(read_topic(spark, topic, max_files_per_trigger=4)).withColumn(
        "server", (F.col("event_id") % 4).cast("int"))
    lake = scratch_path(spark, "s8-lake")
    archive = jobs.idempotent_archiver(lake)
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props", "server"]
    run_available(s.select(columns).writeStream.foreachBatch(archive),
                  scratch_path(spark, "s8-ck"))
    # a retried batch 0 (same input) overwrites its own folder: the lake does not change
    retry = scratch_path(spark, "s8-retry")
    spark.read.parquet(f"{lake}/batch=00000000").write.parquet(retry)
    archive(spark.read.parquet(retry).select(columns), 0)
    return spark.read.parquet(lake).withColumn("server", F.col("server").cast("int")).select(columns)


@register("J12_merge_result_topics_upsert", UPSERT_SQL)
def j12(spark, sf):
    """Batch upsert of two result topics: one row per key, latest non-null value per column by offset,
    and the number of messages as ``writes`` (``INSERT ... ON CONFLICT DO UPDATE`` as an aggregate)."""
    m = results_messages(spark, sf).select(
        F.from_json("value", "p_partkey bigint, objects string, friends string").alias("m"), "offset").select(
        "m.*", "offset")
    return m.groupBy("p_partkey").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("offset"))).alias(c) for c in ("objects", "friends")],
        F.count(F.lit(1)).alias("writes"))


@register("X16b_lag_from_stored_commits", f"""
WITH {EX}, c AS (SELECT (max(event_id) + 1) * 3 // 4 AS cut FROM ex),
p AS (SELECT kpart, max(event_id) + 1 AS high, coalesce(max(event_id) FILTER (WHERE event_id < cut) + 1, -1) AS older,
        count(*) FILTER (WHERE event_id >= cut) AS newer, count(*) AS n FROM ex, c GROUP BY kpart),
g AS (SELECT 'behind' AS consumer_group, kpart, high, older AS committed, newer AS waiting FROM p
      UNION ALL SELECT 'new', kpart, high, -1, n FROM p UNION ALL SELECT 'up to date', kpart, high, high, 0 FROM p)
SELECT consumer_group, kpart, high AS high_watermark, committed, high - greatest(committed, 0) AS lag, waiting FROM g""")
def x16b(spark, sf):
    """Lag per partition from the commits of three groups: one stopped before the last append, one read all, one is new."""
    msgs = jobs.events_messages(Tables(spark, sf).events)
    cut = ((msgs.agg(F.max("offset")).first()[0] or 0) + 1) * 3 // 4
    topic = GroupTopic(spark, scratch_path(spark, "topic-x16b"))
    stored = scratch_path(spark, "x16b")

    def archive(group):
        return lambda batch, number: batch.write.mode("overwrite").parquet(f"{stored}/{group}/batch={number}")

    topic.append(msgs.filter(F.col("offset") < cut), 0)
    topic.consume("behind", archive("behind"), files_per_batch=8)
    topic.append(msgs.filter(F.col("offset") >= cut), 1)
    topic.consume("up-to-date", archive("up-to-date"), files_per_batch=8)
    groups = {"behind": "behind", "up-to-date": "up to date", "new": "new"}
    return reduce(DataFrame.unionByName, [
        topic.positions(g).select(F.lit(name).alias("consumer_group"), F.col("partition").alias("kpart"), "high_watermark",
                                  "committed", "lag", "waiting") for g, name in groups.items()])
