"""SURVEY §2.13 event-sourcing queries (E1-E9) plus A22, W2, W6 and D4.

The log: signup -> addPhoto, click -> updatePhotoData, purchase ->
replacePhoto, error -> deletePhoto, view removed; entity = user_id, seq =
event_id (FIXTURES §3).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import replay as rp
from quarry.operators.documents import photo_documents
from quarry.operators.fold import ReplayFold, StoredFold, replay_fold
from quarry.operators.ordering import running_last
from quarry.plans.registry import register
from quarry.plans.sqlx import ESLOG, EX
from quarry.session import scratch_path
from quarry.sources.derived import es_log
from quarry.sources.tables import Tables

SNAPSHOT_SEQ = 5000
STATE_AT = "2024-01-15T00:00:00.000Z"
ONE_PHOTO = 7


def _log(spark, sf):
    return rp.decode(es_log(Tables(spark, sf).events))


def replay_sql(where: str = "TRUE", keep: str = "last_type <> 'deletePhoto'") -> str:
    return f"""
WITH {EX}, {ESLOG},
agg AS (
  SELECT photo_id, arg_max(type, seq) AS last_type,
    max(seq) FILTER (WHERE type IN ('addPhoto', 'deletePhoto')) AS b_seq,
    arg_max(type, seq) FILTER (WHERE type IN ('addPhoto', 'deletePhoto')) AS b_type,
    arg_max(es_user, seq) FILTER (WHERE type IN ('addPhoto', 'deletePhoto')) AS b_user,
    max(seq) FILTER (WHERE type IN ('addPhoto', 'replacePhoto')) AS pr_seq,
    arg_max(es_path, seq) FILTER (WHERE type IN ('addPhoto', 'replacePhoto')) AS pr_path,
    max(seq) FILTER (WHERE type = 'updatePhotoData') AS u_seq,
    arg_max(es_title, seq) FILTER (WHERE type = 'updatePhotoData') AS u_title,
    max(seq) FILTER (WHERE type = 'deletePhoto') AS d_seq
  FROM eslog WHERE {where} GROUP BY photo_id),
state AS (
  SELECT photo_id, CASE WHEN b_type = 'addPhoto' THEN b_user END AS "user",
    CASE WHEN pr_seq IS NOT NULL AND (d_seq IS NULL OR pr_seq > d_seq) THEN pr_path END AS path,
    CASE WHEN u_seq IS NOT NULL AND (b_seq IS NULL OR u_seq > b_seq) THEN u_title
         WHEN b_type = 'addPhoto' THEN '' END AS title
  FROM agg WHERE {keep})"""


@register("E1_event_table", f"""
WITH {EX}, {ESLOG} SELECT seq, time, type, photo_id FROM eslog""")
def e1(spark, sf):
    """Event table with sequence, ISO time text, type and JSON payload (payload checked in F15)."""
    return es_log(Tables(spark, sf).events).select("seq", "time", "type", "photo_id")


@register("E2_replay_current_state", replay_sql() + " SELECT * FROM state")
def e2(spark, sf):
    """Replay of the whole log to the current state (closed form, one shuffle by photo)."""
    return rp.current_state(_log(spark, sf))


@register("E3_state_after_each_event", f"""
WITH {EX}, {ESLOG},
r AS (
  SELECT seq, photo_id, type,
    last_value(CASE WHEN type IN ('addPhoto','deletePhoto') THEN seq END IGNORE NULLS) OVER w AS b_seq,
    last_value(CASE WHEN type IN ('addPhoto','deletePhoto') THEN type END IGNORE NULLS) OVER w AS b_type,
    last_value(CASE WHEN type IN ('addPhoto','deletePhoto') THEN es_user END IGNORE NULLS) OVER w AS b_user,
    last_value(CASE WHEN type IN ('addPhoto','replacePhoto') THEN seq END IGNORE NULLS) OVER w AS pr_seq,
    last_value(CASE WHEN type IN ('addPhoto','replacePhoto') THEN es_path END IGNORE NULLS) OVER w AS pr_path,
    last_value(CASE WHEN type = 'updatePhotoData' THEN seq END IGNORE NULLS) OVER w AS u_seq,
    last_value(CASE WHEN type = 'updatePhotoData' THEN es_title END IGNORE NULLS) OVER w AS u_title,
    last_value(CASE WHEN type = 'deletePhoto' THEN seq END IGNORE NULLS) OVER w AS d_seq
  FROM eslog WINDOW w AS (PARTITION BY photo_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT seq, photo_id, type, type <> 'deletePhoto' AS "exists",
  CASE WHEN type <> 'deletePhoto' AND b_type = 'addPhoto' THEN b_user END AS "user",
  CASE WHEN type <> 'deletePhoto' AND pr_seq IS NOT NULL AND (d_seq IS NULL OR pr_seq > d_seq) THEN pr_path END AS path,
  CASE WHEN type = 'deletePhoto' THEN NULL
       WHEN u_seq IS NOT NULL AND (b_seq IS NULL OR u_seq > b_seq) THEN u_title
       WHEN b_type = 'addPhoto' THEN '' END AS title
FROM r""")
def e3(spark, sf):
    """State of the touched photo after each event (history table, blockwise running values)."""
    return rp.history(_log(spark, sf))


@register("E4_state_at_time", replay_sql(f"time <= '{STATE_AT}'") + " SELECT * FROM state")
def e4(spark, sf):
    """State at a given time: replay of the events with ``time <= t`` (ISO text order)."""
    return rp.state_at(_log(spark, sf), STATE_AT)


@register("E5_edits_deleted_undone", f"""
WITH {EX}, {ESLOG}
SELECT 'edit' AS kind, photo_id, seq, operation FROM eslog WHERE type = 'replacePhoto'
UNION ALL SELECT 'deleted', photo_id, seq, NULL FROM eslog WHERE type = 'deletePhoto'
UNION ALL SELECT 'undone', photo_id, seq, operation FROM eslog WHERE type = 'replacePhoto' AND operation = '/undo'""")
def e5(spark, sf):
    """All edit operations, deleted ids and undone ids (duplicates kept)."""
    log = _log(spark, sf)
    edits = log.filter(F.col("type") == rp.REPLACE).select(F.lit("edit").alias("kind"), "photo_id", "seq",
                                                           "operation")
    deleted = log.filter(F.col("type") == rp.DELETE).select(F.lit("deleted").alias("kind"), "photo_id", "seq",
                                                            F.lit(None).cast("string").alias("operation"))
    undone = edits.filter(F.col("operation") == "/undo").withColumn("kind", F.lit("undone"))
    return edits.unionByName(deleted).unionByName(undone)


@register("E6_mutable_table_state", replay_sql(keep="last_type <> 'deletePhoto' AND b_type = 'addPhoto'")
          + " SELECT * FROM state")
def e6(spark, sf):
    """Mutable-table result: UPDATE of an absent row is a no-op, so partial rows do not exist."""
    return rp.mutable_table(_log(spark, sf))


@register("E6b_mutable_vs_replay", replay_sql() + """,
m AS (SELECT count(*) AS n FROM agg WHERE last_type <> 'deletePhoto' AND b_type = 'addPhoto')
SELECT (SELECT count(*) FROM state) AS replay_rows, (SELECT n FROM m) AS mutable_rows,
       (SELECT count(*) FROM state) - (SELECT n FROM m) AS partial_rows""")
def e6b(spark, sf):
    """Difference between the event replay and the mutable table (partial rows)."""
    r = rp.replay(_log(spark, sf))
    return r.agg(F.count(F.lit(1)).alias("replay_rows"), F.count_if(F.col("_b_type") == rp.ADD).alias("mutable_rows"),
                  F.count_if(F.col("_b_type").isNull() | (F.col("_b_type") != rp.ADD)).alias("partial_rows"))


@register("E7_snapshot_plus_later_events", replay_sql() + " SELECT * FROM state")
def e7(spark, sf):
    """Snapshot after a sequence number plus the later events equals the full replay."""
    return rp.replay_from_snapshot(_log(spark, sf), SNAPSHOT_SEQ)


@register("E8_log_size_vs_live_rows", replay_sql() + """
SELECT (SELECT count(*) FROM eslog) AS events, (SELECT count(*) FROM state) AS live_rows""")
def e8(spark, sf):
    """Size of the log against the number of rows that exist now."""
    log = _log(spark, sf)
    n = log.agg(F.count(F.lit(1)).alias("events"))
    live = rp.current_state(log).agg(F.count(F.lit(1)).alias("live_rows"))
    return n.crossJoin(live)


@register("E8b_history_of_one_photo", f"""
WITH {EX}, {ESLOG} SELECT seq, type, es_user AS "user", es_path AS path, es_title AS title FROM eslog
WHERE photo_id = {ONE_PHOTO}""")
def e8b(spark, sf):
    """Full history of one entity in sequence order."""
    log = _log(spark, sf)
    return log.filter(F.col("photo_id") == ONE_PHOTO).select("seq", "type", "user", "path", "title").orderBy("seq")


@register("E9_rename_propagation", """
SELECT 'normalised' AS model, count(*) AS rows_changed FROM customer WHERE c_custkey = 7
UNION ALL SELECT 'denormalised', count(*) FROM orders WHERE o_custkey = 7""")
def e9(spark, sf):
    """A rename changes 1 row in the normalised model and every embedded copy in the documents."""
    t = Tables(spark, sf)
    new_name = F.lit("Renamed Customer")
    cust = t.customer
    cust2 = cust.withColumn("c_name", F.when(F.col("c_custkey") == 7, new_name).otherwise(F.col("c_name")))
    docs = photo_documents(t.orders, t.customer, t.nation).select("photo_id", "user")
    docs2 = docs.withColumn("user", F.when(F.col("user.user_id") == 7,
                                           F.col("user").withField("account_name", new_name)).otherwise(F.col("user")))
    a = cust2.exceptAll(cust).agg(F.count(F.lit(1)).alias("rows_changed")).select(
        F.lit("normalised").alias("model"), "rows_changed")
    b = docs2.exceptAll(docs).agg(F.count(F.lit(1)).alias("rows_changed")).select(
        F.lit("denormalised").alias("model"), "rows_changed")
    return a.unionByName(b)


@register("A22_photos_per_user_now", replay_sql() + """
SELECT "user", count(*) AS photos FROM state GROUP BY 1""")
def a22(spark, sf):
    """Photos per user now (group the replayed state)."""
    return rp.current_state(_log(spark, sf)).groupBy("user").agg(F.count(F.lit(1)).alias("photos"))


@register("W2_history_running_state", f"""
WITH {EX}, {ESLOG},
r AS (SELECT seq, photo_id,
        last_value(CASE WHEN type IN ('addPhoto','replacePhoto') THEN es_path END IGNORE NULLS)
          OVER (PARTITION BY photo_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_path,
        count(*) OVER (PARTITION BY photo_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_events
      FROM eslog)
SELECT seq, photo_id, last_path, n_events FROM r""")
def w2(spark, sf):
    """Running ``last(path, ignoreNulls)`` and event count per photo in seq order (blockwise)."""
    from quarry.operators.ordering import prefix_running
    log = _log(spark, sf).withColumn("_p", F.when(F.col("type").isin(rp.ADD, rp.REPLACE), F.col("path")))
    r = running_last(log, ["photo_id"], ["seq"], ["_p"])
    r = prefix_running(r, ["photo_id"], ["seq"])
    return r.select("seq", "photo_id", F.col("_p_last").alias("last_path"), F.col("_rank").alias("n_events"))


@register("W6_gap_filter_to_undo", f"""
WITH {EX}, {ESLOG},
r AS (SELECT photo_id, seq, operation, epoch_us(ts) // 1000 AS ms,
        lag(epoch_us(ts) // 1000) OVER (PARTITION BY photo_id ORDER BY seq) AS prev_ms
      FROM eslog JOIN events ON seq = event_id WHERE type = 'replacePhoto')
SELECT photo_id, seq, ms - prev_ms AS gap_ms FROM r WHERE operation = '/undo' AND prev_ms IS NOT NULL""")
def w6(spark, sf):
    """Time from a filter to its undo on the same photo (previous replace of that photo)."""
    log = _log(spark, sf).filter(F.col("type") == rp.REPLACE)
    log = log.withColumn("ms", F.unix_millis(F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm:ss.SSSX")))
    r = running_last(log, ["photo_id"], ["seq"], ["ms"], exclusive=True, suffix="_prev")
    return (r.filter((F.col("operation") == "/undo") & F.col("ms_prev").isNotNull())
            .select("photo_id", "seq", (F.col("ms") - F.col("ms_prev")).alias("gap_ms")))


@register("D4_user_defined_fold", replay_sql() + " SELECT * FROM state")
def d4(spark, sf):
    """User-defined fold ``apply(state, event)`` (monoid form, mapInPandas + bounded merge)."""
    return replay_fold(_log(spark, sf))


@register("D4b_fold_kept_across_runs", replay_sql() + " SELECT * FROM state")
def d4b(spark, sf):
    """User-defined fold kept in a table: a first run over the older events, a second one that reads the newer events only."""
    log = _log(spark, sf).select("photo_id", "seq", "type", "user", "path", "title")
    kept = StoredFold(spark, scratch_path(spark, "d4b-state"), "photo_id", log.schema["photo_id"].dataType.simpleString(), "seq", ReplayFold(), buckets=16).create()
    kept.advance(log.filter(F.col("seq") <= SNAPSHOT_SEQ))
    kept.advance(log)
    return kept.state()
