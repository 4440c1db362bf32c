"""Event-sourcing replay (E2-E7) in closed form.

Events apply in ``seq`` order per photo: ``addPhoto`` replaces the row with
``{user, path, title: ''}``, ``updatePhotoData`` sets the title and
``replacePhoto`` the path (both create a partial row if the photo is absent),
``deletePhoto`` removes it, other types leave an (unchanged or empty) row.

Let ``b`` be the last add/delete of a photo.  The row exists iff the last
event is not a delete; ``user`` is the add's user when ``b`` is an add; ``path``
is the latest add/replace path if it comes after the last delete; ``title``
is the latest title after ``b``, else ``''`` when ``b`` is an add, else null.
Each of these is a ``max_by`` over one group, i.e. one partially aggregated
shuffle by photo id - a photo with a third of all events costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import running_last

ADD, UPDATE, REPLACE, DELETE = "addPhoto", "updatePhotoData", "replacePhoto", "deletePhoto"
STATE_COLS = ["photo_id", "user", "path", "title"]


def decode(es: DataFrame) -> DataFrame:
    """Typed payload columns of the event log (F15 decode)."""
    d = F.from_json("data", "user int, path string, title string, operation string")
    return es.select("seq", "time", "type", "photo_id", d.alias("d")).select(
        "seq", "time", "type", "photo_id", F.col("d.user").alias("user"), F.col("d.path").alias("path"),
        F.col("d.title").alias("title"), F.col("d.operation").alias("operation"))


def _state_from(b_seq, b_type, b_user, pr_seq, pr_path, u_seq, u_title, d_seq):
    user = F.when(b_type == ADD, b_user)
    path = F.when(pr_seq.isNotNull() & (d_seq.isNull() | (pr_seq > d_seq)), pr_path)
    title = (F.when(u_seq.isNotNull() & (b_seq.isNull() | (u_seq > b_seq)), u_title)
             .when(b_type == ADD, F.lit("")))
    return user, path, title


def replay(events: DataFrame) -> DataFrame:
    """Current state ``(photo_id, user, path, title)`` of a decoded event log."""
    bnd = F.col("type").isin(ADD, DELETE)
    pr = F.col("type").isin(ADD, REPLACE)
    upd = F.col("type") == UPDATE
    agg = events.groupBy("photo_id").agg(
        F.max_by("type", "seq").alias("last_type"),
        F.max(F.when(bnd, F.col("seq"))).alias("b_seq"),
        F.max_by(F.col("type"), F.when(bnd, F.col("seq"))).alias("b_type"),
        F.max_by(F.col("user"), F.when(bnd, F.col("seq"))).alias("b_user"),
        F.max(F.when(pr, F.col("seq"))).alias("pr_seq"),
        F.max_by(F.col("path"), F.when(pr, F.col("seq"))).alias("pr_path"),
        F.max(F.when(upd, F.col("seq"))).alias("u_seq"),
        F.max_by(F.col("title"), F.when(upd, F.col("seq"))).alias("u_title"),
        F.max(F.when(F.col("type") == DELETE, F.col("seq"))).alias("d_seq"))
    user, path, title = _state_from(*[F.col(c) for c in
                                      ("b_seq", "b_type", "b_user", "pr_seq", "pr_path", "u_seq", "u_title", "d_seq")])
    return (agg.filter(F.col("last_type") != DELETE)
            .select("photo_id", user.alias("user"), path.alias("path"), title.alias("title"),
                    F.col("b_type").alias("_b_type")))


def current_state(events: DataFrame) -> DataFrame:
    return replay(events).drop("_b_type")


def state_at(events: DataFrame, time_text: str) -> DataFrame:
    """State at a time (``time <= t`` compared as ISO text); replay order stays ``seq``."""
    return current_state(events.filter(F.col("time") <= F.lit(time_text)))


def mutable_table(events: DataFrame) -> DataFrame:
    """The same events applied to a mutable table: UPDATE of an absent row is a no-op,
    so only photos whose last add/delete is an add survive (no partial rows)."""
    return replay(events).filter(F.col("_b_type") == ADD).drop("_b_type")


def history(events: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """State of the touched photo after each event (``exists`` false after a delete).

    Running "last non-null" values per photo carried with the blockwise prefix
    operator, so a photo with very many events is spread over many tasks.
    """
    bnd = F.col("type").isin(ADD, DELETE)
    pr = F.col("type").isin(ADD, REPLACE)
    e = (events
         .withColumn("_b_seq", F.when(bnd, F.col("seq")))
         .withColumn("_b_type", F.when(bnd, F.col("type")))
         .withColumn("_b_user", F.when(bnd, F.coalesce(F.col("user"), F.lit(-1))))
         .withColumn("_pr_seq", F.when(pr, F.col("seq")))
         .withColumn("_pr_path", F.when(pr, F.col("path")))
         .withColumn("_u_seq", F.when(F.col("type") == UPDATE, F.col("seq")))
         .withColumn("_u_title", F.when(F.col("type") == UPDATE, F.col("title")))
         .withColumn("_d_seq", F.when(F.col("type") == DELETE, F.col("seq"))))
    cols = ["_b_seq", "_b_type", "_b_user", "_pr_seq", "_pr_path", "_u_seq", "_u_title", "_d_seq"]
    r = running_last(e, ["photo_id"], ["seq"], cols, n_blocks)
    g = {c: F.col(f"{c}_last") for c in cols}
    user, path, title = _state_from(g["_b_seq"], g["_b_type"], F.nullif(g["_b_user"], F.lit(-1)), g["_pr_seq"],
                                    g["_pr_path"], g["_u_seq"], g["_u_title"], g["_d_seq"])
    exists = F.col("type") != DELETE
    return r.select("seq", "photo_id", "type", exists.alias("exists"),
                    F.when(exists, user).alias("user"), F.when(exists, path).alias("path"),
                    F.when(exists, title).alias("title"))


def snapshot_events(state: DataFrame, at_seq: int) -> DataFrame:
    """A snapshot (state rows) as synthetic events at ``at_seq`` that rebuild it exactly.

    A full row (with user) becomes add + update(title); a partial row becomes
    delete + replace(path) + update(title) so that it stays partial.
    """
    full = state.filter(F.col("user").isNotNull())
    part = state.filter(F.col("user").isNull())
    s = F.lit(at_seq).cast("bigint")
    ev = lambda df, typ, off, user, path, title: df.select(
        (s * 4 + off).alias("seq"), F.lit("").alias("time"), F.lit(typ).alias("type"), "photo_id",
        user.alias("user"), path.alias("path"), title.alias("title"), F.lit(None).cast("string").alias("operation"))
    nul_i, nul_s = F.lit(None).cast("int"), F.lit(None).cast("string")
    out = [ev(full, ADD, 0, F.col("user"), F.col("path"), nul_s),
           ev(full.filter(F.col("title") != ""), UPDATE, 1, nul_i, nul_s, F.col("title")),
           ev(part, DELETE, 0, nul_i, nul_s, nul_s),
           ev(part.filter(F.col("path").isNotNull()), REPLACE, 1, nul_i, F.col("path"), nul_s),
           ev(part.filter(F.col("title").isNotNull()), UPDATE, 2, nul_i, nul_s, F.col("title"))]
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def replay_from_snapshot(events: DataFrame, at_seq: int) -> DataFrame:
    """Snapshot after ``at_seq`` plus the later events gives the full replay."""
    snap = current_state(events.filter(F.col("seq") <= at_seq))
    later = events.filter(F.col("seq") > at_seq).withColumn("seq", F.col("seq") * 4)
    return current_state(snapshot_events(snap, at_seq).unionByName(later.select(
        "seq", "time", "type", "photo_id", "user", "path", "title", "operation")))
