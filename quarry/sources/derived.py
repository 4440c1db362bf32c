"""Views of the photo service derived from the driver tables (FIXTURES §3 recipes).

Every view is a lazy DataFrame over the parquet scans, so filters and column
pruning still reach the files and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.core import epoch_micros, iso_millis, stable_hash

# HTTP status of the synthesised access-log line per event type.
STATUS_BY_TYPE = {"view": 200, "click": 304, "signup": 401, "purchase": 502, "error": 500}

# Event-sourcing type per event type (``view`` is not part of the log).
ES_TYPE = {"signup": "addPhoto", "click": "updatePhotoData", "purchase": "replacePhoto",
           "error": "deletePhoto"}

N_SERVERS = 4          # server / lambda partition = event_id % 4
N_KEY_PARTITIONS = 6   # topic partition keyed by user = h(user_id) % 6
MAX_DELAY_S = 8 * 3600  # out-of-order arrival: up to 8 h late


def _map_col(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def status_of(event_type: Column) -> Column:
    return _map_col(event_type, STATUS_BY_TYPE).cast("int")


def events_x(events: DataFrame) -> DataFrame:
    """Events with the photo key ``k``, path, view flag, server and key partition."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (events
            .withColumn("k", k)
            .withColumn("path", F.concat(F.lit("/st/"), k.cast("string")))
            .withColumn("is_view", F.col("event_type") == "view")
            .withColumn("server", (F.col("event_id") % N_SERVERS).cast("int"))
            .withColumn("kpart", (stable_hash("user_id") % N_KEY_PARTITIONS).cast("int")))


def user_agent(user_id: Column, k: Column) -> Column:
    """Client of a request: app on iOS (user % 3 = 0), app on Android (1), browser (2)."""
    ver = F.concat(F.lit("PhotosApp/3."), (k % 3).cast("string"))
    return (F.when(user_id % 3 == 0, F.concat(ver, F.lit(" (iOS 15)")))
            .when(user_id % 3 == 1, F.concat(ver, F.lit(" (Android 12)")))
            .otherwise(F.lit("Mozilla/5.0 (X11; Linux x86_64) Firefox/95.0")))


# Image format of a photo key (k % 3).
IMAGE_FORMATS = ["jpeg", "heic", "png"]


def image_format(k: Column) -> Column:
    return (F.when(k % 3 == 0, F.lit(IMAGE_FORMATS[0])).when(k % 3 == 1, F.lit(IMAGE_FORMATS[1]))
            .otherwise(F.lit(IMAGE_FORMATS[2])))


def _access_line(e: DataFrame) -> Column:
    uid = F.col("user_id").cast("string")
    return F.concat(
        F.lit("192.0.2."), uid, F.lit(" - u"), uid, F.lit(" ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "GET '), F.col("path"), F.lit(' HTTP/1.1" '),
        status_of(F.col("event_type")).cast("string"), F.lit(" "), F.col("event_id").cast("string"),
        F.lit(' "-" "'), user_agent(F.col("user_id"), F.col("k")), F.lit('"'))


def shipped(df: DataFrame, name: str) -> DataFrame:
    """Store synthesised log lines as files (what a log shipper does) and scan them.

    Every call writes its own copy below ``spark.checkpoint.dir``, so an answer
    never comes from an older table.  Queries then parse a stored text column
    instead of re-deriving the line inside every predicate.
    """
    from quarry.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def access_lines(events: DataFrame) -> DataFrame:
    """One access-log line per event:
    ``ip - user [time +0000] "GET path HTTP/1.1" status size "-" "agent"``."""
    e = events_x(events)
    return shipped(e.select("event_id", "server", _access_line(e).alias("line")), "access-log")


def lake_lines(events: DataFrame) -> DataFrame:
    """Multi-format log lake: one line per event in the layout of the service that logs it.

    view/click -> nginx access (host web-<server+1>), error -> nginx error log,
    purchase -> JSON upload log, signup -> syslog auth (no year), and every
    50th key additionally a logfmt deploy line.  Columns: service, file, host,
    line, event_id.
    """
    e = events_x(events)
    uid = F.col("user_id").cast("string")
    host = F.concat(F.lit("web-"), (F.col("server") + 1).cast("string"))
    access = _access_line(e)
    error = F.concat(
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), F.lit(" [error] 7#7: *"), F.col("event_id").cast("string"),
        F.lit(" upstream timed out, client: 192.0.2."), uid, F.lit(', request: "GET '), F.col("path"),
        F.lit(' HTTP/1.1", format='), image_format(F.col("k")))
    upload = F.concat(
        F.lit('{"ts": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z", "level": "error", '),
        F.lit('"service": "upload", "event": "crash", "platform": "'),
        F.when(F.col("k") % 2 == 0, F.lit("ios")).otherwise(F.lit("android")),
        F.lit('", "app_version": "3.'), (F.col("k") % 3).cast("string"),
        F.lit('", "location": "'), F.concat(F.lit("Upload.swift:"), (F.col("k") % 5 * 10).cast("string")),
        F.lit('", "user": '), uid, F.lit("}"))
    auth = F.concat(
        F.date_format("ts", "MMM"), F.lit(" "), F.lpad(F.date_format("ts", "d"), 2, " "), F.lit(" "),
        F.date_format("ts", "HH:mm:ss"), F.lit(" auth-1 sshd[42]: Failed password for u"), uid,
        F.lit(" from 198.51.100."), (F.col("user_id") % 7).cast("string"), F.lit(" port 22 ssh2"))
    et = F.col("event_type")
    service = (F.when(et.isin("view", "click"), F.lit("nginx")).when(et == "error", F.lit("nginx"))
               .when(et == "purchase", F.lit("upload")).otherwise(F.lit("auth")))
    file = (F.when(et.isin("view", "click"), F.lit("access")).when(et == "error", F.lit("error"))
            .otherwise(F.lit(None).cast("string")))
    line = (F.when(et.isin("view", "click"), access).when(et == "error", error)
            .when(et == "purchase", upload).otherwise(auth))
    main = e.select(service.alias("service"), file.alias("file"),
                    F.when(service == "nginx", host).alias("host"), line.alias("line"), "event_id")
    deploy = (e.filter(F.col("k") % 50 == 0)
              .select(F.lit("deploy").alias("service"), F.lit(None).cast("string").alias("file"),
                      F.lit(None).cast("string").alias("host"),
                      F.concat(F.lit("time="), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                               F.lit('Z level=info service=upload msg="deployed version 3.'),
                               (F.col("event_id") % 9).cast("string"), F.lit('" host=app-1')).alias("line"),
                      "event_id"))
    return shipped(main.unionByName(deploy), "log-lake")


def es_log(events: DataFrame) -> DataFrame:
    """Event-sourcing log ``(seq, time, type, photo_id, data)`` from the events table."""
    e = events_x(events).filter(F.col("event_type") != "view")
    typ = _map_col(F.col("event_type"), ES_TYPE)
    op = F.when(F.col("k") % 5 == 0, F.lit("/undo")).otherwise(
        F.concat(F.lit("/filter/f"), (F.col("k") % 7).cast("string")))
    title = F.concat(F.lit("t"), F.col("k").cast("string"))
    path = F.concat(F.lit("/st/"), F.col("event_id").cast("string"))
    data = (F.when(typ == "addPhoto", F.to_json(F.struct(F.col("k").alias("user"), path.alias("path"))))
            .when(typ == "updatePhotoData", F.to_json(F.struct(F.col("k").alias("user"), title.alias("title"))))
            .when(typ == "replacePhoto", F.to_json(F.struct(F.col("k").alias("user"), path.alias("path"),
                                                             op.alias("operation"))))
            .otherwise(F.to_json(F.struct(F.col("k").alias("user")))))
    return e.select(F.col("event_id").alias("seq"), iso_millis("ts").alias("time"), typ.alias("type"),
                    F.col("user_id").alias("photo_id"), data.alias("data"))


def arrival_key(event_id="event_id", ts="ts") -> Column:
    """Out-of-order arrival order: event time in micros plus a keyed delay of up to 8 h."""
    return epoch_micros(ts) + (stable_hash(event_id) % MAX_DELAY_S) * F.lit(1_000_000)


def redelivered(events: DataFrame) -> DataFrame:
    """Events plus a redelivered copy of every event with ``event_id % 10 = 3``."""
    return events.unionAll(events.filter(F.col("event_id") % 10 == 3))


def spans(lineitem: DataFrame) -> DataFrame:
    """Trace spans: trace = order, name = return flag, host = supplier % 3, length = quantity s."""
    start = F.col("l_shipdate")
    return lineitem.select(
        F.col("l_orderkey").alias("trace_id"),
        F.col("l_linenumber").alias("span_no"),
        F.col("l_returnflag").alias("name"),
        F.concat(F.lit("host-"), (F.col("l_suppkey") % 3).cast("string")).alias("host"),
        start.alias("start"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("l_quantity"))).alias("end"),
        F.col("l_quantity").alias("duration_s"),
        F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice"))


def photos(orders: DataFrame) -> DataFrame:
    """Photos: id, owner, size, upload date, format from the order priority."""
    return orders.select(F.col("o_orderkey").alias("photo_id"), F.col("o_custkey").alias("user_id"),
                         F.col("o_totalprice").alias("size"), F.col("o_orderdate").alias("upload_date"),
                         F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def album_photos(lineitem: DataFrame) -> DataFrame:
    """Album membership: distinct (album = part, photo = order) pairs."""
    return lineitem.select(F.col("l_partkey").alias("album_id"), F.col("l_orderkey").alias("photo_id")).distinct()


def friendships(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Friend edges: distinct (customer, supplier + 1,000,000) pairs of the order lines."""
    return (lineitem.select("l_orderkey", "l_suppkey")
            .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("user_id"), (F.col("l_suppkey") + 1_000_000).alias("friend_id"))
            .distinct())
