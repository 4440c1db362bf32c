"""SURVEY §2.1 scans, sources and sinks (S1-S17; stream sources live in streaming_q).

Round-trip queries write into a fresh folder below ``spark.checkpoint.dir``
(the shared location on a cluster) and read the result back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import month_text
from quarry.operators.documents import PHOTO_DOC_DDL, flatten_photo, photo_documents
from quarry.plans.aggregates import a2
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, PHOTO_DOC
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.derived import events_x, lake_lines
from quarry.sources.tables import Tables


@register("S1_typed_csv_round_trip", """
SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS c_name, c_nationkey, c_acctbal FROM customer""")
def s1(spark, sf):
    """Typed CSV scan: header, quoted values holding commas and ``""`` quotes survive a round trip."""
    c = Tables(spark, sf).customer.select(
        "c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name"),
        "c_nationkey", "c_acctbal")
    path = scratch_path(spark, "s1")
    files.write_csv(c, path)
    return files.read_csv(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")


@register("S2_parquet_scan_by_name", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice) * 100) / 100 AS total FROM orders GROUP BY 1""")
def s2(spark, sf):
    """Parquet table scan by name (column-pruned)."""
    o = Tables(spark, sf).orders
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                          (F.round(F.sum("o_totalprice") * 100, 0) / 100).alias("total"))


def _whole(docs):
    """Every field of a nested photo document."""
    return docs.select("photo_id", "path", "upload_date", "size", "format", "title", "objects", "user.user_id", "user.account_name",
                       "user.segment", "camera.camera_id", "camera.manufacturer")


@register("S3_nested_json_lines", f"""
WITH {PHOTO_DOC} SELECT photo_id, path, upload_date, size, format, title, objects, user_id, account_name, segment, camera_id, manufacturer FROM doc""")
def s3(spark, sf):
    """JSON Lines write / read of nested documents with an explicit schema."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    path = scratch_path(spark, "s3")
    files.write_json(d, path)
    back = files.read_json(spark, path, PHOTO_DOC_DDL)
    return _whole(back)


def _stem():
    """File stem of a line's source: ``<file>-<host>`` for web logs, else the service name."""
    return (F.when(F.col("file").isNotNull(), F.concat("file", F.lit("-"), "host"))
            .otherwise(F.col("service")))


@register("S4_text_scan_with_file_labels", f"""
WITH {EX}, l AS (
  SELECT CASE WHEN event_type IN ('view', 'click', 'error') THEN 'nginx'
              WHEN event_type = 'purchase' THEN 'upload' ELSE 'auth' END AS service,
         CASE WHEN event_type IN ('view', 'click') THEN 'access' WHEN event_type = 'error' THEN 'error' END AS file,
         CASE WHEN event_type IN ('view', 'click', 'error') THEN 'web-' || CAST(server + 1 AS VARCHAR) END AS host
  FROM ex
  UNION ALL SELECT 'deploy', NULL, NULL FROM ex WHERE k % 50 = 0)
SELECT service, file, host, count(*) AS lines FROM l GROUP BY 1, 2, 3""")
def s4(spark, sf):
    """Raw text scan, one row per line, with labels (service, file, host) from the file name."""
    lines = lake_lines(Tables(spark, sf).events)
    path = scratch_path(spark, "s4")
    files.write_labelled_text(lines.withColumn("stem", _stem()), path)
    back = files.read_labelled_text(spark, path)
    return back.groupBy("service", "file", "host").agg(F.count(F.lit(1)).alias("lines"))


@register("S5_flat_csv_from_nested", f"""
WITH {PHOTO_DOC}
SELECT photo_id, array_to_string(objects, ';') AS objects, account_name,
       coalesce(CAST(camera_id AS VARCHAR), '') AS camera_id, coalesce(manufacturer, '') AS manufacturer FROM doc""")
def s5(spark, sf):
    """CSV from nested records: structs flattened, list joined with ``;``, missing camera -> ''."""
    t = Tables(spark, sf)
    flat = flatten_photo(photo_documents(t.orders, t.customer, t.nation))
    path = scratch_path(spark, "s5")
    files.write_csv(flat.select("photo_id", "objects", "account_name", "camera_id", "manufacturer"), path)
    back = files.read_csv(spark, path, "photo_id bigint, objects string, account_name string, camera_id string, "
                                        "manufacturer string")
    # CSV has no null vs '' distinction: empty fields come back as null
    return back.select("photo_id", F.coalesce("objects", F.lit("")).alias("objects"), "account_name",
                       F.coalesce("camera_id", F.lit("")).alias("camera_id"),
                       F.coalesce("manufacturer", F.lit("")).alias("manufacturer"))


@register("S6_parquet_nested_schema", f"""
WITH {PHOTO_DOC} SELECT photo_id, path, upload_date, size, format, title, objects, user_id, account_name, segment, camera_id, manufacturer FROM doc""")
def s6(spark, sf):
    """Parquet with an explicit nested schema (structs, array, nullable struct) round trip."""
    t = Tables(spark, sf)
    d = photo_documents(t.orders, t.customer, t.nation)
    path = scratch_path(spark, "s6")
    files.write_parquet(d, path)
    back = spark.read.parquet(path)
    return _whole(back)


@register("S7_hive_partitioned_by_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1""")
def s7(spark, sf):
    """Hive-partitioned Parquet, one folder per month, written twice with dynamic overwrite."""
    o = Tables(spark, sf).orders.withColumn("month", month_text("o_orderdate"))
    path = scratch_path(spark, "s7")
    files.write_parquet(o, path, ["month"])
    files.write_parquet(o.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")), path, ["month"])
    back = spark.read.parquet(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@register("S9_nan_to_null", """
SELECT count(*) AS n, count(*) FILTER (WHERE value >= 1) AS with_value, count(*) FILTER (WHERE value < 1) AS nulls FROM events""")
def s9(spark, sf):
    """Bulk-load rule NaN -> NULL (values below 1 are sensor NaNs here)."""
    ev = Tables(spark, sf).events.select(
        F.when(F.col("value") < 1, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    clean = files.nan_to_null(ev, ["value"])
    return clean.agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"),
                     F.count_if(F.col("value").isNull()).alias("nulls"))


@register("S10_sorted_tsv_sink", f"""
WITH {EX}
SELECT path, count(*) AS views, count(DISTINCT user_id) AS viewers,
       round(100.0 * sum(CASE WHEN user_id % 3 <> 2 THEN 1 ELSE 0 END) / count(*)) / 100.0 AS app_share
FROM ex WHERE is_view GROUP BY path""")
def s10(spark, sf):
    """TSV sink with header, sorted by views desc then path asc (range-partitioned part files)."""
    feats = a2(spark, sf).orderBy(F.desc("views"), F.asc("path"))
    path = scratch_path(spark, "s10")
    files.write_csv(feats, path, sep="\t")
    return files.read_csv(spark, path, "path string, views bigint, viewers bigint, app_share double", sep="\t")


@register("S11_csv_timestamp_rule", """
SELECT 'orders' AS tbl, o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS ts_text FROM orders
UNION ALL SELECT 'events', event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' FROM events""")
def s11(spark, sf):
    """CSV export rule: a column all at midnight is written as a date, else ISO with ms and Z."""
    t = Tables(spark, sf)
    out = []
    for name, rows in (("orders", t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"))),
                       ("events", t.events.select(F.col("event_id").alias("id"), "ts"))):
        path = scratch_path(spark, f"s11-{name}")
        files.write_csv(files.timestamp_text_columns(rows, ["ts"]), path)
        out.append(files.read_csv(spark, path, "id bigint, ts string").select(F.lit(name).alias("tbl"), "id", F.col("ts").alias("ts_text")))
    return out[0].unionByName(out[1])


@register("S12_preview_extract", """
WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)
SELECT source, doc_id, CAST(rn AS INTEGER) AS line_no FROM r WHERE rn <= 3
UNION ALL
SELECT 'events ' || strftime(ts, '%Y-%m-%d'), event_id, NULL FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'""")
def s12(spark, sf):
    """Preview: first 3 rows of every source (row_number per group) plus the events of one day."""
    from pyspark.sql import Window
    d = Tables(spark, sf).documents.select("source", "doc_id")
    w = Window.partitionBy("source").orderBy("doc_id")
    head = d.withColumn("line_no", F.row_number().over(w)).filter("line_no <= 3")
    ev = Tables(spark, sf).events
    lo, hi = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-06 00:00:00").cast("timestamp_ntz")
    day = ev.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).select(
        F.concat(F.lit("events "), F.date_format("ts", "yyyy-MM-dd")).alias("source"),
        F.col("event_id").alias("doc_id"), F.lit(None).cast("int").alias("line_no"))
    return head.unionByName(day)


@register("S14_route_to_explicit_partition", """
SELECT CAST(event_id % 4 AS INTEGER) AS server, count(*) AS n, 1 AS partitions_holding, count(*) AS in_their_own FROM events GROUP BY 1""")
def s14(spark, sf):
    """Route each message to an explicit partition (its server): one partition per server."""
    ex = events_x(Tables(spark, sf).events).select("server", "event_id")
    routed = ex.repartitionById(4, "server").withColumn("pid", F.spark_partition_id())
    per = routed.groupBy("server").agg(F.count(F.lit(1)).alias("n"),
                                       F.countDistinct("pid").cast("int").alias("partitions_holding"),
                                       F.count_if(F.col("pid") == F.col("server")).alias("in_their_own"))
    return per


@register("S15_size_report_per_format")
def s15(spark, sf):
    """Bytes of the same rows per format, plain and gzip (file lengths only; rows-only check)."""
    o = Tables(spark, sf).orders
    base = scratch_path(spark, "s15")
    out = None
    for fmt in ("csv", "json", "parquet"):
        for comp in ("none", "gzip"):
            p = f"{base}/{fmt}-{comp}"
            if fmt == "csv":
                files.write_csv(o, p, compression=comp)
            elif fmt == "json":
                files.write_json(o, p, compression=comp)
            else:
                files.write_parquet(o, p, compression="uncompressed" if comp == "none" else comp)
            r = files.folder_bytes(spark, p).select(F.lit(fmt).alias("format"), F.lit(comp).alias("compression"),
                                                    "bytes", "files")
            out = r if out is None else out.unionByName(r)
    return out


@register("S16_two_column_read", """
SELECT l_returnflag, round(sum(l_quantity)) AS qty FROM lineitem GROUP BY 1""")
def s16(spark, sf):
    """Read only two columns of a columnar file (``ReadSchema`` holds just those two)."""
    li = Tables(spark, sf).lineitem.select("l_returnflag", "l_quantity")
    return li.groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 0).alias("qty"))
