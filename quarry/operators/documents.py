"""Nested photo / album documents (J4, J5) and their flattening.

A photo document embeds its user and an optional camera as structs; an album
document's photo ids and follower ids are rows by position, so no row grows with
the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import prefix_running

# Photo format by order status.
FORMAT_BY_STATUS = {"F": "jpeg", "O": "heic", "P": "png"}

PHOTO_DOC_DDL = (
    "photo_id bigint, path string, upload_date timestamp_ntz, size double, format string, title string, "
    "objects array<string>, user struct<user_id:bigint,account_name:string,segment:string>, "
    "camera struct<camera_id:int,manufacturer:string>")


def _format(col):
    expr = None
    for k, v in FORMAT_BY_STATUS.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def photo_documents(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Orders as photo documents with embedded user and optional camera (nation).

    camera_id = ``o_orderkey % 25`` with 0 meaning "no camera" (null struct).
    """
    o = orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.nullif((F.col("o_orderkey") % 25).cast("int"), F.lit(0)).alias("camera_id"))
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    n = nation.select(F.col("n_nationkey").alias("cam_key"), F.col("n_name"))
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("camera_id") == F.col("cam_key"), "left")
    title = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")))
    objects = F.split(F.lower(F.regexp_replace("o_orderpriority", r"^\d-", "")), " ")
    return j.select(
        F.col("o_orderkey").alias("photo_id"),
        F.concat(F.lit("/st/u"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"),
                 F.lit(".jpg")).alias("path"),
        F.col("o_orderdate").alias("upload_date"), F.col("o_totalprice").alias("size"),
        _format(F.col("o_orderstatus")).alias("format"), title.alias("title"), objects.alias("objects"),
        F.struct(F.col("o_custkey").alias("user_id"), F.col("c_name").alias("account_name"),
                 F.col("c_mktsegment").alias("segment")).alias("user"),
        F.when(F.col("camera_id").isNotNull(),
               F.struct(F.col("camera_id"), F.col("n_name").alias("manufacturer"))).alias("camera"))


def positioned(df: DataFrame, keys: list[str], item: str, name: str, distinct: bool = True) -> DataFrame:
    """The sorted list of each key as rows ``(keys, pos, name)``, ``pos`` from 0 without gaps.

    One shape at any size: a key with a third of all rows is many rows, numbered
    by the running-number operator, never one unbounded list.
    """
    d = df.select(*keys, F.col(item).alias(name))
    d = d.distinct() if distinct else d
    return prefix_running(d, keys, [*keys, name]).select(*keys, (F.col("_rank") - 1).cast("bigint").alias("pos"), name)


def album_documents(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Albums (parts) with their photo ids (orders) and follower ids (suppliers) as two sorted lists.

    Position ``pos`` of both lists is one row, null where a list is shorter; an
    album without both has one row with null position.
    """
    photos = positioned(lineitem, ["l_partkey"], "l_orderkey", "photo")
    followers = positioned(lineitem, ["l_partkey"], "l_suppkey", "follower")
    lists = photos.join(followers, ["l_partkey", "pos"], "full_outer")
    return (part.select(F.col("p_partkey").alias("album_id"), F.col("p_name").alias("title"))
            .join(lists, F.col("album_id") == F.col("l_partkey"), "left")
            .select("album_id", "title", "pos", "photo", "follower"))


def flatten_photo(doc: DataFrame) -> DataFrame:
    """Nested document -> flat CSV-ready row; list joined with ``;``, missing camera -> ''."""
    return doc.select(
        "photo_id", "path", "upload_date", "size", "format", "title",
        F.array_join("objects", ";").alias("objects"),
        F.col("user.user_id").alias("user_id"), F.col("user.account_name").alias("account_name"),
        F.col("user.segment").alias("segment"),
        F.coalesce(F.col("camera.camera_id").cast("string"), F.lit("")).alias("camera_id"),
        F.coalesce(F.col("camera.manufacturer"), F.lit("")).alias("manufacturer"))
