"""File sources and sinks.

All writers go through the DataFrame writer (one file per task, committed by
the output committer); all readers take an explicit schema where the format
has none, so no inference pass scans the data twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# ---------------------------------------------------------------- CSV / JSON / Parquet
def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", compression: str | None = None):
    w = df.write.mode("overwrite").option("header", header).option("sep", sep)
    w = w.option("quote", '"').option("escape", '"')
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None, header: bool = True, sep: str = ",",
             mode: str = "PERMISSIVE") -> DataFrame:
    """Typed CSV scan: header, quoted values may hold commas, ``""`` is one quote."""
    r = (spark.read.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"')
         .option("mode", mode).option("multiLine", False))
    if schema:
        r = r.schema(schema)
    return r.csv(path)


def write_json(df: DataFrame, path: str, compression: str | None = None):
    """S3: JSON Lines, nested structs and arrays kept."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, dynamic: bool = True,
                  compression: str | None = None):
    """Parquet, optionally hive-partitioned; dynamic overwrite replaces only the written partitions."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


# ---------------------------------------------------------------- text with labels
def write_labelled_text(df: DataFrame, path: str, stem_col: str = "stem", line_col: str = "line"):
    """Lay out log lines as one folder per source file stem (``stem=access-web-1``)."""
    df.select(stem_col, line_col).write.mode("overwrite").partitionBy(stem_col).text(path)


def labels_from_stem(stem: Column) -> tuple[Column, Column, Column]:
    """Labels of a file stem: ``access-web-1`` -> (nginx, access, web-1); ``upload`` -> (upload, -, -)."""
    web = stem.rlike(r"^(access|error)-")
    service = F.when(web, F.lit("nginx")).otherwise(stem)
    file = F.when(web, F.regexp_extract(stem, r"^([^-]+)-", 1))
    host = F.when(web, F.regexp_extract(stem, r"^[^-]+-(.+)$", 1))
    return service, file, host


def read_labelled_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line with labels from the file path (``_metadata.file_path``)."""
    df = spark.read.option("recursiveFileLookup", False).text(path)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"stem=([^/]+)/", 1)
    service, file, host = labels_from_stem(stem)
    return df.select(service.alias("service"), file.alias("file"), host.alias("host"),
                     F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"))


# ---------------------------------------------------------------- NaN / timestamps
def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN -> NULL before a bulk load (databases have no NaN)."""
    return df.select(*[F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def timestamp_text_columns(df: DataFrame, ts_cols: list[str]) -> DataFrame:
    """Per timestamp column, ``yyyy-MM-dd`` if every value is at midnight, else ISO with ms and Z.

    One aggregate pass computes ``bool_and(ts = date_trunc('day', ts))`` per
    column; the one-row result is cross-joined (bounded: one row).
    """
    flags = df.agg(*[F.coalesce(F.bool_and(F.col(c) == F.date_trunc("day", F.col(c))), F.lit(True))
                     .alias(f"_mid_{c}") for c in ts_cols])
    j = df.crossJoin(F.broadcast(flags))
    out = []
    for c in df.columns:
        if c in ts_cols:
            out.append(F.when(F.col(f"_mid_{c}"), F.date_format(c, "yyyy-MM-dd"))
                       .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


# ---------------------------------------------------------------- sizes
def folder_bytes(spark: SparkSession, path: str, suffix_glob: str = "part-*") -> DataFrame:
    """Total bytes and number of data files below ``path`` (file metadata only, no content)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", suffix_glob)
             .option("recursiveFileLookup", True).load(path).select("length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("files"))
