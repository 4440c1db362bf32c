"""A table with one row per key, changed bucket by bucket.

Keys hash into a fixed number of buckets.  A bucket is a folder, named after the
version that wrote it; a change writes the buckets of its keys anew and leaves
the others as they are.  Deletions write no rows: they mark the positions of the
deleted rows in bitmaps (one per 32768 rows of a file), which go when their
bucket is next written.  A manifest per version says, for each bucket, which
version wrote its rows and which one its bitmaps; a version exists from the
moment its manifest does, so readers see the old table or the new one.

The manifest has at most ``buckets`` rows, the only thing that passes the driver.
One writer at a time.  A change with a version that exists already is skipped, so
a stream that repeats a batch changes nothing.  Nulls are keys like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import delete_path

MANIFEST = "bucket int, rows_v bigint, gone_v bigint"
PAGES = "file string, page bigint, gone binary"
VERSION_ROW = -1  # in every manifest, so that the version of an empty table is known


def _is_gone(gone: Column, position: Column) -> Column:
    """The bit of a row in the bitmap of its page; no bitmap: no."""
    byte = F.conv(F.hex(F.substring(gone, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


class KeyedTable:
    """A table in the folder ``path`` with columns ``schema`` (DDL), one row per value of the columns ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], schema: str, buckets: int = 256):
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path, key, schema, buckets
        self.fields = StructType.fromDDL(schema)

    # ------------------------------------------------------------ versions
    def create(self) -> KeyedTable:
        """Version 0, without rows."""
        self._publish(0, {})
        return self

    def _manifests(self) -> DataFrame:
        return self.spark.read.schema(f"{MANIFEST}, v bigint").parquet(f"{self.path}/manifest")

    def version(self) -> int:
        return self._manifests().agg(F.max("v")).first()[0]

    def manifest(self, version: int | None = None) -> dict[int, tuple[int, int | None]]:
        """Per bucket the versions that wrote its rows and its bitmaps."""
        at = self.version() if version is None else version
        found = self._manifests().filter(F.col("v") == at).collect()
        if not found:
            raise ValueError(f"no version {at} in {self.path}")
        return {r.bucket: (r.rows_v, r.gone_v) for r in found if r.bucket != VERSION_ROW}

    def _publish(self, version: int, manifest: dict[int, tuple[int, int | None]]) -> None:
        rows = [(VERSION_ROW, version, None), *[(b, r, g) for b, (r, g) in sorted(manifest.items())]]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")

    # ------------------------------------------------------------ reading
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _typed(self, df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*[F.col(c).cast(self.fields[c].dataType) for c in columns]).select("*", self._bucket())

    def _files(self, kind: str, columns: str, folders: list[tuple[int, int]]) -> DataFrame:
        """The files of (version, bucket) folders; no other one is listed or opened."""
        schema = f"{columns}, v bigint, bucket int"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(
            *[f"{self.path}/{kind}/v={v}/bucket={b}" for v, b in folders])

    def _placed(self, manifest: dict[int, tuple[int, int | None]]) -> DataFrame:
        """Rows of buckets with bitmaps, with the place of each row, without the deleted ones."""
        data = self._files("rows", self.schema, [(r, b) for b, (r, _) in manifest.items()])
        at = F.col("_metadata.row_index") + 1
        data = data.select("*", F.col("_metadata.file_name").alias("file"), F.bitmap_bucket_number(at).alias("page"),
                           F.bitmap_bit_position(at).alias("position"))
        pages = self._files("gone", PAGES, [(g, b) for b, (_, g) in manifest.items() if g is not None]).drop("v")
        return data.join(pages, ["bucket", "file", "page"], "left").filter(~_is_gone(F.col("gone"), F.col("position")))

    def _rows(self, manifest: dict[int, tuple[int, int | None]]) -> DataFrame:
        whole = {b: m for b, m in manifest.items() if m[1] is None}
        columns = [*self.fields.names, "bucket"]
        out = self._files("rows", self.schema, [(r, b) for b, (r, _) in whole.items()]).select(columns)
        marked = {b: m for b, m in manifest.items() if m[1] is not None}
        return out.unionAll(self._placed(marked).select(columns)) if marked else out

    def rows(self, version: int | None = None) -> DataFrame:
        """The table, as of a version that has not been removed."""
        return self._rows(self.manifest(version)).select(self.fields.names)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys``, read from their buckets only."""
        wanted = self._typed(keys, self.key).distinct()
        now = self.manifest()
        hit = {b: now[b] for b in self._buckets_of(wanted) if b in now}
        return self._rows(hit).join(wanted, [*self.key, "bucket"], "left_semi").select(self.fields.names)

    # ------------------------------------------------------------ changes
    @staticmethod
    def _buckets_of(df: DataFrame) -> list[int]:
        return sorted(r.bucket for r in df.select("bucket").distinct().collect())

    def _staged(self, df: DataFrame, version: int) -> DataFrame:
        """The changes, written once: they name the buckets first and are merged then."""
        path = f"{self.path}/staged/v={version}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def merge(self, changes: DataFrame, combine: dict[str, Column], version: int | None = None) -> int:
        """Merge rows into the table: ``combine`` gives every other column as an aggregate over the table's columns,
        such that combining combined rows is the same as combining all (max, sum, max_by of a stored offset).

        A hot key in ``changes`` is combined before the shuffle; the rows of a bucket are moved once.
        """
        aggs = [combine[c].alias(c) for c in self.fields.names if c not in self.key]
        group = ["bucket", *self.key]
        new = self._typed(changes, self.fields.names).groupBy(*group).agg(*aggs)

        def rewrite(old: DataFrame, new: DataFrame) -> DataFrame:
            return old.unionByName(new).repartition(F.col("bucket")).groupBy(*group).agg(*aggs)  # no shuffle after the first

        return self._change(new, rewrite, version)

    def update(self, changes: DataFrame, rewrite: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None) -> int:
        """Change the buckets of ``changes`` (with the key and any other columns): ``rewrite(rows, changes)``, both with
        their ``bucket``, gives all rows of these buckets, with ``bucket``, and at least one of each."""
        keys = {c: F.col(c).cast(self.fields[c].dataType) for c in self.key}
        return self._change(changes.withColumns(keys).select("*", self._bucket()), rewrite, version)

    def _change(self, changes: DataFrame, rewrite: Callable[[DataFrame, DataFrame], DataFrame], version: int | None) -> int:
        now = self.version()
        version = now + 1 if version is None else version
        if version <= now:
            return now
        new = self._staged(changes, version)
        touched = self._buckets_of(new)
        manifest = self.manifest(now)
        old = self._rows({b: manifest[b] for b in touched if b in manifest})
        (rewrite(old, new).select("bucket", *self.fields.names)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/v={version}"))
        self._publish(version, manifest | {b: (version, None) for b in touched})
        delete_path(self.spark, f"{self.path}/staged/v={version}")
        return version

    def delete(self, keys: DataFrame, version: int | None = None) -> int:
        """Delete the rows of ``keys`` (unknown ones are no error) by marking their positions."""
        now = self.version()
        version = now + 1 if version is None else version
        if version <= now:
            return now
        doomed = self._staged(self._typed(keys, self.key).distinct(), version)
        manifest = self.manifest(now)
        hit = {b: manifest[b] for b in self._buckets_of(doomed) if b in manifest}
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"d.{c}")) for c in [*self.key, "bucket"]]
        found = self._placed(hit).alias("r").join(doomed.alias("d"), same, "left_semi")
        pages = found.groupBy("bucket", "file", "page").agg(F.bitmap_construct_agg("position").alias("gone"))
        before = self._files("gone", PAGES, [(g, b) for b, (_, g) in hit.items() if g is not None]).drop("v")
        path = f"{self.path}/gone/v={version}"
        (pages.unionByName(before).groupBy("bucket", "file", "page").agg(F.bitmap_or_agg("gone").alias("gone"))
         .repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path))
        marked = self._buckets_of(self.spark.read.schema(f"{PAGES}, bucket int").parquet(path))
        self._publish(version, manifest | {b: (manifest[b][0], version) for b in marked})
        delete_path(self.spark, f"{self.path}/staged/v={version}")
        return version

    def remove_old(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` versions and the folders that only they name."""
        used = {}
        for r in self._manifests().collect():  # kept versions x buckets
            used.setdefault(r.v, set())
            if r.bucket != VERSION_ROW:
                used[r.v] |= {("rows", r.rows_v, r.bucket)} | ({("gone", r.gone_v, r.bucket)} if r.gone_v is not None else set())
        old = sorted(used)[:-keep]
        kept = set().union(*[used[v] for v in used if v not in old])
        for v in old:
            delete_path(self.spark, f"{self.path}/manifest/v={v}")
        for kind, v, b in set().union(*[used[v] for v in old]) - kept:
            delete_path(self.spark, f"{self.path}/{kind}/v={v}/bucket={b}")
