"""A stored log lake whose searches open only the chunks that may answer them.

Lines are cut by ranges of (day, service, time) into chunks, one file each; a
busy service's day spans many chunks.  A chunk directory keeps, per chunk, its
first and last time, its number of lines and a Bloom filter of the three-byte
sequences of its lines (A-Z lower-cased): bitmaps of ``PAGE`` bits, of which
only those with a bit are stored.

A time range reads the folders of the days inside it, and of its first and last
day the chunks whose times meet it.  A search for a text takes from the
directory the chunks whose filter holds every three-byte sequence of the text, and
whose times meet the range, and reads these; the list of their numbers, at most
one per file of the lake, is all that passes the driver.  A filter may name a
chunk too many but never leaves one out, as the lines themselves are then searched.
Texts under three bytes cannot be looked up: all chunks of the range are read.
Lines without a time have no day; searches without a range find them.  Lines have
no columns ``day`` and ``part``; a service that is an empty text reads back as null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = 4096 * 8  # bits of a stored bitmap
SLICE = 1 << 20  # bytes of text looked at together
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _places(codes: np.ndarray, pages: int) -> np.ndarray:
    """Bit of a three-byte sequence in a filter of ``pages * PAGE`` bits: the high bits of a multiplied code."""
    mixed = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (mixed * np.uint64(pages * PAGE) >> np.uint64(32)).astype(np.int64)


def _codes(data: np.ndarray) -> np.ndarray:
    low = LOWER[data].astype(np.uint32)
    return low[:-2] << 16 | low[1:-1] << 8 | low[2:]


def text_places(text: str, pages: int) -> dict[int, list[int]]:
    """Per page the bits that a chunk with ``text`` has set."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) < 3:
        return {}
    at = np.unique(_places(_codes(data), pages)).tolist()
    return {p: [a % PAGE for a in at if a // PAGE == p] for p in sorted({a // PAGE for a in at})}


def _line_places(lines: pa.Array, pages: int) -> Iterator[np.ndarray]:
    """Bits of the sequences inside lines (none across two lines), slice by slice."""
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return
    data = np.frombuffer(lines.buffers()[2], np.uint8)
    for a in range(int(offsets[0]), int(offsets[-1]), SLICE):
        part = data[a:min(a + SLICE + 2, int(offsets[-1]))]
        if len(part) < 3:
            continue
        inside = np.ones(len(part) - 2, bool)
        cuts = offsets[(offsets > a) & (offsets < a + len(part))] - a  # a sequence over the cut c starts at c-2 or c-1
        for back in (1, 2):
            at = cuts - back
            inside[at[(at >= 0) & (at < len(inside))]] = False
        yield _places(_codes(part)[inside], pages)


def _filters(pages: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bitmaps of the chunk at hand; a chunk that is read in pieces gives several, which are united later."""
        chunk, bits = None, np.zeros(pages * PAGE, bool)

        def out():
            table = np.packbits(bits.reshape(pages, PAGE), axis=1, bitorder="little")
            some = np.flatnonzero(table.any(axis=1))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), chunk, np.int32)), pa.array(some.astype(np.int32)), pa.array([table[p].tobytes() for p in some], pa.binary())],
                ["chunk", "page", "bits"])

        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            starts = np.flatnonzero(np.diff(chunks, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(chunks)] if len(chunks) else [], strict=True):
                if chunk is not None and chunks[a] != chunk:
                    yield out()
                    bits[:] = False
                chunk = int(chunks[a])
                for at in _line_places(batch.column("line").slice(a, b - a).fill_null(""), pages):
                    bits[at] = True
        if chunk is not None:
            yield out()

    return fn


class LakeStore:
    """A lake in the folder ``path``; ``pages`` sizes the filter of a chunk (8: 32 KB, for chunks of some MB)."""

    def __init__(self, spark: SparkSession, path: str, columns: str, pages: int = 8):
        self.spark, self.path, self.columns, self.pages = spark, path, columns, pages

    @classmethod
    def build(cls, lines: DataFrame, path: str, chunks: int | None = None, pages: int = 8) -> LakeStore:
        """Store ``lines`` (with service, ts, line).  ``chunks``: number of ranges; else Spark sizes them as for a sort."""
        kept = [c for c in lines.columns if c != "service"]
        store = cls(lines.sparkSession, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.select(kept).schema), pages)
        order = ["day", "service", "ts", F.xxhash64("line")]  # the hash deals a burst of one time to several ranges
        dated = lines.withColumn("day", F.to_date("ts"))
        ranged = dated.repartitionByRange(chunks, *order) if chunks else dated.repartitionByRange(*order)
        (ranged.select(*kept, "day", "service", F.spark_partition_id().alias("part")).sortWithinPartitions("day", "service", "part", "ts")
         .write.partitionBy("day", "service", "part").parquet(f"{path}/lines"))
        # a range that holds the end of one day or service and the start of another has one file of each
        stored = store.lines()
        numbered = stored.groupBy("day", "service", "part").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
        numbered.write.parquet(f"{path}/chunks")
        keyed = stored.select(F.col("part").alias("chunk"), F.col("line").cast("string").alias("line"))
        bits = keyed.mapInArrow(_filters(pages), "chunk int, page int, bits binary")
        (bits.groupBy("chunk", "page").agg(F.bitmap_or_agg("bits").alias("bits")).repartitionByRange("page", "chunk").sortWithinPartitions("page", "chunk")
         .write.parquet(f"{path}/filters"))
        return store

    def lines(self) -> DataFrame:
        return self.spark.read.schema(f"{self.columns}, day date, service string, part int").parquet(f"{self.path}/lines")

    def chunks(self) -> DataFrame:
        return self.spark.read.schema("day date, service string, part int, first_ts timestamp_ntz, last_ts timestamp_ntz, n bigint").parquet(f"{self.path}/chunks")

    def filters(self) -> DataFrame:
        return self.spark.read.schema("chunk int, page int, bits binary").parquet(f"{self.path}/filters")

    # ------------------------------------------------------------ searches
    @staticmethod
    def _meets(after: str, upto: str) -> Column:
        return (F.col("last_ts") > F.lit(after).cast("timestamp_ntz")) & (F.col("first_ts") <= F.lit(upto).cast("timestamp_ntz"))

    def between(self, after: str, upto: str) -> DataFrame:
        """Lines with a time in ``(after, upto]``."""
        first, last = (F.lit(dt.date.fromisoformat(t[:10])) for t in (after, upto))
        edge = F.col("day").isin(first, last)
        parts = [r.part for r in self.chunks().filter(edge & self._meets(after, upto)).select("part").distinct().collect()]
        inner = (F.col("day") > first) & (F.col("day") < last)
        a, b = (F.lit(t).cast("timestamp_ntz") for t in (after, upto))
        return self.lines().filter(inner | (edge & F.col("part").isin(parts))).filter((F.col("ts") > a) & (F.col("ts") <= b))

    def may_hold(self, texts: list[str]) -> DataFrame:
        """Numbers of the ranges that may hold a line with at least one of ``texts``."""
        found = None
        for text in texts:
            places = text_places(text, self.pages)
            if not places:
                return self.chunks().select(F.col("part").alias("chunk")).distinct()
            holds = F.lit(False)
            for page, at in places.items():
                byte = lambda p: F.conv(F.hex(F.substring("bits", p // 8 + 1, 1)), 16, 10).cast("int")
                every = F.lit(True)
                for p in at:
                    every &= F.getbit(byte(p), F.lit(p % 8)) == 1
                holds |= (F.col("page") == page) & every
            pages = self.filters().filter(F.col("page").isin(list(places)) & holds)
            hit = pages.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(places)).select("chunk")
            found = hit if found is None else found.unionAll(hit)
        return found.distinct()

    def holding(self, texts: list[str], after: str | None = None, upto: str | None = None) -> DataFrame:
        """Lines that hold at least one of ``texts`` (A-Z and a-z alike), if given with a time in ``(after, upto]``."""
        chunks = self.chunks()
        if after is not None:
            chunks = chunks.filter(self._meets(after, upto))
        parts = chunks.select(F.col("part").alias("chunk")).distinct().join(self.may_hold(texts), "chunk", "left_semi")
        base = self.lines() if after is None else self.between(after, upto)
        low = F.translate("line", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        held = F.lit(False)
        for text in texts:
            held |= F.contains(low, F.lit("".join(c.lower() if c.isascii() else c for c in text)))
        return base.filter(F.col("part").isin([r.chunk for r in parts.collect()])).filter(held)
