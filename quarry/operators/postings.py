"""An inverted index of posting lists, and search by a table of requests.

Rows (keyword, owner, id) are cut into ranges of (keyword, owner, id), one file
each; a hot keyword spans many ranges.  Inside a range the ids of a keyword and
owner form segments of at most ``SEGMENT`` ids: the first id, and the steps to
the others as numbers of seven bits a byte, whose zstd blocks Parquet adds.  A
directory, sorted by keyword, says which ranges hold a keyword and owner, from
which to which id and how many.

A search joins the requests with the directory and reads the files of these
ranges only; the list of their numbers, at most one per file of the index, is
all that passes the driver.  The requests and the requested lists are stored
beside the index, so that Spark knows their size and few lists are not joined
by a shuffle of the segments.  Requests for one list are stored in groups of
``GROUP``, and hits are shuffled as arrays of ``PIECE``; both become rows
after the join, owner by owner, a piece for all requests of a group before the
next piece.  So a stored result is small: the ids of a piece are the same few
bytes again and again, where all hits of one request after those of the other
need bytes for each hit.  Shuffle files of what is stored go when it is.  Counts
are answered by the directory alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import shuffles_removed

SEGMENT = 4096
IDS_AT_ONCE = 1 << 18  # decoded at once
GROUP = 512  # of requests
PIECE = 256  # of ids that meet a group, a multiple of 8: Parquet packs eight values at a time
KEYS = ["keyword", "owner"]


def to_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned numbers in groups of seven bits, low ones first, the last group below 128; and the bytes of each."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1) << np.uint64(7 * k)
    of = np.repeat(np.arange(len(v)), size)
    place = np.arange(len(of)) - (np.cumsum(size) - size)[of]
    groups = (v[of] >> (np.uint64(7) * place.astype(np.uint64))) & np.uint64(127)
    return (groups | np.where(place < size[of] - 1, np.uint64(128), np.uint64(0))).astype(np.uint8), size


def from_bytes(data: np.ndarray) -> np.ndarray:
    last = data < 128
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1]) if len(data) else np.zeros(0, np.int64)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.uint64) << (np.uint64(7) * place.astype(np.uint64)), starts) if len(data) else np.zeros(0, np.uint64)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings to segments; a list goes on in a new segment at the end of a batch."""
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        ids = batch.column("id").to_numpy()
        codes = [np.asarray(batch.column(c).dictionary_encode().indices.fill_null(-1)) for c in KEYS]
        new = np.ones(n, bool)
        new[1:] = (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])
        at = np.arange(n)
        new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % SEGMENT == 0
        first = np.flatnonzero(new)
        steps = np.diff(ids, prepend=ids[0])
        data, size = to_bytes(steps[~new])
        sizes = np.zeros(n, np.int64)
        sizes[~new] = size
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.append(first[1:], n)
        blob = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.append(upto[first], upto[-1]).astype(np.int32)), pa.py_buffer(data)])
        lead = batch.take(pa.array(first))
        yield pa.RecordBatch.from_arrays([*[lead.column(c) for c in KEYS], pa.array(ids[first]), pa.array(ids[ends - 1]), pa.array(ends - first), blob],
                                         [*KEYS, "first_id", "last_id", "n", "steps"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of segments, the number of ids of each segment and all ids; a slice's steps are decoded at once."""
    for batch in batches:
        most = np.cumsum(pc.binary_length(batch.column("steps")).to_numpy(zero_copy_only=False) + 1)  # a step has a byte at least
        k = 0
        while k < len(batch):
            upto = max(k + 1, int(np.searchsorted(most, (most[k - 1] if k else 0) + IDS_AT_ONCE, "right")))
            part = batch.slice(k, upto - k)
            k = upto
            blobs = part.column("steps")
            data = np.frombuffer(b"".join(blobs.to_pylist()), np.uint8)
            ends = np.cumsum(pc.binary_length(blobs).to_numpy(zero_copy_only=False))
            n = np.diff(np.append(0, np.cumsum(data < 128))[ends], prepend=0) + 1
            starts = np.cumsum(n) - n
            firsts = part.column("first_id").to_numpy(zero_copy_only=False)
            ids = np.empty(n.sum(), np.int64)
            step = np.ones(len(ids), bool)
            step[starts] = False
            ids[starts], ids[step] = firsts, from_bytes(data).astype(np.int64)
            ids = np.cumsum(ids)
            yield part, n, ids - np.repeat(ids[starts] - firsts, n)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, n, ids in _decoded(batches):
        who = pa.array(np.repeat(np.arange(len(n)), n))
        yield pa.RecordBatch.from_arrays([*[part.column(c).take(who) for c in KEYS], pa.array(ids)], [*KEYS, "id"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, n, ids in _decoded(batches):
        pieces = -(-n // PIECE)
        of = np.repeat(np.arange(len(n)), pieces)
        first = (np.cumsum(n) - n)[of] + PIECE * (np.arange(len(of)) - (np.cumsum(pieces) - pieces)[of])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)).astype(np.int32)), pa.array(ids))
        yield pa.RecordBatch.from_arrays([*[part.column(c).take(pa.array(of)) for c in KEYS], lists], [*KEYS, "ids"])


class PostingIndex:
    """An index in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, postings: DataFrame, path: str, parts: int | None = None) -> PostingIndex:
        """Write the index of ``postings`` (keyword, owner, id).  ``parts``: number of ranges; else Spark sizes them as for a sort."""
        order = [*KEYS, "id"]
        ranged = postings.repartitionByRange(parts, *order) if parts else postings.repartitionByRange(*order)
        rows = ranged.select(*KEYS, F.col("id").cast("bigint")).sortWithinPartitions(*order)
        cut = rows.mapInArrow(_segments, "keyword string, owner string, first_id bigint, last_id bigint, n bigint, steps binary")
        index = cls(postings.sparkSession, path)
        with shuffles_removed(index.spark):
            cut.withColumn("part", F.spark_partition_id()).write.partitionBy("part").option("compression", "zstd").parquet(f"{path}/segments")
            # ranges of lists serve both the grouping and the order of the directory
            dealt = index.segments().drop("steps").repartitionByRange(*KEYS, "part")
            lists = dealt.groupBy(*KEYS, "part").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"), F.sum("n").alias("n"))
            lists.sortWithinPartitions(*KEYS, "part").write.parquet(f"{path}/directory")
        return index

    def segments(self) -> DataFrame:
        return self.spark.read.schema("keyword string, owner string, first_id bigint, last_id bigint, n bigint, steps binary, part int").parquet(f"{self.path}/segments")

    def directory(self) -> DataFrame:
        return self.spark.read.schema("keyword string, owner string, part int, first_id bigint, last_id bigint, n bigint").parquet(f"{self.path}/directory")

    def postings(self) -> DataFrame:
        """All of (keyword, owner, id)."""
        return self.segments().select(*KEYS, "first_id", "steps").mapInArrow(_postings, "keyword string, owner string, id bigint")

    def lists_of(self, requests: DataFrame) -> DataFrame:
        """(keyword, owner, part) of the requested lists."""
        return self.directory().join(requests.select(*KEYS).distinct(), KEYS, "left_semi").select(*KEYS, "part")

    def files_of(self, lists: DataFrame) -> DataFrame:
        """All segments in the files that hold some of ``lists``; no other file is opened."""
        return self.segments().filter(F.col("part").isin([r.part for r in lists.select("part").distinct().collect()]))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"
        with shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def search(self, requests: DataFrame) -> DataFrame:
        """``requests`` with ``id``: a row per hit, one with null for a keyword or owner that the index doesn't know."""
        rest = [F.col(f"`{c}`") for c in requests.columns if c not in KEYS] or [F.lit(True).alias("asked")]
        place = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.lit(0)))
        groups = requests.select(*KEYS, F.struct(*rest).alias("r"), F.floor((place - 1) / GROUP).alias("g")).groupBy(*KEYS, "g").agg(F.collect_list("r").alias("asked"))
        asked = self._stored(groups.drop("g"), "requests")
        lists = self._stored(self.lists_of(asked), "asked")
        found = self.files_of(lists).join(lists, [*KEYS, "part"], "left_semi")
        # ids travel as arrays, their keyword and owner once for many
        hits = found.select(*KEYS, "first_id", "steps").mapInArrow(_lists, "keyword string, owner string, ids array<bigint>")
        # generated code keeps all rows that a row of its input becomes; transform() has none, so that this is one group and piece and not all of a list
        met = asked.join(hits, KEYS[::-1], "left").select(*KEYS, F.transform("asked", lambda r: r).alias("asked"), "ids")
        rows = met.select(*KEYS, F.explode("asked").alias("r"), "ids").select(*KEYS, "r", F.explode_outer("ids").alias("id"))
        return rows.select(*KEYS, *[F.col(f"r.`{c}`") for c in requests.columns if c not in KEYS], "id")
