"""User-defined fold of ordered events per key, for any fold written as a monoid.

A fold ``apply(state, event)`` cannot be split, but transforms of the state can:
a :class:`Monoid` turns an event into a transform (``step`` from the transform
so far) and composes transforms associatively.  The fold then runs in two
bounded stages:

1. ``repartitionByRange(key, order)`` and a sort; one ``mapInArrow`` pass folds
   each task's slice of every key into one transform (a row per key and block);
2. the transforms are hash-partitioned by key, sorted by block and composed in a
   second pass: at most one per block and key, so a hot key never meets in one
   task whole.

:class:`ReplayFold` is the event replay of the photo log written this way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.operators.keyed_table import KeyedTable

ROWS_OUT = 10_000


class Monoid(Protocol):
    """What a fold needs; transforms are dicts with the columns of ``transform_ddl``."""

    transform_ddl: str
    state_ddl: str

    def identity(self) -> dict: ...
    def step(self, transform: dict, event: dict) -> dict: ...
    def compose(self, first: dict, then: dict) -> dict: ...
    def final(self, transform: dict) -> dict | None: ...


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dicts with the values Spark has: integers stay integers beside nulls."""
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while out := list(islice(rows, ROWS_OUT)):
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _block_transforms(events: DataFrame, key: str, order: list[str], monoid: Monoid, n: int) -> DataFrame:
    """``(key, _blk, transform)``: one transform per key and block of the order, and blocks are ordered."""
    ddl = f"{key} {events.schema[key].dataType.simpleString()}, _blk int, {monoid.transform_ddl}"
    schema = _arrow(ddl)

    def blocks(batches):
        def rows():
            for (k, b), own in groupby(_records(batches), lambda r: (r[key], r["_blk"])):
                t = monoid.identity()
                for event in own:
                    t = monoid.step(t, event)
                yield {key: k, "_blk": b, **t}

        return _batches(rows(), schema)

    e = (events.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
         .withColumn("_blk", F.spark_partition_id()))
    return e.mapInArrow(blocks, ddl)


def _composer(keys: list[str], monoid: Monoid, finish, ddl: str):
    """Composes the transforms of each key, which come in order; ``finish`` gives the key's result or None."""
    schema = _arrow(ddl)

    def run(batches):
        def rows():
            for k, own in groupby(_records(batches), lambda r: tuple(r[c] for c in keys)):
                t = monoid.identity()
                for part in own:
                    t = monoid.compose(t, part)
                result = finish(t)
                if result is not None:
                    yield {**dict(zip(keys, k, strict=True)), **result}

        return _batches(rows(), schema)

    return run


def fold(events: DataFrame, key: str, order: list[str], monoid: Monoid, n_blocks: int | None = None) -> DataFrame:
    """``(key, state columns)`` of every key whose final state is not None; events in ``order`` per key."""
    n = n_blocks or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    ddl = f"{key} {events.schema[key].dataType.simpleString()}, {monoid.state_ddl}"
    parts = _block_transforms(events, key, order, monoid, n)
    return parts.repartition(n, key).sortWithinPartitions(key, "_blk").mapInArrow(_composer([key], monoid, monoid.final, ddl), ddl)


class StoredFold:
    """A fold whose transforms are kept in a keyed table, so that a run reads new events only.

    ``position`` is the highest value of the integer column ``order`` that has been
    folded in.  ``advance`` takes the events after it, folds them by blocks and
    composes the results onto the stored transforms, in the buckets of their keys
    only; events up to the position are passed over, so a run may be repeated.
    Events must come in order: one that arrives after its place was passed is not seen.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str, order: str, monoid: Monoid, buckets: int = 256):
        self.key, self.order, self.monoid = key, order, monoid
        self.key_ddl = f"{key} {key_type}"
        self.table = KeyedTable(spark, path, [key], f"{self.key_ddl}, _upto bigint, {monoid.transform_ddl}", buckets)

    def create(self) -> StoredFold:
        self.table.create()
        return self

    def position(self) -> int | None:
        return self.table.rows().agg(F.max("_upto")).first()[0]

    def advance(self, events: DataFrame, n_blocks: int | None = None) -> None:
        at = self.position()
        fresh = events if at is None else events.filter(F.col(self.order) > at)
        n = n_blocks or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
        monoid = _Tracked(self.monoid, self.order)
        parts = _block_transforms(fresh, self.key, [self.order], monoid, n)

        def rewrite(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.withColumn("_blk", F.lit(-1)).unionByName(new)
            ddl = f"bucket int, {self.key_ddl}, {monoid.transform_ddl}"
            dealt = both.repartition(F.col("bucket")).sortWithinPartitions("bucket", self.key, "_blk")
            return dealt.mapInArrow(_composer(["bucket", self.key], monoid, lambda t: t, ddl), ddl)

        self.table.update(parts, rewrite)

    def state(self) -> DataFrame:
        """``(key, state columns)`` as of the position."""
        ddl = f"{self.key_ddl}, {self.monoid.state_ddl}"
        return self.table.rows().mapInArrow(_composer([self.key], self.monoid, self.monoid.final, ddl), ddl)


class _Tracked:
    """A monoid that also keeps how far it has come."""

    def __init__(self, monoid: Monoid, order: str):
        self.monoid, self.order = monoid, order
        self.transform_ddl = f"_upto bigint, {monoid.transform_ddl}"

    def identity(self) -> dict:
        return {"_upto": None, **self.monoid.identity()}

    def step(self, transform: dict, event: dict) -> dict:
        return {**self.monoid.step(transform, event), "_upto": event[self.order]}

    def compose(self, first: dict, then: dict) -> dict:
        return {**self.monoid.compose(first, then), "_upto": then["_upto"] if then["_upto"] is not None else first["_upto"]}


def reduce_sorted(rows: DataFrame, keys: list[str], reducer, schema: str) -> DataFrame:
    """D2 hook: ``reducer(key values, iterator of row dicts)`` yields result dicts, one key after the other.

    Rows of a key come as a stream, so the reducer's memory need not grow with a
    group.  A key's rows go through one task in order; a reducer that can combine is a
    :class:`Monoid`, and ``fold`` splits its hot keys over blocks.
    """
    out_schema = _arrow(schema)

    def run(batches):
        def out():
            for k, own in groupby(_records(batches), lambda r: tuple(r[c] for c in keys)):
                yield from reducer(k, own)

        return _batches(out(), out_schema)

    return rows.repartition(*keys).sortWithinPartitions(*rows.columns).mapInArrow(run, schema)


class SumFold:
    """Sums of long columns: a reducer that can combine."""

    def __init__(self, columns: list[str]):
        self.columns = columns
        self.transform_ddl = self.state_ddl = ", ".join(f"{c} bigint" for c in columns)

    def identity(self) -> dict:
        return dict.fromkeys(self.columns, 0)

    def step(self, transform: dict, event: dict) -> dict:
        return {c: transform[c] + (event[c] or 0) for c in self.columns}

    compose = step

    def final(self, transform: dict) -> dict:
        return transform


class ReplayFold:
    """State of a photo: what the last addition or deletion left, then path and title set since."""

    transform_ddl = "base string, b_user int, b_path string, touched boolean, s_path string, s_title string"
    state_ddl = "user int, path string, title string"

    def identity(self) -> dict:
        return dict(base="same", b_user=None, b_path=None, touched=False, s_path=None, s_title=None)

    def step(self, transform: dict, event: dict) -> dict:
        fresh = self.identity()
        kind = event["type"]
        if kind == "addPhoto":
            return fresh | dict(base="add", b_user=event["user"], b_path=event["path"], touched=True)
        if kind == "deletePhoto":
            return fresh | dict(base="absent")
        sets = {"updatePhotoData": dict(s_title=event["title"]), "replacePhoto": dict(s_path=event["path"])}
        return transform | dict(touched=True) | sets.get(kind, {})

    def compose(self, first: dict, then: dict) -> dict:
        if then["base"] != "same":
            return then
        kept = {c: then[c] if then[c] is not None else first[c] for c in ("s_path", "s_title")}
        return first | kept | dict(touched=bool(first["touched"] or then["touched"]))

    def final(self, transform: dict) -> dict | None:
        t = transform
        if not t["touched"]:
            return None
        added = t["base"] == "add"
        path = t["s_path"] if t["s_path"] is not None else t["b_path"]
        title = t["s_title"] if t["s_title"] is not None else "" if added else None
        return {"user": int(t["b_user"]) if added and t["b_user"] is not None else None, "path": path, "title": title}


def replay_fold(events: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """Current state by folding the events of each photo in ``seq`` order."""
    e = events.select("photo_id", "seq", "type", "user", "path", "title")
    return fold(e, "photo_id", ["seq"], ReplayFold(), n_blocks)
