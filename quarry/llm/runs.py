"""Repeated runs of consecutive text units (lines or sentences), found globally.

Used by the line and the substring dedup, which say how runs are hashed (to 128
bits) and cut out; for lines a *cutter* splits a text into units that join back
to it, and names its runs.  A first pass counts 64 bits of them (combined before
the shuffle), only runs whose 64 bits occur twice go on, and those are grouped
by all 128 bits.  The first occurrence of a run is the one with the smallest
(id, 64 bits of the text, first unit); rows without id come last.

A run that occurs in a third of all documents costs one row per task in the
counts; joins back onto the occurrences are plain equi joins, which Spark
splits when skewed.  The repeated runs of one document are one array, bounded by
that document.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import discard, field, frozen, payload, slices, text_key

NO_ID_LAST = (1 << 63) - 1

RUN = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
                    T.StructField("pos", T.IntegerType()), T.StructField("len", T.IntegerType())])
CUT = T.StructType([T.StructField("text", T.StringType()),
                    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
                    T.StructField("n_removed", T.IntegerType())])


class Runs(NamedTuple):
    """The runs of one text: key, first unit and number of units of each."""

    keys: list[str]
    first: list[int]
    units: list[int]


class Cutter(NamedTuple):
    """``units(text)``: character offsets 0 = o0 < o1 < ... = len(text) of the units; ``runs(text)``: its runs."""

    units: Callable[[str], list[int]]
    runs: Callable[[str], Runs]


def hasher_of(cutter: Cutter):
    @F.arrow_udf(T.ArrayType(RUN))
    def run_hashes(text: pa.Array) -> pa.Array:
        parts = [hashed(part) for part in slices(text)]
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(hashed(text).type.value_type))

    def hashed(text: pa.Array) -> pa.ListArray:
        ends, digests = [0], []
        first, length = array("i"), array("i")
        for t in text:
            r = cutter.runs(t.as_py() or "")
            digests += map(xxhash.xxh3_128_digest, r.keys)
            first.extend(r.first)
            length.extend(r.units)
            ends.append(len(digests))
        h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        rows = pa.StructArray.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.frombuffer(first, np.int32)), pa.array(np.frombuffer(length, np.int32))], ["h1", "h2", "pos", "len"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return run_hashes


def uncovered(runs: list[dict]) -> set[int]:
    """Units of runs (pos, len) without the ``spare_len`` ones from ``spare`` on."""
    gone: set[int] = set()
    for r in runs:
        own = range(r["pos"], r["pos"] + r["len"])
        gone.update(own if r["spare"] is None else (u for u in own if not r["spare"] <= u < r["spare"] + r["spare_len"]))
    return gone


def remover_of(cutter: Cutter):
    @F.arrow_udf(CUT)
    def without(text: pa.Array, removed: pa.Array) -> pa.Array:
        texts, spans, counts = [], [], []
        for t, gone in zip(text, removed, strict=True):
            t = t.as_py()
            gone = gone.as_py()
            if not gone or t is None:
                texts.append(t)
                spans.append([])
                counts.append(0)
                continue
            at, gone = cutter.units(t), uncovered(gone)
            covered = sorted(gone)
            for a, b in zip(covered, covered[1:]):  # white space only between covered units
                if b > a + 1 and not t[at[a + 1]:at[b]].strip():
                    gone.update(range(a + 1, b))
            merged: list[list[int]] = []
            for u in sorted(gone):
                if merged and merged[-1][1] == at[u]:
                    merged[-1][1] = at[u + 1]
                else:
                    merged.append([at[u], at[u + 1]])
            texts.append("".join(t[at[u]:at[u + 1]] for u in range(len(at) - 1) if u not in gone))
            spans.append([{"start": a, "end": b} for a, b in merged])
            counts.append(len(gone))
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(counts, pa.int32())], ["text", "spans", "n_removed"])

    return without


def repeated_runs(runs: DataFrame, spare_first: bool) -> DataFrame:
    """``(id, tk, removed)``: the runs (pos, len, spare, spare_len) of a document that occurred before, if it has any.

    ``runs`` has (id, tk, runs) with one row per document.  ``spare_first``: an
    occurrence that overlaps the first one in the same document doesn't cover
    the first one's units.
    """
    each = runs.select("id", "tk", F.explode("runs").alias("r")).select("id", "tk", "r.*")
    # written, so that the joins below deal both sides anew and Spark can split a hot key
    seen = frozen(each.groupBy("h1").count().filter("count > 1").select("h1"), "runs-seen")
    again = frozen(each.join(seen, "h1"), "runs-again")
    at = F.struct("id", "tk", "pos", "len")
    groups = frozen(again.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
                    .filter("first != last").select("h1", "h2", "first"), "runs-groups")
    later = again.join(groups, ["h1", "h2"]).filter(at != F.col("first"))
    own = (F.col("first.id") == F.col("id")) & (F.col("first.tk") == F.col("tk")) if spare_first else F.lit(False)
    run = F.struct("pos", "len", F.when(own, F.col("first.pos")).alias("spare"), F.when(own, F.col("first.len")).alias("spare_len"))
    removed = frozen(later.groupBy("id", "tk").agg(F.collect_set(run).alias("removed")), "runs-removed")
    discard(seen, again, groups)
    return removed


def without_repeats(docs: DataFrame, hasher, remover, id_col: str, text_col: str, spare_first: bool) -> DataFrame:
    """``(payload, id, text, spans, n_removed)`` of every row: the text without what repeated runs cover.

    ``hasher(text)``: an array of ``RUN``; ``remover(text, runs)``: a ``CUT``.
    """
    rows = payload(docs).select("payload", field(text_col).alias("t"), F.coalesce(field(id_col), F.lit(NO_ID_LAST)).alias("id"))
    rows = rows.withColumn("tk", text_key(F.col("t")))
    runs = frozen(rows.select("id", "tk", hasher("t").alias("runs")).filter(F.size("runs") > 0), "runs")
    removed = repeated_runs(runs, spare_first)
    discard(runs)
    # the runs to remove grow with the rows, so they are merged with them at any size and never broadcast
    return (rows.join(removed.hint("merge"), ["id", "tk"], "left").withColumn("cut", remover("t", "removed"))
            .select("payload", field(id_col).alias("id"), "cut.text", "cut.spans", F.coalesce("cut.n_removed", F.lit(0)).alias("n_removed")))


def with_text(rows: DataFrame, columns: list[str], text_col: str, chars_col: str | None) -> DataFrame:
    """The caller's columns with the new text (and its length in characters)."""
    new = {text_col: F.col("text")} | ({chars_col: F.length("text").cast("long")} if chars_col in columns else {})
    return rows.select(*[new.get(c, F.col("payload")[c]).alias(c) for c in columns])
