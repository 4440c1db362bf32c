"""Exact top-k search by inner product with vector-approximation files.

Vectors become integers, floor(scale * x), and are dealt to blocks of about
``BLOCK`` by a hash.  A block's approximation file holds, for every vector and
dimension, the number of the cell it lies in; cells are the block's quantiles of
that dimension, stored as their smallest and largest value.  A query's score with
a vector lies between the sums of its least and greatest products with the cells.

1. Scan: approximations only.  Each block gives a query its k highest lower
   bounds; the k-th highest over all blocks is the query's bar.
2. Read: in each block, vectors whose upper bound reaches the bar are read
   exactly in descending order of the upper bound, until it falls below the k-th
   score found there (a tie goes on, as a smaller id may win it).  The blocks'
   answers, at most k each, are merged.

Queries are a stated set that grows with the table: they go in blocks, too, each
query block once to each of ``SPREAD`` groups of data blocks by a merge join:
a block's file is much smaller than its copies, so Spark's estimates would
broadcast them.  A task holds one query block and one data block at a time and
keeps the k best of the query block over the data blocks of its group; whole
numbers are stored in as few bytes as a block's values need.  Copies of one
vector are spread over blocks by the hash of their row and read in batches.

Defined results: vectors that are null or hold a null, NaN or infinite component
take no part; shorter vectors count as padded with zeros; rows without id take no
part; of rows that share an id each takes part, and only the query's own row is
left out; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import field, frozen, payload
from quarry.session import shuffles_removed

BLOCK = 2048
QUERY_BLOCK = 512
SPREAD = 256
CELLS = 64

FILE = "block long, ids binary, rows binary, cells binary, lows binary, highs binary, vectors binary"
ASKED = "q_ids binary, q_rows binary, q_vectors binary"


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(id, row, v)`` of the vectors that take part, as integers, all of the same length."""
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (payload(vectors).select(field(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), field(vec_col).cast("array<double>").alias("x"))
            .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & sound)
            .select("id", "row", F.transform("x", lambda c: F.floor(c * float(scale))).alias("v")))
    rows = frozen(rows, "vectors")
    size = rows.agg(F.max(F.size("v"))).first()[0] or 1
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), size - F.size("v")))).withColumn("dims", F.lit(size))


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    x = table.column(column).combine_chunks()
    return np.asarray(x.flatten(), np.int64).reshape(len(x), -1)


def approximate(v: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell numbers (uint8) of each vector and dimension, and each cell's lowest and highest value by dimension."""
    n, d = v.shape
    cells = min(cells, n)
    order = np.argsort(v, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], (n, d)), axis=0)
    number = (place * cells // n).astype(np.uint8)
    sorted_v = np.take_along_axis(v, order, axis=0)
    firsts = -(-np.arange(cells + 1) * n // cells)  # the first place of each cell
    return number, sorted_v[firsts[:-1]], sorted_v[firsts[1:] - 1]


def _bytes(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as all of them need, after one byte with that size."""
    size = next(n for n in (1, 2, 4, 8) if n == 8 or not x.size or (x.min() >= -(1 << 8 * n - 1) and x.max() < 1 << 8 * n - 1))
    return bytes([size]) + x.astype(f"i{size}").tobytes()


def _ints(value: bytes) -> np.ndarray:
    return np.frombuffer(value, f"i{value[0]}", offset=1).astype(np.int64)


def _file(table: pa.Table) -> pa.Table:
    v = _matrix(table, "v")
    number, lows, highs = approximate(v)
    row = [table.column("block")[0].as_py(), *(_bytes(np.asarray(table.column(c), np.int64)) for c in ("id", "row")), number.tobytes(), *(_bytes(x) for x in (lows, highs, v))]
    names = [c.split()[0] for c in FILE.split(", ")]
    return pa.table({k: pa.array([x], pa.int64() if k == "block" else pa.binary()) for k, x in zip(names, row, strict=True)})


def _asked(table: pa.Table) -> pa.Table:
    return pa.table({"q_ids": pa.array([_bytes(np.asarray(table.column("id"), np.int64))], pa.binary()),
                     "q_rows": pa.array([_bytes(np.asarray(table.column("row"), np.int64))], pa.binary()),
                     "q_vectors": pa.array([_bytes(_matrix(table, "v"))], pa.binary())})


def bound(q: np.ndarray, number: np.ndarray, lows: np.ndarray, highs: np.ndarray, upper: bool) -> np.ndarray:
    """Upper or lower bounds of the scores of queries (rows) with the approximated vectors (columns)."""
    at = np.arange(number.shape[1])
    cells = np.concatenate([lows[number, at], highs[number, at]], axis=1).astype(float)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    sums = np.concatenate([minus, plus] if upper else [plus, minus], axis=1).astype(float) @ cells.T
    slack = np.outer(np.abs(q.astype(float)).sum(axis=1), np.abs(cells).max(axis=1, initial=0)) * max(1e-13, 3e-16 * cells.shape[1])  # rounding of sums beyond 2^53
    return sums + slack if upper else sums - slack


def bounds(q: np.ndarray, number: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores."""
    return bound(q, number, lows, highs, False), bound(q, number, lows, highs, True)


def _pairs(batches):
    """The pairs, each with whether its query block is another than that of the pair before."""
    rows = None
    for b in batches:
        for at in range(b.num_rows):
            r = b.slice(at, 1).to_pylist()[0]
            yield r, r["q_rows"] != rows
            rows = r["q_rows"]


def _bound_of(r: dict, q: np.ndarray, q_rows: np.ndarray, upper: bool) -> np.ndarray:
    """``bound`` of a pair; -inf where a query meets its own row."""
    d = q.shape[1]
    out = bound(q, np.frombuffer(r["cells"], np.uint8).reshape(-1, d), _ints(r["lows"]).reshape(-1, d), _ints(r["highs"]).reshape(-1, d), upper)
    _, i, j = np.intersect1d(q_rows, _ints(r["rows"]), assume_unique=True, return_indices=True)
    out[i, j] = -np.inf
    return out


def _highest(x: np.ndarray, k: int) -> np.ndarray:
    return np.partition(x, -k, axis=1)[:, -k:] if x.shape[1] > k else x


def _scan(k: int):
    def scan(batches):
        def answer():
            there = best > -np.inf
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(q_rows, best.shape[1])[there.ravel()]), pa.array(best[there])], ["q_row", "low"])

        best = None
        for r, other in _pairs(batches):
            if other:
                if best is not None:
                    yield answer()
                q_rows = _ints(r["q_rows"])
                q, best = _ints(r["q_vectors"]).reshape(len(q_rows), -1), np.empty((len(q_rows), 0))
            best = _highest(np.concatenate([best, _highest(_bound_of(r, q, q_rows, False), k)], axis=1), k)
        if best is not None:
            yield answer()

    return scan


def read_until_certain(q: np.ndarray, high: np.ndarray, bar: float, vectors: np.ndarray, ids: np.ndarray, k: int, step: int = 64) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, id) of one block, reading vectors in descending order of their upper bounds; and the number read."""
    able = np.flatnonzero((high >= bar) & (high > -np.inf))
    able = able[np.lexsort((ids[able], -high[able]))]
    best: list[tuple[int, int]] = []  # (-score, id)
    done = 0
    while done < len(able) and (len(best) < k or high[able[done]] >= -best[-1][0]):
        part = able[done:done + step]
        best = sorted(best + list(zip((-(vectors[part] @ q)).tolist(), ids[part].tolist(), strict=True)))[:k]
        done += len(part)
    return [(-s, i) for s, i in best], done


def _read(k: int):
    def read(batches):
        def answer():
            out = [(int(q_rows[i]), int(q_ids[i]), v, -s) for i, got in found.items() for s, v in got]
            return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], ["q_row", "query_id", "vec_id", "score"])

        found: dict[int, list[tuple[int, int]]] | None = None  # (-score, id) of a query
        for r, other in _pairs(batches):
            if other:
                if found is not None:
                    yield answer()
                q_ids, q_rows, found = _ints(r["q_ids"]), _ints(r["q_rows"]), {}
                q = _ints(r["q_vectors"]).reshape(len(q_rows), -1)
                known = dict(zip(_ints(r["bar_rows"]).tolist(), np.frombuffer(r["bars"], np.float64).tolist(), strict=True))
                bar = np.array([known.get(x, -np.inf) for x in q_rows.tolist()])
            high = _bound_of(r, q, q_rows, True)
            able = np.flatnonzero(high.max(axis=1, initial=-np.inf) >= bar)
            if not len(able):
                continue
            ids = _ints(r["ids"])
            vectors = _ints(r["vectors"]).reshape(len(ids), -1)
            for i in able.tolist():
                got = read_until_certain(q[i], high[i], bar[i], vectors, ids, k)[0]
                best = found[i] = sorted(found.get(i, []) + [(-s, v) for s, v in got])[:k]
                if len(best) == k:
                    bar[i] = max(bar[i], -best[-1][0])
        if found is not None:
            yield answer()

    return read


def _bars(table: pa.Table) -> pa.Table:
    return pa.table({"qb": pa.array([table.column("qb")[0].as_py()]), "bar_rows": pa.array([_bytes(np.asarray(table.column("q_row"), np.int64))], pa.binary()),
                     "bars": pa.array([np.asarray(table.column("bar"), np.float64).tobytes()], pa.binary())})


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows for each row that fulfils the condition ``is_query`` on the column ``id``."""
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    blocks, asked = -(-rows.count() // BLOCK) or 1, -(-rows.filter(is_query).count() // QUERY_BLOCK) or 1
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    spread = min(SPREAD, blocks)
    with shuffles_removed(vectors.sparkSession):
        files = frozen(rows.withColumn("block", deal(blocks)).groupBy("block").applyInArrow(_file, FILE), "va-files").withColumn("g", F.col("block") % spread)
    queries = rows.filter(is_query).withColumn("qb", deal(asked))
    packed = frozen(queries.groupBy("qb").applyInArrow(lambda key, t: _asked(t).append_column("qb", pa.array([key[0].as_py()])), f"{ASKED}, qb long"), "queries")

    def pairs(asked, blocks):
        """Each row of ``asked`` with each of ``blocks``; a broadcast of the copies would not fit the driver."""
        copies = asked.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
        return copies.repartition(spread, "g").hint("merge").join(blocks.repartition(spread, "g"), "g").drop("g")

    lows = pairs(packed.drop("qb", "q_ids"), files.select("g", "rows", "cells", "lows", "highs")).mapInArrow(_scan(k), "q_row long, low double")
    kth = lows.withColumn("r", F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("low")))).filter(F.col("r") <= k)
    bars = kth.groupBy("q_row").agg(F.when(F.count("*") == k, F.min("low")).otherwise(F.lit(float("-inf"))).alias("bar"))
    bars = bars.join(queries.select(F.col("row").alias("q_row"), "qb"), "q_row").groupBy("qb").applyInArrow(_bars, "qb long, bar_rows binary, bars binary")

    with shuffles_removed(vectors.sparkSession):
        bars = frozen(bars, "bars")

    barred = packed.join(bars, "qb").drop("qb")
    found = pairs(barred, files.drop("block")).mapInArrow(_read(k), "q_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
