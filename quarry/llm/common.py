"""Helpers that several operators of this subpackage share.

Rows are named by content or by a frozen key, never by a position that a second
scan could change: what a later step joins on is written first (``frozen``).
Internal columns live beside a ``payload`` struct with the caller's columns, so
extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import delete_path, scratch_path
from quarry.sources.tables import table


#: Rows of whole texts that Spark hands to a Python worker at a time, at most.
BATCH_ROWS = 500
#: Texts are worked on in slices of about so many bytes, whatever a batch holds.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def frozen(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage, so that a lost executor costs a re-read instead of a
    recomputation, and fixes values that a second evaluation could change.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _frozen_at[back] = path
    return back


_frozen_at: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Removes the files of frozen tables that nothing unwritten depends on any more."""
    for df in tables:
        delete_path(df.sparkSession, _frozen_at.pop(df))


def payload(df: DataFrame) -> DataFrame:
    """One struct column with all columns of ``df``.

    All operators on texts begin here, so here the session's Arrow batches are
    made small enough for whole texts.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("payload"))


def field(name: str):
    return F.col("payload")[name]


def slices(text: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    if not len(text):
        return
    size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    upto, start = np.cumsum(size), 0
    while start < len(text):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + slice_bytes, side="right")))
        yield text.slice(start, end - start)
        start = end


def text_key(text):
    """64 bits that tell apart documents of the same id; a null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def numbered(df: DataFrame, part: str, order: list[str], out: str, totals: dict | None = None) -> DataFrame:
    """Gapless numbers from 0 within each value of ``part`` (a bounded domain, such as shards).

    A window over ``part`` would put a hot value into one task.  Rows are dealt
    to blocks by a hash of the order columns, about sqrt(n) blocks of sqrt(n)
    rows for a value with n rows; numbers run inside blocks and counts of whole
    blocks are added.  ``totals`` names long columns whose running sums, without
    the row's own share, come out under the given names by the same passes.
    The order is by block, then by ``order``, which should tell rows apart.
    ``df`` must be frozen: it is read twice.
    """
    totals = totals or {}
    spark = df.sparkSession
    sizes = [(r[0], -(-r[1] // max(512, isqrt(r[1])))) for r in df.groupBy(part).count().collect()]
    schema = f"_p {df.schema[part].dataType.simpleString()}, _nb long"
    blocks = F.broadcast(spark.createDataFrame(sizes, schema))
    dealt = (df.join(blocks, F.col(part).eqNullSafe(F.col("_p")), "left")
             .withColumn("_b", F.pmod(F.xxhash64(*order), F.col("_nb"))).drop("_p", "_nb"))
    inside = Window.partitionBy(part, "_b").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_gp").orderBy("_gb").rowsBetween(Window.unboundedPreceding, -1)
    per_block = (dealt.groupBy(F.col(part).alias("_gp"), F.col("_b").alias("_gb"))
                 .agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in totals]))
    per_block = per_block.select("_gp", "_gb", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0"),
                                 *[F.coalesce(F.sum(f"_s_{c}").over(upto), F.lit(0)).alias(f"_t_{c}") for c in totals])
    rows = dealt.withColumns({"_i": F.row_number().over(inside).cast("long") - 1}
                             | {f"_r_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in totals})
    joined = rows.join(per_block, F.col(part).eqNullSafe(F.col("_gp")) & (F.col("_b") == F.col("_gb")))
    return joined.select(*df.columns, (F.col("_i") + F.col("_n0")).alias(out),
                         *[(F.col(f"_r_{c}") + F.col(f"_t_{c}")).alias(o) for c, o in totals.items()])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: ``(node, root)`` with the smallest node reachable, for every node in ``edges``.

    Rounds of contraction: each node hooks onto its smallest neighbour, chains of
    hooks are shortened by pointer jumping, and edges are rewritten to the roots;
    every node that is not yet a root disappears, so few rounds remain.  Minima
    are combined before the shuffle, so a hub with many edges costs one row per
    task.  Nothing but row counts reaches the driver.
    """
    live = frozen(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                  .filter("a < b").distinct(), "edges")
    result = None
    while True:
        both = live.select(F.col("a").alias("node"), F.col("b").alias("to")).union(live.select("b", "a"))
        hooks = frozen(both.groupBy("node").agg(F.min("to").alias("to"))
                       .select("node", F.least("node", "to").alias("root")), "hooks")
        while True:  # pointer jumping; a root points to itself
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
            hooks2 = frozen(hooks.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "jump")
            moved = not hooks2.filter("moved").isEmpty()
            hooks = hooks2.select("node", "root")
            if not moved:
                break
        if result is None:
            result = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
            result = frozen(result.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        ra, rb = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra")), hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        live = frozen(live.join(ra, "a").join(rb, "b").filter("ra != rb")
                      .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if live.isEmpty():
            return result
