"""Running values over a global (or per-key) order without a single-partition window.

A window with ``orderBy`` but no (or a low-cardinality) ``partitionBy`` puts
every row into one task.  The prefix pattern used here scales instead
(SURVEY §7.3):

1. cut the total order into contiguous ranges with ``repartitionByRange`` on all
   order columns (bounds follow the data, so an outlier or a hot value of the
   leading column leaves the other blocks as they are, and texts, fractions and
   ties sort as in the window), and write the rows with their block number: the
   bounds are sampled anew by every job, what is written stays;
2. finish the running value *inside* each (block, part) with an ordinary
   window, which is bounded by the block even for a hot key;
3. aggregate one row per (part, block) and prefix it across blocks per part
   (at most ``n_blocks`` rows per part);
4. join the block offsets back on (part, block).

Every ordering must be total (append a tie-break) so the result is
deterministic and a recomputed task after an executor loss yields the same
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def with_blocks(df: DataFrame, order_cols: list, n_blocks: int | None = None) -> DataFrame:
    """The rows with ``_blk``: the number of the range of the total order they are in, ascending.

    Without ``n_blocks`` Spark chooses the number of ranges as for any sort (shuffle
    partitions, merged by size).  Rows and numbers are written to the shared
    folder, so everything computed from them agrees, also after a lost executor.
    """
    cols = _cols(order_cols)
    ranged = df.repartitionByRange(n_blocks, *cols) if n_blocks else df.repartitionByRange(*cols)
    path = scratch_path(df.sparkSession, "blocks")
    tagged = ranged.withColumn("_blk", F.spark_partition_id())
    tagged.write.parquet(path)
    return df.sparkSession.read.schema(tagged.schema).parquet(path)


def prefix_running(df: DataFrame, part_cols: list, order_cols: list, value_col: str | None = None,
                   n_blocks: int | None = None) -> DataFrame:
    """Add ``_rank`` (1-based running count) and, if ``value_col`` is given, ``_run_max``
    (running max up to and including the row) and ``_prev_max`` (max over the rows
    strictly before it, null for the first row) within each ``part`` in ``order``.
    """
    b = with_blocks(df, order_cols, n_blocks)
    pc = list(part_cols)
    w_local = Window.partitionBy("_blk", *pc).orderBy(*_cols(order_cols))
    b = b.withColumn("_lrank", F.row_number().over(w_local))
    aggs = [F.count(F.lit(1)).alias("_bcnt")]
    if value_col:
        b = (b.withColumn("_lrun", F.max(value_col).over(w_local.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_lprev", F.max(value_col).over(w_local.rowsBetween(Window.unboundedPreceding, -1))))
        aggs.append(F.max(value_col).alias("_bmax"))
    blocks = b.groupBy(*pc, "_blk").agg(*aggs)
    w_blk = Window.partitionBy(*pc).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    off = blocks.withColumn("_off", F.coalesce(F.sum("_bcnt").over(w_blk), F.lit(0)))
    sel = [*pc, "_blk", "_off"]
    if value_col:
        off = off.withColumn("_omax", F.max("_bmax").over(w_blk))
        sel.append("_omax")
    j = b.join(off.select(*sel), [*pc, "_blk"])
    j = j.withColumn("_rank", F.col("_lrank") + F.col("_off"))
    drop = ["_lrank", "_off", "_blk"]
    if value_col:
        j = (j.withColumn("_run_max", F.greatest("_lrun", "_omax"))
             .withColumn("_prev_max", F.greatest("_lprev", "_omax")))
        drop += ["_lrun", "_lprev", "_omax"]
    return j.drop(*drop)


def global_row_number(df: DataFrame, order_cols: list, n_blocks: int | None = None,
                      name: str = "row_no") -> DataFrame:
    """Dense 1-based number of every row in a total order, computed blockwise."""
    return prefix_running(df, [], order_cols, None, n_blocks).withColumnRenamed("_rank", name)


def count_decreases(df: DataFrame, order_cols: list, value_col: str, part_cols: list | None = None,
                    n_blocks: int | None = None) -> DataFrame:
    """Number of rows whose ``value_col`` is below the previous row's (Q7), per part.

    The previous row is found with ``lag`` inside a block, and across a block
    boundary by joining each block's first row to the previous block's last.
    """
    pc = list(part_cols or [])
    b = with_blocks(df, order_cols, n_blocks)
    w = Window.partitionBy("_blk", *pc).orderBy(*_cols(order_cols))
    inner = b.withColumn("_prev", F.lag(value_col).over(w)).filter(F.col(value_col) < F.col("_prev"))
    inner = inner.groupBy(*pc).agg(F.count(F.lit(1)).alias("_n"))
    ocols = [c if isinstance(c, str) else None for c in order_cols]
    if None in ocols:
        raise ValueError("order_cols must be column names")
    order_struct = F.struct(*[F.col(c) for c in ocols])
    ends = b.groupBy(*pc, "_blk").agg(F.min_by(value_col, order_struct).alias("_first"),
                                     F.max_by(value_col, order_struct).alias("_last"))
    nxt = ends.select(*pc, F.col("_blk").alias("_pblk"), F.col("_last").alias("_plast"))
    # the previous non-empty block of the same part
    w_blk = Window.partitionBy(*pc).orderBy("_blk")
    ends = ends.withColumn("_pblk", F.lag("_blk").over(w_blk))
    bound = (ends.join(nxt, [*pc, "_pblk"]).filter(F.col("_first") < F.col("_plast"))
             .groupBy(*pc).agg(F.count(F.lit(1)).alias("_n")))
    both = inner.unionByName(bound)
    parts = b.select(*pc).distinct() if pc else b.sparkSession.range(1).select()
    res = both.groupBy(*pc).agg(F.sum("_n").alias("_n"))
    if pc:
        out = parts.join(res, pc, "left")
    else:
        out = res.select("_n").unionByName(b.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("_n")))
        out = out.agg(F.sum("_n").alias("_n"))
    return out.select(*pc, F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("decreases"))


def running_last(df: DataFrame, part_cols: list, order_cols: list, value_cols: list[str],
                 n_blocks: int | None = None, exclusive: bool = False, suffix: str = "_last") -> DataFrame:
    """Add ``<c><suffix>``: the last non-null value of ``c`` up to the row (``exclusive``: strictly
    before it) within each part in order.  "Last non-null" is associative, so it is
    finished inside (block, part) windows and carried across blocks by a prefix over
    the one-row-per-(part, block) summary; a hot part is spread over many blocks.
    """
    pc = list(part_cols)
    b = with_blocks(df, order_cols, n_blocks)
    w_local = Window.partitionBy("_blk", *pc).orderBy(*_cols(order_cols))
    frame = w_local.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    ocols = [c for c in order_cols if isinstance(c, str)]
    if len(ocols) != len(order_cols):
        raise ValueError("order_cols must be column names")
    ostruct = F.struct(*[F.col(c) for c in ocols])
    for c in value_cols:
        b = b.withColumn(f"_l_{c}", F.last(c, ignorenulls=True).over(frame))
    summ = b.groupBy(*pc, "_blk").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ostruct)).alias(f"_b_{c}") for c in value_cols])
    w_blk = Window.partitionBy(*pc).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    for c in value_cols:
        summ = summ.withColumn(f"_o_{c}", F.last(f"_b_{c}", ignorenulls=True).over(w_blk))
    j = b.join(summ.select(*pc, "_blk", *[f"_o_{c}" for c in value_cols]), [*pc, "_blk"])
    for c in value_cols:
        j = j.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_l_{c}"), F.col(f"_o_{c}")))
    return j.drop("_blk", *[f"_l_{c}" for c in value_cols], *[f"_o_{c}" for c in value_cols])


def running_sum(df: DataFrame, part_cols: list, order_cols: list, value_col: str, n_blocks: int | None = None,
                name: str = "_run_sum") -> DataFrame:
    """Add ``name``: running sum of ``value_col`` up to and including the row, per part in order."""
    return running_sums(df, part_cols, order_cols, [value_col], n_blocks, "_lsum").withColumnRenamed(f"{value_col}_lsum", name)


def running_sums(df: DataFrame, part_cols: list, order_cols: list, value_cols: list[str], n_blocks: int | None = None,
                 suffix: str = "_run") -> DataFrame:
    """Add ``<c><suffix>``: running sum of each of ``value_cols`` up to and including the row, per part in order."""
    pc = list(part_cols)
    b = with_blocks(df, order_cols, n_blocks)
    w_local = Window.partitionBy("_blk", *pc).orderBy(*_cols(order_cols)).rowsBetween(Window.unboundedPreceding, 0)
    blocks = b.groupBy(*pc, "_blk").agg(*[F.sum(c).alias(f"_b_{c}") for c in value_cols])
    b = b.withColumns({f"_l_{c}": F.sum(c).over(w_local) for c in value_cols})
    w_blk = Window.partitionBy(*pc).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    off = blocks.select(*pc, "_blk", *[F.coalesce(F.sum(f"_b_{c}").over(w_blk), F.lit(0)).alias(f"_o_{c}") for c in value_cols])
    j = b.join(off, [*pc, "_blk"])
    return j.withColumns({f"{c}{suffix}": F.col(f"_l_{c}") + F.col(f"_o_{c}") for c in value_cols}).drop("_blk", *[f"{x}_{c}" for x in ("_l", "_o") for c in value_cols])


def count_in_range(df: DataFrame, part_cols: list, ts_col: str, id_col: str, width: int,
                   name: str = "in_range") -> DataFrame:
    """Rows of the same part with integer ``ts`` in ``(t - width, t]`` for every row (a range frame).

    A row's frame reaches back less than one time bucket of ``width``, so each row
    is also copied to the next bucket and the window runs per (part, bucket): one
    shuffle, and a hot part is spread over its buckets.
    """
    own = F.floor(F.col(ts_col) / F.lit(width))
    both = df.withColumn("_own", own).withColumn("_bucket", F.explode(F.array(own, own + 1)))
    w = Window.partitionBy(*part_cols, "_bucket").orderBy(ts_col).rangeBetween(-(width - 1), 0)
    return (both.withColumn(name, F.count(F.lit(1)).over(w)).filter(F.col("_own") == F.col("_bucket"))
            .drop("_own", "_bucket"))
