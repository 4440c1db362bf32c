"""Join of intervals that overlap, both sides large, by time buckets.

Each interval is copied to every time bucket it touches; the join is an equi
join on the bucket, and a pair that meets in several buckets is kept in the one
where the later of the two begins.  A bucket with over ``limit`` left rows is
split: its left rows are dealt to parts by a hash, its right rows go to all of
them.  Neither side is broadcast by wish; the counts of buckets are a table of
their own.

Ends are closed; an event is an interval that ends where it starts.  Rows
without start or end, or with an end before the start, meet nothing.

Where only sums over the pairs of a right row are wanted (``totals``), no pair
is made: what meets a right row has started by its end and not ended before its
start, so its sums are differences of two running sums along the time axis.  The
work grows with the rows, however many of them overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import running_sums


def overlaps(left: DataFrame, right: DataFrame, width: int, on: tuple[str, str, str, str] = ("l_start", "l_end", "r_start", "r_end"), limit: int = 100_000,
             totals: dict[str, Column] | None = None) -> DataFrame:
    """All pairs of ``left`` and ``right`` rows whose intervals (integer columns ``on``) share a point.

    ``width`` of a bucket, best about the usual length of an interval: longer ones are copied more often.
    With ``totals`` (integer expressions on left rows): each distinct right row that meets something, and the sums
    over all its pairs, those of repeated rows included.
    """
    if totals is not None:
        return _totals(left, right, on, totals)
    ls, le, rs, re = on
    bucket = lambda c: F.expr(f"floor(`{c}` / {width})") if isinstance(c, str) else c

    def dealt(df: DataFrame, start: str, end: str) -> DataFrame:
        return df.filter(F.col(start) <= F.col(end)).withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))

    a, b = dealt(left, ls, le), dealt(right, rs, re)
    counts = a.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("_parts")).filter("_parts > 1")
    spread = F.pmod(F.xxhash64(*left.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    a = a.join(counts, "_bucket", "left").withColumn("_part", spread).drop("_parts")
    b = b.join(counts, "_bucket", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    met = a.join(b, ["_bucket", "_part"]).filter((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)))
    later = F.expr(f"floor(greatest(`{ls}`, `{rs}`) / {width})")
    return met.filter(F.col("_bucket") == later).drop("_bucket", "_part")


def _totals(left: DataFrame, right: DataFrame, on: tuple[str, str, str, str], totals: dict[str, Column]) -> DataFrame:
    ls, le, rs, re = on
    values = {"_n": F.lit(1)} | {f"_v{k}": v for k, v in enumerate(totals.values())}
    begun, ended = [f"{v}_in" for v in values], [f"{v}_out" for v in values]
    rows = left.filter(F.col(ls) <= F.col(le)).select(F.col(ls).alias("_ls"), F.col(le).alias("_le"), *[F.coalesce(v.cast("bigint"), F.lit(0).cast("bigint")).alias(n) for n, v in values.items()])
    zero, of = [F.lit(0).cast("bigint")] * len(values), [F.col(v) for v in values]
    mark = lambda at, x, y: F.struct(F.col(at).cast("bigint").alias("_at"), *[c.alias(n) for c, n in zip([*x, *y], [*begun, *ended], strict=True)])
    # one mark for each time of the left side: what begins and what ends there
    steps = rows.select(F.inline(F.array(mark("_ls", of, zero), mark("_le", zero, of)))).groupBy("_at").agg(*[F.sum(c).alias(c) for c in [*begun, *ended]])
    asked = right.filter(F.col(rs) <= F.col(re)).groupBy(*right.columns).agg(F.count(F.lit(1)).alias("_copies"))
    ask = lambda at, turn: F.struct(F.col(at).cast("bigint").alias("_at"), F.lit(turn).alias("_turn"))
    asked = asked.select(F.struct(*right.columns, "_copies").alias("_right"), F.inline(F.array(ask(rs, 0), ask(re, 2))))
    # at the same time: right starts ask before what ends there is counted, right ends after what begins there is
    marks = steps.withColumn("_turn", F.lit(1)).unionByName(asked, allowMissingColumns=True).fillna(0, [*begun, *ended]).withColumn("_tie", F.xxhash64("_right"))
    run = running_sums(marks, [], ["_at", "_turn", "_tie"], [*begun, *ended], suffix="_run").filter("_turn != 1")
    parts = [F.sum(F.when(F.col("_turn") == 2, F.col(f"{b}_run")).otherwise(-F.col(f"{e}_run"))).alias(v) for v, b, e in zip(values, begun, ended, strict=True)]
    met = run.groupBy("_right").agg(*parts).filter("_n > 0")
    return met.select("_right.*", *[(F.col(v) * F.col("_right._copies")).alias(t) for v, t in zip(list(values)[1:], totals, strict=True)]).drop("_copies")
