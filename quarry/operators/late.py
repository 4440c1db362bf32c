"""Exact late-event semantics of a tumbling-window reporter, in batch.

The reporter keeps counts per 6-hour window of event time, tracks the
latest event time seen, and after each event reports (and closes) every
window with ``window + 6 h + allowed < latest``.  An event is *late* when its
window was already reported.  Closed form (verified against the per-event
fold): an event is late iff an earlier arrival fell into the same window and
``window_end + allowed < max(event time of all earlier arrivals)``.

Both parts are skew-safe: the earliest arrival per window is an aggregate,
the running max over the arrival order uses the blockwise prefix operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import prefix_running

HOUR_US = 3600 * 1_000_000


def late_flags(df: DataFrame, ts_col: str, arrival_cols: list[str], window_h: int = 6, allowed_h: int = 2,
               n_blocks: int | None = None) -> DataFrame:
    """Add ``window_start`` (timestamp_ntz) and ``late`` to every event."""
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    w_us = F.floor(us / (window_h * HOUR_US)).cast("bigint") * (window_h * HOUR_US)
    d = df.withColumn("_t", us).withColumn("_w", w_us)
    first = d.groupBy("_w").agg(F.min(F.struct(*arrival_cols)).alias("_first"))
    r = prefix_running(d, [], arrival_cols, "_t", n_blocks)
    r = r.join(first, "_w")
    horizon = F.col("_w") + F.lit((window_h + allowed_h) * HOUR_US)
    late = (F.struct(*arrival_cols) > F.col("_first")) & F.col("_prev_max").isNotNull() & (horizon < F.col("_prev_max"))
    return (r.withColumn("late", late)
            .withColumn("window_start", F.timestamp_micros("_w").cast("timestamp_ntz"))
            .drop("_t", "_w", "_first", "_rank", "_run_max", "_prev_max"))
