"""D3: deterministic "model" stages with a seed per key (object and friend detectors).

Each true label is kept when a keyed hash draw ``h(key|label) / 2^32`` is
below ``p_keep``; with probability ``p_extra`` (draw on ``h(key|+)``) one
label picked from a vocabulary is added.  Draws depend only on the key, so
the same message processed twice gives the same answer, and the result can
be recomputed independently in SQL (the oracle uses the same hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.core import stable_hash
from quarry.operators.ordering import global_row_number

TWO32 = float(1 << 32)


def draw(key: Column, salt: Column | str) -> Column:
    s = F.lit(salt) if isinstance(salt, str) else salt
    return stable_hash(F.concat(key.cast("string"), F.lit("|"), s)) / F.lit(TWO32)


def vocabulary(words: DataFrame, col: str = "word") -> DataFrame:
    """Sorted distinct vocabulary with a 0-based index (numbered blockwise)."""
    d = words.select(F.col(col).alias("word")).distinct()
    return global_row_number(d, ["word"], name="_no").select("word", (F.col("_no") - 1).cast("bigint").alias("idx"))


def detect(df: DataFrame, key_col: str, labels_col: str, vocab: DataFrame, p_keep: float, p_extra: float,
           out_col: str = "found") -> DataFrame:
    """Keep each label with ``p_keep``; add a vocabulary label with ``p_extra``."""
    key = F.col(key_col)
    kept = F.filter(labels_col, lambda l: draw(key, l) < F.lit(p_keep))
    size = vocab.agg(F.count(F.lit(1)).alias("_vsize"))
    d = (df.withColumn("_kept", kept).crossJoin(F.broadcast(size))
         .withColumn("_pick", F.when(draw(key, "+") < F.lit(p_extra), stable_hash(F.concat(key.cast("string"), F.lit("|pick")))
                                     % F.col("_vsize"))))
    v = vocab.select(F.col("idx").alias("_pick"), F.col("word").alias("_extra"))
    j = d.join(v, "_pick", "left")
    found = F.when(F.col("_extra").isNotNull(), F.concat("_kept", F.array("_extra"))).otherwise(F.col("_kept"))
    return j.withColumn(out_col, found).drop("_kept", "_vsize", "_pick", "_extra")
