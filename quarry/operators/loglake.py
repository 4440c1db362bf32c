"""Log-lake queries (schema on read): ingest, range vectors, hourly steps, templates.

Lines keep only labels and a time; every field is parsed at query time with
column expressions.  Range vectors are left-open, right-closed ``(t - r, t]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.core import log_time
from quarry.session import scratch_path

HOUR_US = 3600 * 1_000_000


def ingest(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """L1: add the line time (first matching of the six layouts); unparsable time -> null ``ts``."""
    return lines.withColumn("ts", log_time(line_col))


def dedupe(lines: DataFrame) -> DataFrame:
    """L2: identical (labels, time, line) are stored once."""
    return lines.dropDuplicates(["service", "file", "host", "ts", "line"])


def in_range(ts: Column, end: str, seconds: int) -> Column:
    """``ts`` in ``(end - r, end]``."""
    e = F.lit(end).cast("timestamp_ntz")
    return (ts > e - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))) & (ts <= e)


def hour_step(ts: Column) -> Column:
    """L4: the evaluation step a line falls in with ``(h - 1 h, h]`` buckets: ``ceil(t / 1 h)``."""
    us = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(F.ceil(us / F.lit(HOUR_US)).cast("bigint") * F.lit(HOUR_US)).cast("timestamp_ntz")


# ---------------------------------------------------------------- L11 templates
def mask_digits(line: Column) -> Column:
    """Step 1 of template mining: whitespace tokens that hold a digit become ``<*>``."""
    toks = F.split(F.trim(line), r"\s+")
    return F.array_join(F.transform(toks, lambda t: F.when(t.rlike(r"\d"), F.lit("<*>")).otherwise(t)), " ")


WILDCARD = "<*>"


def _stored(df: DataFrame) -> DataFrame:
    """Written and read again: each level is computed once, and hot nodes of the next join can be split."""
    path = scratch_path(df.sparkSession, "templates")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same_node(a: str, b: str) -> Column:
    return F.col(f"{a}.service").eqNullSafe(F.col(f"{b}.service")) & (F.col(f"{a}.n_tok") == F.col(f"{b}.n_tok")) & (F.col(f"{a}.prefix") == F.col(f"{b}.prefix"))


def placed_lines(lines: DataFrame, service_col: str = "service", line_col: str = "line", depth: int = 4, fan_out: int = 16) -> DataFrame:
    """The distinct masked lines (service, tokens, n) with the template of each, found without a parser.

    A prefix tree per (service, number of tokens): on each of the first ``depth``
    levels a node has a child per token, or, with more than ``fan_out`` different
    ones, a single wildcard child.  In a leaf, a later position on which all lines
    agree keeps its token, any other is a wildcard.  A level is a count of distinct
    tokens per node, combined before the shuffle, and a join with the wide nodes, so
    no node is ever one task.  Lines without text (null) are left out.
    """
    m = lines.filter(F.col(line_col).isNotNull()).select(F.col(service_col).alias("service"), mask_digits(F.col(line_col)).alias("masked"))
    d = m.groupBy("service", "masked").agg(F.count(F.lit(1)).alias("n")).withColumn("tokens", F.split("masked", " "))
    node = ["service", "n_tok", "prefix"]
    rows = _stored(d.select("service", F.size("tokens").alias("n_tok"), "tokens", "n", F.array().cast("array<string>").alias("prefix")))
    for level in range(depth):
        token = F.get("tokens", F.lit(level))
        children = rows.filter(F.col("n_tok") > level).select(*node, token.alias("token")).distinct()
        wide = children.groupBy(*node).agg(F.count(F.lit(1)).alias("children")).filter(F.col("children") > fan_out)
        marked = rows.alias("r").join(wide.alias("w"), _same_node("r", "w"), "left").select("r.*", "w.children")
        step = F.array(F.when(F.col("children").isNull(), token).otherwise(F.lit(WILDCARD)))
        longer = F.when(F.col("n_tok") > level, F.concat("prefix", step)).otherwise(F.col("prefix"))
        rows = _stored(marked.select("service", "n_tok", "tokens", "n", longer.alias("prefix")))
    rest = rows.filter(F.col("n_tok") > depth).select(*node, F.posexplode(F.slice("tokens", F.lit(depth + 1), F.col("n_tok"))).alias("at", "token"))
    agreed = rest.groupBy(*node, "at").agg(F.min("token").alias("low"), F.max("token").alias("high"))
    kept = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.lit(WILDCARD))
    # one entry per position of a line
    tails = agreed.groupBy(*node).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", kept.alias("token")))), lambda x: x["token"]).alias("tail"))
    out = rows.alias("r").join(tails.alias("t"), _same_node("r", "t"), "left")
    return out.select("r.service", "tokens", "n", F.concat("r.prefix", F.coalesce("tail", F.array().cast("array<string>"))).alias("template"))


def templates(lines: DataFrame, service_col: str = "service", line_col: str = "line", depth: int = 4, fan_out: int = 16) -> DataFrame:
    """The templates of each service with their numbers of lines (see :func:`placed_lines`)."""
    placed = placed_lines(lines, service_col, line_col, depth, fan_out)
    return placed.groupBy("service", F.array_join("template", " ").alias("template")).agg(F.sum("n").alias("size"))
