"""SURVEY §2.11 partitioning analytics (H1-H7) with A5, A6, A10-A12, A20, J10 and W7.

Photos = orders (owner o_custkey, date o_orderdate); 4 nodes, a fifth added.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import month_text, stable_hash
from quarry.operators.partitioning import month_range_nodes, ring_node
from quarry.plans.registry import register
from quarry.plans.sqlx import h
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.tables import Tables

NODES = 4
LAST_WEEK = "2001-07-25 00:00:00"
STRATEGIES = ["user_hash", "month_range", "id_hash"]


def assign_nodes(spark, sf):
    """Each order with its node under the three strategies (columns n_user, n_month, n_id)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    o = o.withColumn("month", month_text("o_orderdate"))
    mn = month_range_nodes(o.select("month"), "month", NODES).withColumnRenamed("node", "n_month")
    return (o.join(mn, "month")
            .withColumn("n_user", (stable_hash("o_custkey") % NODES).cast("int"))
            .withColumn("n_id", (stable_hash("o_orderkey") % NODES).cast("int")))


def node_counts(spark, sf):
    """Photos per (strategy, what, node); empty nodes shown as 0."""
    a = assign_nodes(spark, sf)
    last = F.col("o_orderdate") >= F.lit(LAST_WEEK).cast("timestamp_ntz")
    long = a.select(F.explode(F.array(
        F.struct(F.lit(STRATEGIES[0]).alias("strategy"), F.col("n_user").alias("node")),
        F.struct(F.lit(STRATEGIES[1]).alias("strategy"), F.col("n_month").alias("node")),
        F.struct(F.lit(STRATEGIES[2]).alias("strategy"), F.col("n_id").alias("node")))).alias("s"), last.alias("lw"))
    long = long.select("s.strategy", "s.node", "lw")
    whats = long.select(F.explode(F.when(F.col("lw"), F.array(F.lit("everything"), F.lit("recent")))
                                  .otherwise(F.array(F.lit("everything")))).alias("what"), "strategy", "node")
    counts = whats.groupBy("strategy", "what", "node").agg(F.count(F.lit(1)).alias("photos"))
    # the (strategy, what, node) grid has 3 x 2 x NODES rows: empty nodes appear with 0
    grid = (spark.range(NODES).select(F.col("id").cast("int").alias("node"))
            .crossJoin(spark.createDataFrame([(s,) for s in STRATEGIES], "strategy string"))
            .crossJoin(spark.createDataFrame([("everything",), ("recent",)], "what string")))
    return (grid.join(counts, ["strategy", "what", "node"], "left")
            .select("strategy", "what", F.concat(F.lit("n"), (F.col("node") + 1).cast("string")).alias("node"),
                    F.coalesce("photos", F.lit(0).cast("bigint")).alias("photos")))


NODES_SQL = f"""
months AS (SELECT month, row_number() OVER (ORDER BY month) AS rn FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders)),
mn AS (SELECT month, CAST(ntile({NODES}) OVER (ORDER BY month) - 1 AS INTEGER) AS n_month FROM months WHERE rn <= 6
       UNION ALL SELECT month, {NODES - 1} FROM months WHERE rn > 6),
a AS (SELECT o_orderkey, o_custkey, o_orderdate, strftime(o_orderdate, '%Y-%m') AS month, n_month,
             CAST({h('o_custkey')} % {NODES} AS INTEGER) AS n_user, CAST({h('o_orderkey')} % {NODES} AS INTEGER) AS n_id
      FROM orders JOIN mn ON strftime(o_orderdate, '%Y-%m') = mn.month),
long AS (SELECT '{STRATEGIES[0]}' AS strategy, n_user AS node, o_orderdate FROM a
         UNION ALL SELECT '{STRATEGIES[1]}', n_month, o_orderdate FROM a
         UNION ALL SELECT '{STRATEGIES[2]}', n_id, o_orderdate FROM a),
whats AS (SELECT strategy, node, 'everything' AS what FROM long
          UNION ALL SELECT strategy, node, 'recent' FROM long WHERE o_orderdate >= TIMESTAMP '{LAST_WEEK}'),
grid AS (SELECT CAST(n AS INTEGER) AS node, s AS strategy, w AS what FROM range({NODES}) t(n),
         (VALUES ('{STRATEGIES[0]}'), ('{STRATEGIES[1]}'), ('{STRATEGIES[2]}')) s(s),
         (VALUES ('everything'), ('recent')) w(w)),
counts AS (SELECT g.strategy, g.what, 'n' || CAST(g.node + 1 AS VARCHAR) AS node,
           (SELECT count(*) FROM whats x WHERE x.strategy = g.strategy AND x.what = g.what AND x.node = g.node) AS photos
           FROM grid g)"""


@register("H1_rows_per_node_by_strategy", f"WITH {NODES_SQL} SELECT * FROM counts")
def h1(spark, sf):
    """Rows per node for hash of user, month ranges and hash of id; all rows and the last week."""
    return node_counts(spark, sf)


@register("A6_count_per_node_zero_fill", f"""
WITH {NODES_SQL} SELECT node, photos FROM counts WHERE strategy = '{STRATEGIES[1]}' AND what = 'recent'""")
def a6(spark, sf):
    """Count per node with empty nodes shown as 0 (month ranges, last week: one hot node)."""
    c = node_counts(spark, sf)
    return c.filter((F.col("strategy") == STRATEGIES[1]) & (F.col("what") == "recent")).select(
        "node", "photos")


@register("A20_unpivot_strategies", f"""
WITH {NODES_SQL} SELECT strategy, what, count(*) AS nodes, CAST(sum(photos) AS BIGINT) AS photos FROM counts GROUP BY 1, 2""")
def a20(spark, sf):
    """Unpivot of masks x strategies into long rows (checked via their totals)."""
    return node_counts(spark, sf).groupBy("strategy", "what").agg(
        F.count(F.lit(1)).alias("nodes"), F.sum("photos").alias("photos"))


@register("A5_skew_summary", f"""
WITH {NODES_SQL}
SELECT what, strategy, max(photos) AS max, avg(photos) AS mean,
       round(100.0 * max(photos) / avg(photos)) / 100.0 AS largest_over_mean
FROM counts GROUP BY 1, 2""")
def a5(spark, sf):
    """Skew summary per strategy: max, mean and largest / mean rounded to 2."""
    c = node_counts(spark, sf)
    return c.groupBy("what", "strategy").agg(F.max("photos").alias("max"), F.avg("photos").alias("mean"),
                                             (F.round(F.lit(100.0) * F.max("photos") / F.avg("photos"), 0) / 100.0)
                                             .alias("largest_over_mean"))


Q_USER, Q_DAY, Q_PHOTO = 7, "1997-05-28", 42


@register("A10_fan_out_per_query", f"""
WITH {NODES_SQL},
q AS (SELECT 'user {Q_USER}' AS query, * FROM a WHERE o_custkey = {Q_USER}
      UNION ALL SELECT 'day {Q_DAY}', * FROM a WHERE strftime(o_orderdate, '%Y-%m-%d') = '{Q_DAY}'
      UNION ALL SELECT 'photo {Q_PHOTO}', * FROM a WHERE o_orderkey = {Q_PHOTO})
SELECT query, count(DISTINCT n_user) AS by_user, count(DISTINCT n_month) AS by_month, count(DISTINCT n_id) AS by_id
FROM q GROUP BY query""")
def a10(spark, sf):
    """Fan-out: number of distinct nodes each query must ask, per strategy."""
    a = assign_nodes(spark, sf)
    q = F.explode(F.array(
        F.when(F.col("o_custkey") == Q_USER, F.lit(f"user {Q_USER}")),
        F.when(F.date_format("o_orderdate", "yyyy-MM-dd") == Q_DAY, F.lit(f"day {Q_DAY}")),
        F.when(F.col("o_orderkey") == Q_PHOTO, F.lit(f"photo {Q_PHOTO}"))))
    x = a.select(q.alias("query"), "n_user", "n_month", "n_id").filter(F.col("query").isNotNull())
    return x.groupBy("query").agg(F.countDistinct("n_user").alias("by_user"),
                                  F.countDistinct("n_month").alias("by_month"),
                                  F.countDistinct("n_id").alias("by_id"))


@register("W7_month_ranges_to_nodes", f"WITH {NODES_SQL} SELECT month, n_month AS node FROM mn")
def w7(spark, sf):
    """Equal-size ranges of the first 6 sorted months -> node; later months to the last node."""
    o = Tables(spark, sf).orders.select(month_text("o_orderdate").alias("month"))
    return month_range_nodes(o, "month", NODES)


def ring_sql(nodes: int, alias: str) -> str:
    pts = f"""pts{nodes} AS (SELECT {h("'node' || CAST(n AS VARCHAR) || '-' || CAST(i AS VARCHAR)")} AS point, CAST(n AS INTEGER) AS node
        FROM range({nodes}) t(n), range(100) u(i))"""
    own = f"""{alias} AS (SELECT k.o_orderkey, coalesce(
          (SELECT arg_min(p.node, p.point * 8 + p.node) FROM pts{nodes} p WHERE p.point > k.h),
          (SELECT arg_min(p.node, p.point * 8 + p.node) FROM pts{nodes} p)) AS node FROM keys k)"""
    return pts + ",\n" + own


KEYS_SQL = f"keys AS (SELECT o_orderkey, {h('o_orderkey')} AS h FROM orders)"


@register("J10_ring_range_join", f"""
WITH {KEYS_SQL}, {ring_sql(NODES, 'r4')} SELECT o_orderkey, node FROM r4""")
def j10(spark, sf):
    """Range join of key hashes to the next ring point (bisect_right) with wrap-around."""
    o = Tables(spark, sf).orders.select("o_orderkey")
    return ring_node(o, "o_orderkey", NODES)


@register("H2_ring_counts_per_node", f"""
WITH {KEYS_SQL}, {ring_sql(NODES, 'r4')} SELECT node, count(*) AS photos FROM r4 GROUP BY node""")
def h2(spark, sf):
    """Consistent-hash ring with 100 points per node: keys per node."""
    o = Tables(spark, sf).orders.select("o_orderkey")
    return ring_node(o, "o_orderkey", NODES).groupBy("node").agg(F.count(F.lit(1)).alias("photos"))


@register("H3_moves_when_node_added", f"""
WITH {KEYS_SQL}, {ring_sql(NODES, 'r4')}, {ring_sql(NODES + 1, 'r5')},
j AS (SELECT k.o_orderkey, k.h, r4.node AS before, r5.node AS after FROM keys k JOIN r4 USING (o_orderkey) JOIN r5 USING (o_orderkey)),
m AS (SELECT 'hash % nodes' AS method,
        round(100.0 * count(*) FILTER (WHERE h % {NODES} <> h % {NODES + 1}) / count(*)) / 100.0 AS moved_share,
        count(*) FILTER (WHERE h % {NODES} <> h % {NODES + 1} AND h % {NODES + 1} <> {NODES}) AS moved_elsewhere FROM j
      UNION ALL SELECT 'consistent hashing',
        round(100.0 * count(*) FILTER (WHERE before <> after) / count(*)) / 100.0,
        count(*) FILTER (WHERE before <> after AND after <> {NODES}) FROM j),
c AS (SELECT 'hash % nodes' AS method, list_sort(list(n)) AS counts_after FROM (SELECT count(*) AS n FROM j GROUP BY h % {NODES + 1})
      UNION ALL SELECT 'consistent hashing', list_sort(list(n)) FROM (SELECT count(*) AS n FROM j GROUP BY after))
SELECT * FROM m JOIN c USING (method)""")
def h3(spark, sf):
    """A fifth node: share of keys that move (modulo vs ring), sorted counts after, moves not to the new node."""
    o = Tables(spark, sf).orders.select("o_orderkey").withColumn("h", stable_hash("o_orderkey"))
    r = ring_node(ring_node(o, "o_orderkey", NODES, name="before"), "o_orderkey", NODES + 1, name="after")
    mod_b, mod_a = F.col("h") % NODES, F.col("h") % (NODES + 1)
    m1 = r.agg(F.lit("hash % nodes").alias("method"),
               (F.round(F.lit(100.0) * F.count_if(mod_b != mod_a) / F.count(F.lit(1)), 0) / 100.0).alias("moved_share"),
               F.count_if((mod_b != mod_a) & (mod_a != NODES)).alias("moved_elsewhere"))
    m2 = r.agg(F.lit("consistent hashing").alias("method"),
               (F.round(F.lit(100.0) * F.count_if(F.col("before") != F.col("after")) / F.count(F.lit(1)), 0) / 100.0)
               .alias("moved_share"),
               F.count_if((F.col("before") != F.col("after")) & (F.col("after") != NODES)).alias("moved_elsewhere"))
    c1 = r.groupBy(mod_a).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sort_array(F.collect_list("n")).alias("counts_after")).select(F.lit("hash % nodes").alias("method"), "*")
    c2 = r.groupBy("after").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sort_array(F.collect_list("n")).alias("counts_after")).select(F.lit("consistent hashing").alias("method"), "*")
    return m1.unionByName(m2).join(c1.unionByName(c2), "method")


@register("A11_share_of_keys_moving", f"""
WITH {KEYS_SQL} SELECT avg(CAST(h % {NODES} <> h % {NODES + 1} AS DOUBLE)) AS moved FROM keys""")
def a11(spark, sf):
    """Fraction of keys whose node changes under modulo placement when a node is added."""
    o = Tables(spark, sf).orders.select(stable_hash("o_orderkey").alias("h"))
    return o.agg(F.avg(((F.col("h") % NODES) != (F.col("h") % (NODES + 1))).cast("double")).alias("moved"))


@register("A12_sorted_bucket_counts", f"""
WITH {KEYS_SQL} SELECT list_sort(list(n)) AS counts FROM (SELECT count(*) AS n FROM keys GROUP BY h % {NODES + 1})""")
def a12(spark, sf):
    """Sorted array of bucket counts (hash % 5)."""
    o = Tables(spark, sf).orders.select(stable_hash("o_orderkey").alias("h"))
    return o.groupBy(F.col("h") % (NODES + 1)).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sort_array(F.collect_list("n")).alias("counts"))


@register("H4_partition_pruning_report", f"""
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (WHERE strftime(o_orderdate, '%Y-%m-%d') = '{Q_DAY}') AS hits FROM orders GROUP BY 1)
SELECT 'day and month' AS predicate, count(*) FILTER (WHERE month = '{Q_DAY[:7]}') AS files_read,
       CAST(sum(hits) AS BIGINT) AS rows, count(*) AS files_total FROM m
UNION ALL SELECT 'day only', count(*), CAST(sum(hits) AS BIGINT), count(*) FROM m""")
def h4(spark, sf):
    """Files read with and without a partition predicate on month folders; same rows found.

    Files read = data files of the partitions that survive pruning; the day
    predicate alone cannot prune, so every file is opened.  Rows are dealt by
    month before the write, so each month is one file here.
    """
    o = Tables(spark, sf).orders.withColumn("month", month_text("o_orderdate"))
    path = scratch_path(spark, "h4")
    files.write_parquet(o.repartition("month"), path, ["month"])
    lake = spark.read.parquet(path)
    day = F.date_format("o_orderdate", "yyyy-MM-dd") == Q_DAY
    fp = F.col("_metadata.file_path")
    total = lake.select(fp.alias("f")).distinct().agg(F.count(F.lit(1)).alias("files_total"))
    pruned = lake.filter(F.col("month") == Q_DAY[:7])
    with_p = pruned.agg(F.countDistinct(fp).alias("files_read"), F.count_if(day).alias("rows"))
    without = lake.agg(F.countDistinct(fp).alias("files_read"), F.count_if(day).alias("rows"))
    return (with_p.select(F.lit("day and month").alias("predicate"), "*")
            .unionByName(without.select(F.lit("day only").alias("predicate"), "*")).crossJoin(total))


@register("H5_vertical_partition_sizes", """
SELECT 'key, owner, status' AS part, CAST(sum(strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus))) AS BIGINT) AS bytes FROM orders
UNION ALL SELECT 'key, priority, date', CAST(sum(strlen(concat_ws(',', o_orderkey, o_orderpriority, o_orderdate))) AS BIGINT) FROM orders""")
def h5(spark, sf):
    """Text size of two column subsets (vertical partitions) of the same rows."""
    o = Tables(spark, sf).orders
    a = o.agg(F.sum(F.octet_length(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"))).alias("bytes"))
    b = o.agg(F.sum(F.octet_length(F.concat_ws(",", "o_orderkey", "o_orderpriority",
                                               F.col("o_orderdate").cast("string")))).alias("bytes"))
    return (a.select(F.lit("key, owner, status").alias("part"), "bytes")
            .unionByName(b.select(F.lit("key, priority, date").alias("part"), "bytes")))


@register("H6_blocks_per_file")
def h6(spark, sf):
    """Block placement: read splits (blocks) per input file and rows per file (rows-only)."""
    li = Tables(spark, sf).lineitem
    return li.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.countDistinct(F.col("_metadata.file_block_start")).alias("blocks"),
        F.max(F.col("_metadata.file_size")).alias("file_bytes"), F.count(F.lit(1)).alias("rows"))


@register("H7_shuffle_records_with_combiner")
def h7(spark, sf):
    """Map output records with and without a combiner: rows vs distinct (map task, key) pairs."""
    from quarry.sources.derived import events_x
    ex = events_x(Tables(spark, sf).events).filter("is_view").select("path", F.spark_partition_id().alias("task"))
    return ex.agg(F.count(F.lit(1)).alias("map_output_records"),
                  F.count_distinct("task", "path").alias("after_combiner"),
                  F.count_distinct("path").alias("reduce_groups"))
