"""SURVEY §2.2 schema, constraints and data quality (Q1-Q14).

Spark does not enforce keys or types, so each constraint is an aggregate
query that counts its violations; bad rows are split off (quarantine)
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.core import n_fields, parse_access
from quarry.operators.audit import AuditedLog
from quarry.operators.documents import photo_documents
from quarry.operators.ordering import count_decreases
from quarry.plans.registry import register
from quarry.plans.sqlx import ARRIVAL, EX, h
from quarry.session import scratch_path
from quarry.sources.derived import access_lines, arrival_key, events_x, lake_lines, redelivered
from quarry.sources.tables import Tables


@register("Q1_key_uniqueness_not_null", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT (SELECT count(*) FROM g WHERE n > 1) AS dup_keys,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM g WHERE n > 1) AS dup_rows,
       (SELECT count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem) AS null_orderkey,
       (SELECT count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem) AS null_linenumber""")
def q1(spark, sf):
    """Primary-key check on (l_orderkey, l_linenumber): duplicate keys/rows and NULLs."""
    li = Tables(spark, sf).lineitem
    g = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dups = g.agg(F.count(F.lit(1)).alias("dup_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("dup_rows"))
    nulls = li.agg(F.count_if(F.col("l_orderkey").isNull()).alias("null_orderkey"),
                   F.count_if(F.col("l_linenumber").isNull()).alias("null_linenumber"))
    return dups.crossJoin(nulls)


@register("Q2_referential_integrity", """
SELECT 'orders.o_custkey' AS fk, count(*) AS missing FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT 'lineitem.l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'lineitem.l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""")
def q2(spark, sf):
    """Referential integrity: child keys missing in the parent, per foreign key."""
    t = Tables(spark, sf)

    def missing(child, ck, parent, pk, name):
        return (child.select(F.col(ck).alias("_k")).join(parent.select(F.col(pk).alias("_k")), "_k", "left_anti")
                .agg(F.count(F.lit(1)).alias("missing")).select(F.lit(name).alias("fk"), "missing"))

    return (missing(t.orders, "o_custkey", t.customer, "c_custkey", "orders.o_custkey")
            .unionByName(missing(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "lineitem.l_orderkey"))
            .unionByName(missing(t.lineitem, "l_partkey", t.part, "p_partkey", "lineitem.l_partkey")))


def size_text(orders):
    """Sizes as text the way a loose source sends them: every 50th as ``'<x> MB'``."""
    return orders.select("o_orderkey", F.when(
        F.col("o_orderkey") % 50 == 0,
        F.concat((F.round(F.col("o_totalprice") / 100000, 1)).cast("string"), F.lit(" MB")))
        .otherwise(F.col("o_totalprice").cast("string")).alias("size"))


@register("Q3_type_check_quarantine", """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'rejected' ELSE 'accepted' END AS outcome, count(*) AS n
FROM orders GROUP BY 1""")
def q3(spark, sf):
    """Type check at write: text that is not a number (``'5.7 MB'``) goes to quarantine."""
    s = size_text(Tables(spark, sf).orders)
    bad = F.col("size").isNotNull() & F.col("size").try_cast("double").isNull()
    return s.groupBy(F.when(bad, "rejected").otherwise("accepted").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


VALIDATOR_FROM_SEQ = 5000


@register("Q4_optional_validator", f"""
WITH docs AS (
  SELECT event_id AS seq, TRUE AS ok FROM events
  UNION ALL SELECT 100000000 + o_orderkey, o_orderkey % 5 = 0 FROM orders
  UNION ALL SELECT o_orderkey, FALSE FROM orders WHERE o_orderkey % 7 = 0)
SELECT CASE WHEN seq >= {VALIDATOR_FROM_SEQ} THEN 'after' ELSE 'before' END AS phase,
       CASE WHEN seq < {VALIDATOR_FROM_SEQ} OR ok THEN 'accepted' ELSE 'rejected' END AS outcome, count(*) AS n
FROM docs GROUP BY 1, 2""")
def q4(spark, sf):
    """Optional schema validator: ``path`` and ``size`` required, ``size`` a number with a fraction (double);
    enforced only from a sequence on, documents written before stay accepted.

    Event documents are right; order documents are right, hold text as size, an
    integer, a null, or no path, by order key.
    """
    t = Tables(spark, sf)
    text = lambda *cols: F.to_json(F.struct(*cols))
    path = F.lit("/st/x/1.jpg").alias("path")
    ev = t.events.select(F.col("event_id").alias("seq"), text(path, (F.col("event_id") + 0.5).alias("size")).alias("doc"))
    k = F.col("o_orderkey")
    doc = (F.when(k % 5 == 0, text(path, (k + 0.25).alias("size"))).when(k % 5 == 1, text(path, F.lit("5.7 MB").alias("size")))
           .when(k % 5 == 2, text(path, k.alias("size"))).when(k % 5 == 3, text(path)).otherwise(text((k + 0.25).alias("size"))))
    late = t.orders.select((k + 100_000_000).alias("seq"), doc.alias("doc"))
    early = t.orders.filter(k % 7 == 0).select(k.alias("seq"), text(path, F.lit("5.7 MB").alias("size")).alias("doc"))
    v = F.try_parse_json("doc")
    parsed = ev.unionByName(late).unionByName(early).withColumns({
        "path": F.try_variant_get(v, "$.path", "string"), "kind": F.schema_of_variant(F.try_variant_get(v, "$.size", "variant"))})
    ok = F.col("path").isNotNull() & F.coalesce(F.col("kind").rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit(False))
    phase = F.when(F.col("seq") >= VALIDATOR_FROM_SEQ, "after").otherwise("before")
    outcome = F.when((F.col("seq") < VALIDATOR_FROM_SEQ) | ok, "accepted").otherwise("rejected")
    return parsed.groupBy(phase.alias("phase"), outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@register("Q5_accept_reject_per_format", """
WITH bad AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 50 = 0) AS b FROM orders)
SELECT 'csv' AS format, n AS rows_in, n AS rows_accepted FROM bad
UNION ALL SELECT 'json', n, n FROM bad
UNION ALL SELECT 'parquet', n, n - b FROM bad""")
def q5(spark, sf):
    """Accept/reject matrix of loosely typed sizes per format.

    Text formats (CSV, JSON) store ``'5.7 MB'`` as it is; the typed format
    (Parquet with ``size double``) rejects the rows whose value is no number.
    """
    s = size_text(Tables(spark, sf).orders)
    base = scratch_path(spark, "q5")
    s.write.mode("overwrite").option("header", True).csv(f"{base}/csv")
    s.write.mode("overwrite").json(f"{base}/json")
    typed = s.select("o_orderkey", F.col("size").try_cast("double").alias("size"),
                     F.col("size").alias("raw"))
    typed.filter(F.col("size").isNotNull() | F.col("raw").isNull()).drop("raw").write.mode("overwrite").parquet(
        f"{base}/parquet")
    n_in = s.agg(F.count(F.lit(1)).alias("rows_in"))
    csv = spark.read.schema("o_orderkey string, size string").option("header", True).csv(f"{base}/csv")
    js = spark.read.schema("o_orderkey bigint, size string").json(f"{base}/json")
    pq = spark.read.parquet(f"{base}/parquet")
    out = None
    for name, df in (("csv", csv), ("json", js), ("parquet", pq)):
        r = n_in.crossJoin(df.agg(F.count(F.lit(1)).alias("rows_accepted"))).select(
            F.lit(name).alias("format"), "rows_in", "rows_accepted")
        out = r if out is None else out.unionByName(r)
    return out


@register("Q6_csv_has_only_strings", """
SELECT 'o_orderkey' AS column_name, 'string' AS type, count(o_orderkey) AS values FROM orders
UNION ALL SELECT 'o_custkey', 'string', count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'string', count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'string', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""")
def q6(spark, sf):
    """CSV read back without inference returns every column as text (type of every value, per column)."""
    o = Tables(spark, sf).orders
    path = scratch_path(spark, "q6")
    o.write.mode("overwrite").option("header", True).csv(path)
    back = spark.read.option("header", True).option("inferSchema", False).csv(path)
    long = back.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.typeof(F.col(c)).alias("type"), F.col(c).isNotNull().alias("v"))
        for c in back.columns])).alias("x")).select("x.*")
    return long.groupBy("column_name", "type").agg(F.count_if("v").alias("values"))


@register("Q7_monotonic_order_check", f"""
WITH o1 AS (SELECT ts < lag(ts) OVER (ORDER BY event_id) AS d FROM events),
o2 AS (SELECT ts < lag(ts) OVER (ORDER BY {ARRIVAL}, event_id) AS d FROM events)
SELECT 'event_id' AS ordering, count(*) FILTER (WHERE d) AS decreases FROM o1
UNION ALL SELECT 'arrival', count(*) FILTER (WHERE d) FROM o2""")
def q7(spark, sf):
    """Monotonic check: times that decrease along an order (by id: 0; by arrival: late ones)."""
    ev = Tables(spark, sf).events.select("event_id", "ts")
    by_id = count_decreases(ev, ["event_id"], "ts").select(F.lit("event_id").alias("ordering"), "decreases")
    arr = ev.withColumn("arrival", arrival_key())
    by_arr = count_decreases(arr, ["arrival", "event_id"], "ts").select(F.lit("arrival").alias("ordering"),
                                                                       "decreases")
    return by_id.unionByName(by_arr)


@register("Q8_edge_checks", """
WITH e AS (SELECT o_custkey AS a, l_suppkey + 1000000 AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT a, b, count(*) AS n FROM e GROUP BY 1, 2)
SELECT (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM e WHERE a = b) AS self_loops,
       (SELECT count(*) FROM d WHERE n > 1) AS duplicate_pairs""")
def q8(spark, sf):
    """Edge checks on (customer, supplier) pairs: self loops and duplicate pairs."""
    t = Tables(spark, sf)
    e = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .select(F.col("o_custkey").alias("a"), (F.col("l_suppkey") + 1_000_000).alias("b")))
    stats = e.agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("a") == F.col("b")).alias("self_loops"))
    dup = e.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(
        F.count(F.lit(1)).alias("duplicate_pairs"))
    return stats.crossJoin(dup)


@register("Q9_stored_vs_actual_count", """
WITH actual AS (SELECT o_custkey, count(*) AS actual FROM orders GROUP BY 1),
stored AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS stored FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
SELECT a.o_custkey, coalesce(stored, 0) AS stored, actual FROM actual a LEFT JOIN stored s USING (o_custkey)
WHERE coalesce(stored, 0) <> actual""")
def q9(spark, sf):
    """Stored count (orders with lines) differs from the actual count of orders per customer."""
    t = Tables(spark, sf)
    actual = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("actual"))
    stored = (t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
              .groupBy("o_custkey").agg(F.countDistinct("o_orderkey").alias("stored")))
    j = actual.join(stored, "o_custkey", "left").select(
        "o_custkey", F.coalesce("stored", F.lit(0).cast("bigint")).alias("stored"), "actual")
    return j.filter(F.col("stored") != F.col("actual"))


@register("Q10_two_builds_equal", "SELECT CAST(0 AS BIGINT) AS a_minus_b, CAST(0 AS BIGINT) AS b_minus_a FROM region LIMIT 1")
def q10(spark, sf):
    """Determinism: two builds of the photo documents are equal (exceptAll both ways)."""
    t = Tables(spark, sf)
    a = photo_documents(t.orders, t.customer, t.nation)
    dealt = t.orders.repartition(7, F.xxhash64("o_orderkey"))  # the second build meets its rows in another order
    b = photo_documents(dealt, t.customer, t.nation)
    x = a.exceptAll(b).agg(F.count(F.lit(1)).alias("a_minus_b"))
    y = b.exceptAll(a).agg(F.count(F.lit(1)).alias("b_minus_a"))
    return x.crossJoin(y)


@register("Q11_logs_vs_truth", f"""
WITH {EX}, f AS (
  SELECT 'failed_uploads' AS metric, count(*) FILTER (WHERE status = 502) AS found, count(*) FILTER (WHERE event_type = 'purchase') AS expected FROM ex
  UNION ALL SELECT 'crashes', count(*) FILTER (WHERE event_type = 'purchase'), count(*) FILTER (WHERE event_type = 'purchase') FROM ex
  UNION ALL SELECT 'users_with_errors', count(DISTINCT user_id) FILTER (WHERE event_type = 'error'), count(DISTINCT user_id) FILTER (WHERE event_type = 'error') FROM ex
  UNION ALL SELECT 'failed_logins', count(*) FILTER (WHERE event_type = 'signup'), count(*) FILTER (WHERE event_type = 'signup') FROM ex)
SELECT metric, found, expected, found = expected AS ok FROM f""")
def q11(spark, sf):
    """Reconcile counts found in the logs with the truth computed from the events."""
    t = Tables(spark, sf)
    ex = events_x(t.events)
    lake = lake_lines(t.events)
    # failed uploads: 502 answers in the access log of the web tier
    upl_502 = (access_lines(t.events).select(parse_access("line").alias("r"))
               .agg(F.count_if(F.col("r.status") == 502).alias("found")))
    # crashes: JSON crash reports of the upload service
    crashes = lake.filter(F.col("service") == "upload").agg(
        F.count_if(F.get_json_object("line", "$.event") == "crash").alias("found"))
    errs = lake.filter((F.col("service") == "nginx") & (F.col("file") == "error")).select(
        F.regexp_extract("line", r"client: 192\.0\.2\.(\d+)", 1).alias("u")).agg(
        F.countDistinct("u").alias("found"))
    logins = lake.filter((F.col("service") == "auth") & F.col("line").contains("Failed password")).agg(
        F.count(F.lit(1)).alias("found"))
    truth = ex.agg(F.count_if(F.col("event_type") == "purchase").alias("purchases"),
                   F.countDistinct(F.when(F.col("event_type") == "error", F.col("user_id"))).alias("err_users"),
                   F.count_if(F.col("event_type") == "signup").alias("signups"))
    rows = [
        upl_502.crossJoin(truth).select(F.lit("failed_uploads").alias("metric"), "found",
                                        F.col("purchases").alias("expected")),
        crashes.crossJoin(truth).select(F.lit("crashes").alias("metric"), "found", F.col("purchases").alias("expected")),
        errs.crossJoin(truth).select(F.lit("users_with_errors").alias("metric"), "found",
                                     F.col("err_users").alias("expected")),
        logins.crossJoin(truth).select(F.lit("failed_logins").alias("metric"), "found",
                                       F.col("signups").alias("expected")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("ok", F.col("found") == F.col("expected"))


@register("Q12_malformed_lines", f"""
WITH {EX}, c AS (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'parsed' ELSE 'unparsed' END AS outcome FROM ex
  UNION ALL SELECT 'skipped' FROM ex WHERE k % 50 = 0)
SELECT outcome, count(*) AS n FROM c GROUP BY 1""")
def q12(spark, sf):
    """Malformed-line handling over the mixed log lake with the access-log parser.

    ``skipped``: 8 fields or fewer (the mapper's rule); ``unparsed``: enough
    fields but no access-log match (PERMISSIVE keeps them counted, not fatal);
    ``parsed``: the rest.
    """
    lines = lake_lines(Tables(spark, sf).events)
    ok = parse_access("line")["is_parsed"]
    outcome = (F.when(n_fields("line") <= 8, "skipped").when(ok, "parsed").otherwise("unparsed"))
    return lines.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@register("Q13_append_only_audit", """
SELECT 'appended' AS version, CAST(0 AS BIGINT) AS changed_or_removed
UNION ALL SELECT 'tampered', count(*) FROM events WHERE event_id % 1000 = 7 AND event_id < (SELECT max(event_id) + 1 FROM events) / 2""")
def q13(spark, sf):
    """Append-only audit: old rows missing from a new log version (must be 0 when only appended)."""
    ev = Tables(spark, sf).events.select("event_id", "ts", "event_type", "value")
    tampered = ev.withColumn("value", F.when(F.col("event_id") % 1000 == 7, F.col("value") + 1).otherwise(F.col("value")))
    log = _audited(spark, ev, tampered)

    def count(version, number):
        return log.lost(1, number).agg(F.count(F.lit(1)).alias("changed_or_removed")).select(
            F.lit(version).alias("version"), "changed_or_removed")

    return count("appended", 2).unionByName(count("tampered", 3))


@register("Q13b_rows_lost_between_versions", """
WITH m AS (SELECT max(event_id) + 1 AS n FROM events)
SELECT event_id, ts, event_type, value FROM events, m
WHERE event_id >= n // 4 AND event_id < n // 4 + n // 50 AND event_id % 5 IN (1, 2)""")
def q13b(spark, sf):
    """The rows that a tampered version of the log lost: some changed, some removed, within a fiftieth of the log; digests
    name the blocks, rows are read from these only."""
    ev = Tables(spark, sf).events.select("event_id", "ts", "event_type", "value")
    n = (ev.agg(F.max("event_id")).first()[0] or 0) + 1
    at = F.col("event_id")
    hit = (at >= n // 4) & (at < n // 4 + n // 50)
    tampered = (ev.filter(~(hit & (at % 5 == 2)))
                .withColumn("value", F.when(hit & (at % 5 == 1), F.coalesce(F.col("value"), F.lit(0.0)) + 1).otherwise(F.col("value"))))
    return _audited(spark, ev, tampered).lost(1, 3)


def _audited(spark, ev, tampered):
    """Versions of the event log: 1 the older half, 2 the rest appended to it, 3 the tampered log."""
    n = (ev.agg(F.max("event_id")).first()[0] or 0) + 1
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ev.schema)
    log = AuditedLog(spark, scratch_path(spark, "audit"), schema, "event_id", block_rows=n // 64 + 1)
    older = F.col("event_id") < n / 2
    log.store(ev.filter(older), 1)
    log.store(ev.filter(~older), 2, base=1)
    log.store(tampered, 3)
    return log


@register("Q14_served_equals_exact", f"""
WITH {EX},
exact AS (SELECT k, count(*) AS exact FROM ex WHERE is_view GROUP BY k),
served AS (SELECT k, count(*) AS served FROM (SELECT * FROM ex UNION ALL SELECT * FROM ex WHERE event_id % 10 = 3) WHERE is_view GROUP BY k),
first AS (SELECT k FROM exact ORDER BY k LIMIT 300)
SELECT count(*) AS checked, count(*) FILTER (WHERE served = exact) AS exact_ones
FROM first JOIN exact USING (k) JOIN served USING (k)""")
def q14(spark, sf):
    """Served numbers (with redelivered duplicates) equal to the exact ones, on the first 300 keys."""
    ev = Tables(spark, sf).events
    ex = events_x(ev).filter("is_view")
    exact = ex.groupBy("k").agg(F.count(F.lit(1)).alias("exact"))
    served = events_x(redelivered(ev)).filter("is_view").groupBy("k").agg(F.count(F.lit(1)).alias("served"))
    first = exact.select("k").orderBy("k").limit(300)
    j = first.join(exact, "k").join(served, "k")
    return j.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.col("served") == F.col("exact")).alias("exact_ones"))
