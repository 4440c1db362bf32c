"""SURVEY §2.15 search and the UDF surface (R1, R2, D1-D3, D5) with J14 and A14.

Photos for the model stages are parts (true objects = words of ``p_name``);
the vocabulary is the sorted set of all part words.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quarry.functions.core import stable_hash
from quarry.operators.fold import SumFold, fold
from quarry.operators.model import detect, vocabulary
from quarry.operators.postings import PostingIndex
from quarry.plans.registry import register
from quarry.plans.sqlx import EX, h
from quarry.session import scratch_path
from quarry.sources.derived import access_lines
from quarry.sources.tables import Tables

WORD_RX = r"[^\p{L}]+"


def keyword_rows(documents):
    """Postings ``(keyword, owner, id)`` (owner = source); ``doc_id`` is the key of ``documents``,
    so words made distinct within their row need no shuffle."""
    words = F.array_distinct(F.split(F.lower("text"), WORD_RX))
    rows = documents.select(F.explode(words).alias("keyword"), F.col("source").alias("owner"), F.col("doc_id").alias("id"))
    return rows.filter(F.col("keyword") != "")


def keyword_index(spark, sf, name):
    return PostingIndex.build(keyword_rows(Tables(spark, sf).documents), scratch_path(spark, name))


IDX_SQL = r"""idx AS (SELECT DISTINCT keyword, doc_id, source AS owner FROM (
  SELECT doc_id, source, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS keyword FROM documents)
  WHERE keyword <> '')"""


@register("R1_inverted_index", f"""
WITH {IDX_SQL} SELECT keyword, count(*) AS docs, count(DISTINCT owner) AS owners FROM idx GROUP BY keyword""")
def r1(spark, sf):
    """Inverted index keyword -> (doc, owner), stored as posting lists; documents and owners per keyword from its directory."""
    lists = keyword_index(spark, sf, "r1").directory()
    return lists.groupBy("keyword").agg(F.sum("n").alias("docs"), F.countDistinct("owner").alias("owners"))


@register("R1b_posting_lists", f"WITH {IDX_SQL} SELECT keyword, owner, doc_id FROM idx")
def r1b(spark, sf):
    """The postings (keyword, owner, document) as the stored index gives them back."""
    return keyword_index(spark, sf, "r1b").postings().withColumnRenamed("id", "doc_id")


@register("R2_search_one_user_keyword", f"""
WITH {IDX_SQL}, q AS (SELECT DISTINCT source AS owner, kw AS keyword FROM documents, (VALUES ('the'), ('zzzz')) v(kw))
SELECT q.owner, q.keyword, idx.doc_id FROM q LEFT JOIN idx ON q.owner = idx.owner AND q.keyword = idx.keyword""")
def r2(spark, sf):
    """Search: ids for one keyword of one owner, exact keyword match; an unknown keyword gives no ids (null row)."""
    owners = Tables(spark, sf).documents.select(F.col("source").alias("owner")).distinct()
    requests = owners.select("owner", F.explode(F.array(F.lit("the"), F.lit("zzzz"))).alias("keyword"))
    return keyword_index(spark, sf, "r2").search(requests).select("owner", "keyword", F.col("id").alias("doc_id"))


@register("R2b_search_table_of_requests", f"""
WITH {IDX_SQL}, q AS (SELECT DISTINCT conv_id, lower(w) AS keyword, 'src' || conv_id % 23 AS owner
  FROM (SELECT conv_id, unnest(string_split(text, ' ')) AS w FROM conversations WHERE role = 'user') WHERE w <> '')
SELECT q.conv_id, q.keyword, q.owner, idx.doc_id FROM q LEFT JOIN idx ON q.owner = idx.owner AND q.keyword = idx.keyword""")
def r2b(spark, sf):
    """Search for a table of requests: the words users say in conversations, each for one owner; unknown words and owners give a null row."""
    said = Tables(spark, sf).conversations.filter("role = 'user'").select("conv_id", F.explode(F.split("text", " ")).alias("w")).filter("w <> ''")
    requests = said.select("conv_id", F.lower("w").alias("keyword"), F.concat(F.lit("src"), (F.col("conv_id") % 23).cast("string")).alias("owner")).distinct()
    return keyword_index(spark, sf, "r2b").search(requests).select("conv_id", "keyword", "owner", F.col("id").alias("doc_id"))


def _mapper(batches):
    """D1 map script over lines: ``path`` for each view line (fields > 8, "GET, /st/, 200|304)."""
    for pdf in batches:
        f = pdf["line"].str.split()
        ok = (f.str.len() > 8) & (f.str[5] == '"GET') & f.str[6].str.startswith("/st/", na=False) & \
            f.str[8].isin(["200", "304"])
        yield pd.DataFrame({"path": f[ok].str[6]})


@register("D1_map_script_over_lines", f"""
WITH {EX} SELECT path, count(*) AS views FROM ex WHERE status IN (200, 304) GROUP BY path""")
def d1(spark, sf):
    """Map script hook (Arrow batches through ``mapInPandas``), then the native reduce."""
    lines = access_lines(Tables(spark, sf).events).select("line")
    mapped = lines.mapInPandas(_mapper, "path string")
    return mapped.groupBy("path").agg(F.count(F.lit(1)).alias("views"))


@register("D2_reduce_features", f"""
WITH {EX}
SELECT path, count(*) AS views, count(DISTINCT 'u' || CAST(user_id AS VARCHAR)) AS viewers,
       round(100.0 * count(*) FILTER (WHERE user_id % 3 <> 2) / count(*)) / 100.0 AS app_share
FROM ex WHERE status IN (200, 304) GROUP BY path""")
def d2(spark, sf):
    """Reduce over groups sorted by (path, user) with a reducer that can combine: a hot path is split over tasks."""
    lines = access_lines(Tables(spark, sf).events).select("line")
    f = F.split(F.trim("line"), r"\s+")
    v = lines.filter((F.size(f) > 8) & (f.getItem(5) == '"GET') & f.getItem(6).startswith("/st/")
                     & f.getItem(8).isin("200", "304"))
    # combined per (path, user) before the shuffle, as a combiner would
    rows = (v.select(f.getItem(6).alias("path"), f.getItem(2).alias("user"), F.col("line").contains("PhotosApp").cast("int").alias("app"))
            .groupBy("path", "user").agg(F.count(F.lit(1)).alias("views"), F.sum("app").alias("app")))

    out = fold(rows.withColumn("viewers", F.lit(1).cast("bigint")), "path", ["user"], SumFold(["views", "viewers", "app"]))
    return out.select("path", "views", "viewers", (F.round(F.lit(100.0) * F.col("app") / F.col("views"), 0) / 100.0).alias("app_share"))


def detected_objects(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", F.split("p_name", " ").alias("truth"))
    vocab = vocabulary(p.select(F.explode("truth").alias("word")))
    return detect(p, "p_partkey", "truth", vocab, 0.9, 0.1)


def _draw_sql(key: str, salt: str) -> str:
    return f"({h(f'CAST({key} AS VARCHAR) || {chr(39)}|{chr(39)} || {salt}')} / 4294967296.0)"


D3_SQL = f"""vocab AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part)),
vs AS (SELECT count(*) AS n FROM vocab),
p AS (SELECT p_partkey, string_split(p_name, ' ') AS truth,
        CASE WHEN {_draw_sql('p_partkey', "'+'")} < 0.1 THEN {h("CAST(p_partkey AS VARCHAR) || '|pick'")} % (SELECT n FROM vs) END AS pick
      FROM part),
d AS (SELECT p_partkey, truth,
        list_filter(truth, lambda l: {_draw_sql('p_partkey', 'l')} < 0.9) AS kept, vocab.word AS extra
      FROM p LEFT JOIN vocab ON p.pick = vocab.idx),
det AS (SELECT p_partkey, truth, CASE WHEN extra IS NOT NULL THEN list_append(kept, extra) ELSE kept END AS found FROM d)"""


@register("D3_keyed_model_draws", f"WITH {D3_SQL} SELECT p_partkey, found FROM det")
def d3(spark, sf):
    """Deterministic model: keep each true object with p = 0.9, add one from the vocabulary with p = 0.1."""
    return detected_objects(spark, sf).select("p_partkey", "found")


@register("J14_truth_vs_found_overlap", f"""
WITH {D3_SQL}
SELECT p_partkey, CAST(len(truth) AS INTEGER) AS truth_n, CAST(len(found) AS INTEGER) AS found_n,
       CAST(len(list_distinct(list_intersect(truth, found))) AS INTEGER) AS hits FROM det""")
def j14(spark, sf):
    """Truth vs found per photo: sizes and overlap of the label lists."""
    d = detected_objects(spark, sf)
    return d.select("p_partkey", F.size("truth").alias("truth_n"), F.size("found").alias("found_n"),
                    F.size(F.array_intersect("truth", "found")).alias("hits"))


@register("A14_recall", f"""
WITH {D3_SQL}
SELECT CAST(sum(len(list_distinct(list_intersect(truth, found)))) AS BIGINT) AS hits, CAST(sum(len(truth)) AS BIGINT) AS truth,
       sum(len(list_distinct(list_intersect(truth, found)))) / sum(len(truth)) AS recall FROM det""")
def a14(spark, sf):
    """Recall of the model: hits / truth size over all photos."""
    d = detected_objects(spark, sf)
    hits = F.size(F.array_intersect("truth", "found"))
    a = d.agg(F.sum(hits).cast("bigint").alias("hits"), F.sum(F.size("truth")).cast("bigint").alias("truth"))
    return a.withColumn("recall", F.col("hits") / F.col("truth"))


def block_mean_2x2(vec, side: int = 8):
    """2 x 2 block means of a ``side x side`` image stored row-major in an array (vectorised)."""
    half = side // 2

    def block(b):
        r, c = F.floor(b / half), b % half
        i = (r * 2) * side + c * 2 + 1  # 1-based element_at
        e = lambda j: F.element_at(vec, (i + j).cast("int")).cast("double")
        return (e(0) + e(1) + e(side) + e(side + 1)) / 4.0

    return F.transform(F.sequence(F.lit(0), F.lit(half * half - 1)), block)


@register("D5_block_mean_2x2", """
SELECT vec_id, list_transform(range(16), lambda b:
  (CAST(embedding[(b // 4) * 16 + (b % 4) * 2 + 1] AS DOUBLE) + CAST(embedding[(b // 4) * 16 + (b % 4) * 2 + 2] AS DOUBLE)
 + CAST(embedding[(b // 4) * 16 + (b % 4) * 2 + 9] AS DOUBLE) + CAST(embedding[(b // 4) * 16 + (b % 4) * 2 + 10] AS DOUBLE)) / 4.0) AS pooled
FROM embeddings""")
def d5(spark, sf):
    """2 x 2 block mean of each 8 x 8 embedding image (array expression, no per-element Python)."""
    e = Tables(spark, sf).embeddings
    return e.select("vec_id", block_mean_2x2(F.col("embedding")).alias("pooled"))
