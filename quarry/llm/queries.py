"""Registered queries ``opN_<name>``: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe as _bpe
from quarry.llm import divergence as _divergence
from quarry.llm import exact_dedup as _exact
from quarry.llm import license_scan as _license
from quarry.llm import line_dedup as _lines
from quarry.llm import merkle as _merkle
from quarry.llm import packing as _packing
from quarry.llm import pieces as _pieces
from quarry.llm import quality as _quality
from quarry.llm import sharding as _sharding
from quarry.llm import simhash as _simhash
from quarry.llm import substring_dedup as _spans
from quarry.llm import vafile as _vafile
from quarry.llm.common import documents
from quarry.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op7_exact_dedup", oracle=f"""
WITH d AS (SELECT doc_id, sha256({_ASCII_LOWER}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents; the older half of the ids is the history held in the index."""
    rows = _exact.exact_groups(documents(spark, sf_dir), keep_payload=False)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences that repeat an earlier run; spans are character offsets of the old text."""
    rows = _spans.substring_dedup(documents(spark, sf_dir))
    return rows.select(F.col("id").alias("doc_id"), "n_removed", (F.col("n_removed") > 0).alias("changed"), "spans", "text")


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of three-line windows that occurred before."""
    rows = _lines.line_dedup(documents(spark, sf_dir))
    return rows.select(F.col("id").alias("doc_id"), "n_removed", (F.col("n_removed") > 0).alias("changed"), "spans", "text")


#: Shingle length and largest bit distance of the contract.
SIMHASH_WORDS, SIMHASH_BITS = 4, 4


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the components of those within 4 bits."""
    rows = _simhash.near_components(documents(spark, sf_dir), SIMHASH_WORDS, SIMHASH_BITS, keep_payload=False)
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Sequence length, and the id that ends a document.
SEQUENCE, END_ID = 4096, 2
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed into sequences of at most 4096 ids."""
    rows = _packing.pack(documents(spark, sf_dir), WORD_BPE, END_ID, SEQUENCE)
    return rows.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


SHARDS = 40


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 with counts at most one apart; equal texts are linked."""
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", F.monotonically_increasing_id().alias("row"), F.sha2(text, 256).alias("group"),
                                           (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    return _sharding.shard(rows, SHARDS).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                                F.lit(None).cast("int").alias("grown_shard"))


def _license_sql() -> str:
    """Brute force: phrases by position, and every block against every template without filters."""
    phrases = " UNION ALL ".join(f"SELECT {p.split()!r} AS ws, '{label}' AS label" for p, label in _license.PHRASES.items())
    templates = ", ".join(f"('{label}', {names.split()!r}::VARCHAR[], {sorted(set(t.split()))!r}, {_license.span_of(t)})" for label, names, t in _license.TEMPLATES)
    split = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    return f"""
    WITH d AS (SELECT doc_id, {_ASCII_LOWER} AS t FROM documents),
    w AS (SELECT doc_id, t, {split.format("t")} AS ws FROM d),
    p AS ({phrases}),
    places AS (SELECT doc_id, label, i FROM (SELECT w.doc_id, p.label, p.ws AS ps, w.ws, unnest(range(len(w.ws))) AS i
               FROM w, p WHERE list_contains(w.ws, p.ws[1])) WHERE ws[i + 1:i + len(ps)] = ps),
    base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_distinct(list(label)) AS ls FROM places GROUP BY 1),
    tm(label, names, ts, span) AS (VALUES {templates}),
    b AS (SELECT doc_id, span, ws[i * (span // 2) + 1:i * (span // 2) + span] AS bw FROM (
          SELECT doc_id, ws, span, unnest(range(ceil(len(ws) / (span // 2))::BIGINT)) AS i FROM w, (SELECT DISTINCT span FROM tm))),
    m AS (SELECT doc_id, label, len(list_intersect(bw, ts)) / len(ts) AS share FROM b JOIN tm USING (span)
          WHERE len(list_intersect(bw, ts)) >= ceil({_license.THRESHOLD} * len(ts) - 1e-9) AND list_has_all(bw, names)),
    found AS (SELECT doc_id, list_distinct(list(label)) AS ls, max(share) AS best FROM m GROUP BY 1)
    SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           coalesce(array_to_string(list_sort(base.ls), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(found.ls, [])))), ','), '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
    FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


@query("op9_license_scan", oracle=_license_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in all documents, found by native DataFrame operations."""
    rows = _license.scan(documents(spark, sf_dir))
    start = F.transform("places", lambda p: p["start"].cast("long"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                       F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
                       F.array_join("base", ",").alias("base_labels"),
                       F.array_join(F.array_sort(F.array_union("base", "found")), ",").alias("labels"), "score")


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@query("op6_bpe_round_trip")
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by byte-level BPE and decoded again; digests of ids and text."""
    rows = _bpe.decode(_bpe.encode(documents(spark, sf_dir), BYTE_BPE), BYTE_BPE)
    return rows.select(F.col("id").alias("doc_id"), F.floor(F.length("ids") / 4).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@query("op11_sentencepiece_round_trip")
def op11_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by SentencePiece BPE and decoded again; digests of ids and text."""
    rows = _pieces.decode(_pieces.encode(documents(spark, sf_dir), PIECE_BPE), PIECE_BPE)
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


HELD_OUT = "crc32(cast(id as string)) % 5 = 0"


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labelled rows that aren't held out."""
    learn = F.expr(f"not ({HELD_OUT})")
    rows = _quality.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"), learn, keep_payload=False)
    return rows.select(F.col("id").alias("doc_id"), F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


@query("op12_source_divergence", oracle=f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_ASCII_LOWER} AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
lt AS (SELECT lang, sum(n)::HUGEINT AS total FROM c GROUP BY 1),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + v.v) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n)::HUGEINT + 1)) // (any_value(lt.total) + any_value(v.v)) AS q FROM c JOIN lt USING (lang) JOIN v USING (lang) GROUP BY 1, 2),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's divergence from the other sources of its language, and its 200 terms most above the language."""
    return _divergence.audit(documents(spark, sf_dir), 3, 200)


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = "coalesce(crc32(cast(doc_id as string)) % 7 = 0, false)"


def _merkle_sql() -> str:
    """Trees level by level; each leaf's proof and folded root step by step up the levels."""
    h = lambda x: f"sha256({x})"
    cell = lambda c, x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    leaf = lambda n: h(" || ".join(cell(c, n if c == "n_chars" else c) for c in LEAF))
    # DuckDB has no crc32: bitwise over the id's digits, with polynomial 0xEDB88320
    bits = "list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, {}::BIGINT)"
    return f"""
    WITH RECURSIVE
    d AS (SELECT doc_id, lang, {leaf("n_chars")} AS leaf, {leaf("(n_chars + 1)")} AS other FROM documents),
    crc(doc_id, rest, c) AS (
      SELECT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM d WHERE doc_id IS NOT NULL
      UNION ALL SELECT doc_id, rest[2:], {bits.format("xor(c, ascii(rest[1])::BIGINT)")} FROM crc WHERE rest <> ''),
    hit AS (SELECT DISTINCT doc_id FROM crc WHERE rest = '' AND xor(c, 4294967295) % 7 = 0),
    l AS (SELECT doc_id, lang, leaf, CASE WHEN doc_id IN (SELECT doc_id FROM hit) THEN other ELSE leaf END AS claim,
                 row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
    n(level, lang, pos, x, nodes) AS (
      SELECT 0, lang, pos, leaf, count(*) OVER (PARTITION BY lang) FROM l
      UNION ALL
      SELECT any_value(level) + 1, lang, pos // 2, sha256(string_agg(x, '' ORDER BY pos)), (any_value(nodes) + 1) // 2 FROM n WHERE nodes > 1 GROUP BY lang, pos // 2),
    s AS (SELECT lang, x AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS nodes FROM n WHERE nodes = 1),
    u(level, pos, x, nodes) AS (
      SELECT 0, pos, subroot, nodes FROM s
      UNION ALL
      SELECT any_value(level) + 1, pos // 2, sha256(string_agg(x, '' ORDER BY pos)), (any_value(nodes) + 1) // 2 FROM u WHERE nodes > 1 GROUP BY pos // 2),
    walk(doc_id, lang, first, level, pos, proof, x) AS (
      SELECT doc_id, lang, pos, 0, pos, '', claim FROM l
      UNION ALL
      SELECT w.doc_id, w.lang, w.first, w.level + 1, w.pos // 2, w.proof || coalesce(b.x, ''),
             sha256(CASE WHEN w.pos % 2 = 1 THEN b.x || w.x ELSE w.x || coalesce(b.x, '') END)
      FROM walk w JOIN n a ON a.lang IS NOT DISTINCT FROM w.lang AND a.level = w.level AND a.pos = w.pos AND a.nodes > 1
      LEFT JOIN n b ON b.lang IS NOT DISTINCT FROM w.lang AND b.level = w.level AND b.pos = xor(w.pos, 1)),
    inner_end AS (SELECT arg_max(w, w.level) AS w FROM walk w GROUP BY w.lang, w.first),
    climb(doc_id, lang, first, level, pos, proof, x) AS (
      SELECT w.doc_id, w.lang, w.first, 0, s.pos, w.proof, w.x FROM inner_end JOIN s ON s.lang IS NOT DISTINCT FROM w.lang
      UNION ALL
      SELECT c.doc_id, c.lang, c.first, c.level + 1, c.pos // 2, c.proof || coalesce(b.x, ''),
             sha256(CASE WHEN c.pos % 2 = 1 THEN b.x || c.x ELSE c.x || coalesce(b.x, '') END)
      FROM climb c JOIN u a ON a.level = c.level AND a.pos = c.pos AND a.nodes > 1 LEFT JOIN u b ON b.level = c.level AND b.pos = xor(c.pos, 1)),
    ended AS (SELECT arg_max(c, c.level) AS c FROM climb c GROUP BY c.lang, c.first),
    top AS (SELECT x AS root FROM u WHERE nodes = 1)
    SELECT c.doc_id, l.leaf, s.subroot, root, sha256(c.proof) AS proof_sha256, c.x AS folded_root, c.x = root AS verified
    FROM ended JOIN l ON l.lang IS NOT DISTINCT FROM c.lang AND l.pos = c.first JOIN s ON s.lang IS NOT DISTINCT FROM c.lang, top"""


@query("op13_merkle_manifest", oracle=_merkle_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, a tree per language; every document's proof, and the root that its (here and there tampered) row makes."""
    tampered = F.when(F.expr(TAMPERED), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = _merkle.document_rows(documents(spark, sf_dir), LEAF, claims={"claim": {"n_chars": tampered}})
    out = _merkle.proofs(_merkle.manifest(rows), "claim")
    digest = lambda c, name=None: F.lower(F.hex(c)).alias(name or c)
    return out.select(F.col("id").alias("doc_id"), digest("leaf"), digest("subroot"), digest("root"), digest("proof", "proof_sha256"),
                      digest("folded", "folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


@query("op4_exact_top_k", oracle="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
""")
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products with all other vectors, for every vector whose id is divisible by 100."""
    return _vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10, 1024)
