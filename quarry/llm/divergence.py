"""Source divergence audit: how far each source's use of words lies from its language's and from other sources'.

Terms are counted by sorting pointers.  A shard is a run of Arrow batches with
about ``SHARD_BYTES`` of text in one buffer; every word start in it is a
pointer.  ``sorted_pointers`` is a multikey quicksort in slices of eight bytes,
vectorised: all pointers are sorted by their first slice, then only runs of
equal slices that hold a longer term are sorted by the next one.  Equal runs are
the terms; within a run the pointers of a (lang, source) group give the count,
and the changes of document the document frequency.  A document lies in one
shard, so both add up over shards.

Shards are combined per (lang, source, term) before the shuffle; a language
keeps the terms in at least ``min_docs`` of its documents.  A group gives a term
p = 1 + floor(10**9 * (count + 1) / (N + V)).  Values (p - q)**2 / q, rounded
down, are summed over all kept terms for two sources of a language, and ranked
by term for a source against its language.

Pairs of sources: a term that neither uses adds the same value each time.  So
the sum is V times that value plus, for the terms one of them uses, the
difference from it.  Sources are numbered per language and lie in blocks of
``WIDTH``; a term meets a pair of blocks if it occurs in one of them, and a task
adds up whole matrices of differences before anything is shuffled.

Defined results: null texts, languages and sources count as empty ones; a group
without terms has p like any other; without kept terms pairs have the value 0;
repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import field, frozen, payload

SHARD_BYTES = 8 << 20
SCALE = 1_000_000_000
#: Sources per block, and terms whose differences are worked on at a time.
WIDTH, TERMS = 32, 512
#: Matrices of differences a task holds before it hands them on.
HELD = 256
#: Slices after which the rest of a run is sorted as whole byte strings.
DEPTH = 32

_CODES = np.arange(256)
_IN_TERM = (_CODES >= 128) | (_CODES >= 65) & (_CODES <= 90) | (_CODES >= 97) & (_CODES <= 122)
_LOWER = (_CODES + 32 * ((_CODES >= 65) & (_CODES <= 90))).astype(np.uint8)


def pointers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in ``data``, in which a 0 stands behind each document."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_TERM[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def sorted_pointers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the terms (equal ones in the order given), and where in it each run of equal ones begins."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    size = ends - starts

    def slice_of(who: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(size[who] - 8 * depth, 0, 8).astype(np.uint64)
        at = np.minimum(starts[who] + 8 * depth, len(data))
        shift = np.uint64(8) * (np.uint64(8) - left)
        return np.where(left > 0, words[at].astype(np.uint64) >> np.minimum(shift, np.uint64(63)) << np.minimum(shift, np.uint64(63)), np.uint64(0))

    first = slice_of(np.arange(len(starts)), 0)
    order = np.argsort(first, kind="stable")
    head = np.ones(len(order), bool)
    head[1:] = first[order[1:]] != first[order[:-1]]
    depth = 1
    while True:
        long = size[order] > 8 * depth
        run = np.cumsum(head) - 1
        open_run = (np.bincount(run, weights=long) > 0) & (np.bincount(run) > 1) if len(run) else np.zeros(0, bool)
        at = np.flatnonzero(open_run[run])
        if not len(at):
            return order, np.flatnonzero(head)
        who = order[at]
        if depth < DEPTH:
            key = slice_of(who, depth)
        else:
            rest = [data[starts[w] + 8 * depth:ends[w]].tobytes() for w in who.tolist()]
            number = {r: k for k, r in enumerate(sorted(set(rest)))}
            key = np.array([number[r] for r in rest], np.uint64)
        turn = np.lexsort((key, run[at]))
        order[at] = who[turn]
        key, own = key[turn], run[at]
        head[at[1:]] |= (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        if depth == DEPTH:
            return order, np.flatnonzero(head)
        depth += 1


def _runs(table: pa.Table) -> pa.RecordBatch:
    """Counts and document frequencies of one shard's terms by (lang, source)."""
    joined = pc.binary_join_element_wise(table["text"].combine_chunks().cast(pa.large_binary()), pa.scalar(b"\0", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
    data = _LOWER[np.frombuffer(joined.buffers()[2], np.uint8)[at[0]:at[-1]]]
    starts, ends = pointers(data)
    doc = np.searchsorted(at - at[0], starts, side="right") - 1
    kinds = [table[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
    group = np.asarray(kinds[0].indices).astype(np.int64) * len(kinds[1].dictionary) + np.asarray(kinds[1].indices)
    group = group[doc]
    order, runs = sorted_pointers(data, starts, ends)
    term = np.zeros(len(order), np.int64)
    term[runs] = 1
    term = np.cumsum(term) - 1
    by_group = np.lexsort((group[order], term))  # stable: documents stay in order
    order = order[by_group]
    g, d = group[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (term[1:] != term[:-1]) | (g[1:] != g[:-1])
    new_doc = new.copy()
    new_doc[1:] |= d[1:] != d[:-1]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(order)))
    df = np.add.reduceat(new_doc.astype(np.int64), at) if len(at) else n
    lead = order[at]
    size = (ends - starts)[lead]
    to = np.concatenate([[0], np.cumsum(size)])
    chars = data[np.repeat(starts[lead] - to[:-1], size) + np.arange(to[-1])]
    terms = pa.Array.from_buffers(pa.large_string(), len(lead), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(chars)])
    lang, source = np.divmod(g[at], max(1, len(kinds[1].dictionary)))
    return pa.RecordBatch.from_arrays([kinds[0].dictionary.take(pa.array(lang)), kinds[1].dictionary.take(pa.array(source)), terms.cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(df.astype(np.int64))],
                                      ["lang", "source", "term", "n", "docs"])


def _sharder(shard_bytes: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> Iterator[pa.RecordBatch]:
            out = _runs(pa.Table.from_batches(held))
            for k in range(0, len(out), 100_000):
                yield out.slice(k, 100_000)
            pa.default_memory_pool().release_unused()

        for batch in batches:
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= shard_bytes:
                yield from counted()
                held, size = [], 0
        if held:
            yield from counted()

    return shards


def term_counts(rows: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(lang, source, term, n, docs)`` of ``rows`` (text, lang, source)."""
    part = rows.select("text", "lang", "source").mapInArrow(_sharder(shard_bytes), "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n, total, terms) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + terms)), exactly."""
    whole = "cast({} as decimal(20, 0))"
    return F.expr(f"1 + ({whole.format(SCALE)} * {whole.format(f'{n} + 1')}) div {whole.format(f'{total} + {terms}')}")


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


_MATRIX = "lang string, a int, b int, pairs array<struct<i:int,j:int,value:long>>"


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, per (lang, a, b), of the pairs' values less those of terms that neither source uses."""
    held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, a, b), (there, back) in held.items():
            value = np.concatenate([there.ravel(), back.ravel()])
            i, j = np.indices(there.shape)
            i, j = i.ravel() + a * WIDTH, j.ravel() + b * WIDTH
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate([i, j]), pa.int32()), pa.array(np.concatenate([j, i]), pa.int32()), pa.array(value)], ["i", "j", "value"])
            keep = pa.array(np.arange(len(value)) < (len(value) if a != b else len(value) // 2))
            pairs = pairs.filter(keep)
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([a], pa.int32()), pa.array([b], pa.int32()),
                                              pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs)], ["lang", "a", "b", "pairs"])
        held.clear()

    def dense(column: pa.ListArray, rest: np.ndarray) -> np.ndarray:
        """Shares by term and source of a block: those given, else that of a source without the term."""
        flat = column.flatten()
        n = np.diff(np.asarray(column.offsets))
        out = np.repeat(rest[None, :], len(column), axis=0)
        out[np.repeat(np.arange(len(column)), n), np.asarray(flat.field("i")) % WIDTH] = np.asarray(flat.field("p"))
        return out

    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = table.group_by(["lang", "a", "b"]).aggregate([]).to_pylist()
        for key in keys:
            match = pc.and_(pc.and_(pc.equal(table["lang"], key["lang"]), pc.equal(table["a"], key["a"])), pc.equal(table["b"], key["b"]))
            own = table.filter(match).combine_chunks()
            rest_a, rest_b = (np.array(own[c][0].as_py(), np.int64) for c in ("rest_a", "rest_b"))
            name = tuple(key.values())
            if name not in held:
                if len(held) >= HELD:
                    yield from given()
                held[name] = tuple(np.zeros((len(rest_a), len(rest_b)), np.int64) for _ in range(2))
            there, back = held[name]
            base, base_back = _gap(rest_a[:, None], rest_b[None, :]), _gap(rest_b[None, :], rest_a[:, None])
            for k in range(0, len(own), TERMS):
                cut = own.slice(k, TERMS)
                p, q = (dense(cut[c].combine_chunks(), rest)[:, axes[0], axes[1]] for c, rest, axes in (("in_a", rest_a, (slice(None), None)), ("in_b", rest_b, (None, slice(None)))))
                there += _gap(p, q).sum(0) - len(cut) * base
                if name[1] != name[2]:
                    back += _gap(q, p).sum(0) - len(cut) * base_back
    yield from given()


def pair_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, i, j, value)`` for each two sources i, j of a language: the sum over its kept terms.

    ``terms``: (lang, used) with used an array of (i, p); ``groups``: (lang, source, i, rest, v), rest the p of a term the source doesn't use.
    """
    block = lambda i: F.floor(i / WIDTH).cast("int")
    blocks = groups.groupBy("lang", block(F.col("i")).alias("block")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "rest"))), lambda x: x["rest"]).alias("rest"))  # at most WIDTH
    count = groups.groupBy("lang").agg((block(F.max("i")) + 1).alias("blocks"))
    used = terms.join(count, "lang").withColumn("a", F.explode(F.array_distinct(F.transform("used", lambda x: block(x["i"])))))
    used = used.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # a pair of blocks that both hold the term comes once
    held = F.exists("used", lambda x: block(x["i"]) == F.col("b"))
    used = used.filter((F.col("a") <= F.col("b")) | ~held).select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "used")
    here = lambda side: F.filter("used", lambda x: block(x["i"]) == F.col(side)).alias(f"in_{side}")
    rows = used.select("lang", "a", "b", here("a"), here("b"))
    for side in ("a", "b"):
        rows = rows.join(blocks.select("lang", F.col("block").alias(side), F.col("rest").alias(f"rest_{side}")), ["lang", side])
    parts = rows.select("lang", "a", "b", "in_a", "in_b", "rest_a", "rest_b").mapInArrow(_differences, _MATRIX)
    sums = parts.select("lang", F.explode("pairs").alias("x")).select("lang", "x.*").groupBy("lang", "i", "j").agg(F.sum("value").alias("more"))
    one, other = (groups.select("lang", F.col("i").alias(k), F.col("rest").alias(f"rest_{k}"), *more) for k, more in (("i", ["v"]), ("j", [])))
    pairs = one.join(other, "lang").filter("i <> j").join(sums, ["lang", "i", "j"], "left")
    base = F.expr("(rest_i - rest_j) * (rest_i - rest_j) div rest_j")
    return pairs.select("lang", "i", "j", (F.col("v") * base + F.coalesce("more", F.lit(0))).alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, shard_bytes: int = SHARD_BYTES, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` holds the other sources, part ``term`` the ``top`` terms above the language."""
    plain = lambda c: F.coalesce(field(c).cast("string"), F.lit(""))
    rows = payload(docs).select(plain(text_col).alias("text"), plain(lang_col).alias("lang"), plain(source_col).alias("source"))
    counts = frozen(term_counts(rows, shard_bytes), "divergence-counts")
    sources = frozen(rows.groupBy("lang", "source").count().select("lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("i")), "divergence-sources")
    each = counts.join(sources, ["lang", "source"])
    terms = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("i", "n")).alias("used"))  # a row per source
    terms = frozen(terms.filter(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    totals = terms.select("lang", F.explode("used").alias("u")).groupBy("lang", F.col("u.i").alias("i")).agg(F.sum("u.n").alias("total"))
    groups = sources.join(totals, ["lang", "i"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", "i", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    # without a kept term there is nothing to share; any p gives the sum 0
    groups = frozen(groups.withColumn("rest", F.when(F.col("v") > 0, share(0, "total", "v")).otherwise(1)), "divergence-groups")

    shares = terms.select("lang", "term", "n", F.explode("used").alias("u")).select("lang", "term", F.col("n").alias("lang_n"), "u.i", "u.n").join(groups, ["lang", "i"])
    shares = frozen(shares.select("lang", "source", "term", "i", share("n", "total", "v").alias("p"), share("lang_n", "lang_total", "v").alias("q")), "divergence-shares")
    above = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))

    used = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("i", "p")).alias("used"))
    named = [groups.select("lang", F.col("i").alias(k), F.col("source").alias(name)) for k, name in (("i", "source"), ("j", "item"))]
    pairs = pair_values(used, groups).join(named[0], ["lang", "i"]).join(named[1], ["lang", "j"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.union(pairs.withColumn("rank", F.row_number().over(order)))
