"""Exact dedup: a minimal perfect hash over the distinct digests of the documents seen before.

The history (documents of earlier batches) is kept as an index table, one row
per bucket of digests.  A bucket with m digests has a minimal perfect hash (one
pilot per small sub-bucket) onto exactly m slots; a slot holds the full 32-byte
digest, the locator of the winner (document id and row key) and the group size.
A new batch is grouped by digest, each distinct digest is sent to the row of its
bucket, hashed to its slot and compared with the full digest there: equal means
a repeat of that slot's text, different means a nonmember.  Nonmembers group
among themselves.

Only digests (pre-aggregated: one row per distinct text and task) are shuffled;
texts stay where they are.  A text that makes up a third of the corpus is one
row per task in the groupings, and the join back onto its rows is a plain equi
join, which Spark splits by itself when skewed.

Defined results: a null text counts as empty and is grouped like any other; the
row with the largest id stays, rows without id lose against rows with one, and
among rows of the same id the one that comes last in the frozen table stays, so
exactly one row of each group is kept; empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import field, frozen, payload

#: Digests per bucket of the index, about; a bucket is one row and one group.
BUCKET_KEYS = 2048
#: Digests per sub-bucket that share a pilot, about.
PILOT_KEYS = 4
NO_ID = -(1 << 63)

INDEX = "bucket long, m int, seed int, pilots binary, digests binary, ids binary, rows binary, sizes binary"
GROUPS = "digest binary, keep_id long, keep_row long, size long, known boolean"


@F.arrow_udf(T.BinaryType())
def text_digest(text: pa.Array) -> pa.Array:
    """SHA-256 of each text with A-Z lower-cased (other letters stay), null as empty."""
    low = pc.ascii_lower(pc.fill_null(text, ""))
    return pa.array([hashlib.sha256(t.as_buffer()).digest() for t in low], pa.binary())


def _hashes(keys: np.ndarray, seed: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sub-bucket, position and step of each digest; digests are uniform, so mixing their words is enough."""
    w = keys.view("<u8").reshape(-1, 4)
    with np.errstate(over="ignore"):
        x = (w[:, 1] ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    subs = -(-m // PILOT_KEYS)
    return ((w[:, 2] % np.uint64(subs)).astype(np.int64), (x % np.uint64(m)).astype(np.int64), (w[:, 3] % np.uint64(m)).astype(np.int64))


def perfect_hash(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Seed, pilots and the slot of each of m distinct 32-byte keys: a bijection onto 0..m-1.

    A pilot a*m + b places a sub-bucket's keys at (position + a*step + b) mod m.
    Sub-buckets go largest first; all b are tried at once.
    """
    m = len(keys)
    for seed in range(1, 1000):
        sub, pos, step = _hashes(keys, seed, m)
        subs = -(-m // PILOT_KEYS)
        pilots, slots, free = np.zeros(subs, np.int64), np.full(m, -1, np.int64), np.ones(m, bool)
        order = np.argsort(sub, kind="stable")
        starts = np.searchsorted(sub[order], np.arange(subs + 1))
        for s in np.argsort(np.diff(starts), kind="stable")[::-1]:
            own = order[starts[s]:starts[s + 1]]
            if not len(own):
                break
            for a in range(64):
                base = (pos[own] + a * step[own]) % m
                if len(np.unique(base)) < len(base):
                    continue
                fits = free.copy() if not base[0] else np.roll(free, -base[0])
                for p in base[1:]:
                    fits &= np.roll(free, -p)
                if len(hit := np.flatnonzero(fits)[:1]):
                    slots[own] = (base + hit[0]) % m
                    free[slots[own]] = False
                    pilots[s] = a * m + hit[0]
                    break
            else:
                break
        else:
            return seed, pilots, slots
        if (slots >= 0).all():
            return seed, pilots, slots
    raise ValueError("digests repeat in a bucket")


def slots_of(keys: np.ndarray, seed: int, pilots: np.ndarray, m: int) -> np.ndarray:
    sub, pos, step = _hashes(keys, seed, m)
    pilot = pilots[sub]
    return (pos + (pilot // m) * step + pilot % m) % m


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32).copy()


def _build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    keys = _keys(rows["digest"])
    seed, pilots, slots = perfect_hash(keys)
    back = np.argsort(slots)
    col = lambda name: rows[name].to_numpy(np.int64)[back].tobytes()
    return pd.DataFrame([{"bucket": rows["bucket"].iloc[0], "m": len(keys), "seed": seed, "pilots": pilots.tobytes(),
                          "digests": keys[back].tobytes(), "ids": col("id"), "rows": col("row"), "sizes": col("n")}])


def _lookup_bucket(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Groups of one bucket: its slots with the hits of the new batch merged in, then the nonmembers."""
    probes = _keys(new["digest"]) if len(new) else np.zeros((0, 32), np.uint8)
    ids, rows, sizes = (new[c].to_numpy(np.int64) for c in ("id", "row", "n"))
    parts, member = [], np.zeros(len(probes), bool)
    if len(index):
        x = index.iloc[0]
        held = np.frombuffer(x["digests"], np.uint8).reshape(-1, 32)
        h_id, h_row, h_n = (np.frombuffer(x[c], np.int64).copy() for c in ("ids", "rows", "sizes"))
        if len(probes):
            slot = slots_of(probes, int(x["seed"]), np.frombuffer(x["pilots"], np.int64), int(x["m"]))
            member = (held[slot] == probes).all(axis=1)
            at, i, r = slot[member], ids[member], rows[member]
            wins = (i > h_id[at]) | (i == h_id[at]) & (r > h_row[at])
            h_id[at[wins]], h_row[at[wins]] = i[wins], r[wins]
            h_n[at] += sizes[member]
        parts.append(pd.DataFrame({"digest": [d.tobytes() for d in held], "keep_id": h_id, "keep_row": h_row, "size": h_n, "known": True}))
    out = ~member
    parts.append(pd.DataFrame({"digest": [d.tobytes() for d in probes[out]], "keep_id": ids[out], "keep_row": rows[out], "size": sizes[out], "known": False}))
    return pd.concat(parts)


def distinct_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest of ``(digest, id, row)`` rows: winner, size, bucket of the index."""
    best = F.max(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "row"))
    return (rows.groupBy("digest").agg(best.alias("w"), F.count("*").alias("n"))
            .select("digest", F.col("w.id").alias("id"), F.col("w.row").alias("row"), "n",
                    F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets)).alias("bucket")))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index table over ``(digest, id, row)`` rows of earlier batches."""
    return distinct_digests(history, buckets).groupBy("bucket").applyInPandas(_build_bucket, INDEX)


def lookup(new: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Groups by digest (``GROUPS``) of history and new batch together."""
    probes = distinct_digests(new, buckets).groupBy("bucket")
    return probes.cogroup(index.groupBy("bucket")).applyInPandas(_lookup_bucket, GROUPS)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history=None, keep_payload: bool = True) -> DataFrame:
    """Every row of ``docs`` with its group: payload, id, digest, keep_id, size, kept.

    ``history`` is a condition on the column ``id`` that names the rows of
    earlier batches; by default those in the lower half of the id range.
    """
    rows = payload(docs)
    wanted = {"payload": F.col("payload")} if keep_payload else {}
    rows = frozen(rows.select(*[c.alias(n) for n, c in wanted.items()], field(id_col).alias("id"),
                              text_digest(field(text_col)).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    keys = rows.select("id", "digest", "row")
    if history is None:
        lo, hi = keys.agg(F.min("id"), F.max("id")).first()
        history = F.lit(False) if lo is None else F.col("id") <= F.lit((lo + hi) // 2)
    old = F.coalesce(history, F.lit(False))
    buckets = max(1, keys.count() // BUCKET_KEYS)
    index = frozen(build_index(keys.filter(old), buckets), "index")
    groups = lookup(keys.filter(~old), index, buckets)
    joined = rows.join(groups, "digest")
    return joined.withColumns({
        "keep_id": F.when(F.col("keep_id") != NO_ID, F.col("keep_id")),
        "kept": (F.col("row") == F.col("keep_row")),
    }).drop("keep_row", "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    return exact_groups(docs, id_col, text_col).filter("kept").select("payload.*")
