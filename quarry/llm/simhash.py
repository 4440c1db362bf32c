"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprint: lower-case A-Z, words between ASCII white space, word shingles
joined by a space, XXH64 (seed 42) of each; a bit is 1 if more than half of the
shingles, repeats included, have it.

Search: the 64 bits are split into m partitions of correlated bits.  If
thresholds t_1..t_m (each -1 or more) sum to radius - m + 1, two fingerprints
within ``radius`` bits differ by at most t_i bits in some partition i, so it is
enough to probe, in partition i, the values within t_i bits.  Bits are grouped
by their correlations, counted over all distinct fingerprints.  For every m the
thresholds come from dynamic programming over (partition, sum of thresholds)
on the estimated cost: probe rows plus candidate pairs, where the pairs at
distance 0 are counted exactly and those further away follow from the bit
statistics.  The cheapest m wins, so larger corpora get more selective probes.

Linking: only distinct fingerprints are searched.  First every member of a
bucket is compared with the bucket's smallest fingerprint, and the links found
are contracted to components.  Then, only in buckets that still hold several
components, probes are verified against members of other components, with the
bit distance as part of the join condition.  Every link either is found or lies
inside one component already, so components are exact, while a large group of
near copies costs a star and not all its pairs.

Defined results: a null or empty text has fingerprint 0 and is linked like any
other; a text of fewer words than a shingle has its whole word sequence as its
only shingle; rows without id are linked and get the smallest id of their
component (null if no row has one); repeated rows are in one component; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import components, field, frozen, payload

BITS = 64
SEED = 42
#: Cost of a probe row relative to a candidate pair.
PROBE_COST = 12.0
#: Bit patterns per partition and threshold are enumerated; larger radii per partition aren't considered.
MAX_THRESHOLD = 2
#: Layouts with more partitions than this aren't considered; radii up to 23 still have one.
MAX_PARTITIONS = 8

#: Lane table: byte -> 8 lanes of 8 bits, lane k holds bit k.
_LANES = np.array([sum(1 << 8 * k for k in range(8) if b >> k & 1) for b in range(256)], np.uint64)


def shingle_hashes(text: str, words_per_shingle: int) -> list[int]:
    words = text.encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return []
    if len(words) <= words_per_shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    return [xxhash.xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[words_per_shingle - 1:])]


def majority_bits(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per group of consecutive hashes (none empty), the bits set in more than half of them."""
    cuts = np.concatenate([np.arange(s, s + n, 255) for s, n in zip(starts, counts)])  # 8-bit lanes hold 255 hashes
    first = np.concatenate([[0], np.cumsum(-(-counts // 255))[:-1]])
    fp = np.zeros(len(starts), np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, byte]], cuts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for k in range(8):
            fp |= (2 * ones[:, k] > counts).astype(np.uint64) << np.uint64(8 * byte + k)
    return fp


def fingerprint_udf(words_per_shingle: int):
    @F.arrow_udf(T.LongType())
    def fingerprint(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), np.uint64)
        rows, hashes, counts = [], [], []

        def flush() -> None:
            if rows:
                n = np.array(counts)
                out[rows] = majority_bits(np.array(hashes, np.uint64), np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            for x in (rows, hashes, counts):
                x.clear()

        for i, t in enumerate(text):
            if own := shingle_hashes(t.as_py() or "", words_per_shingle):
                rows.append(i)
                hashes.extend(own)
                counts.append(len(own))
            if len(hashes) > 1 << 18:
                flush()
        flush()
        return pa.array(out.view(np.int64))

    return fingerprint


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together, over all of them."""

    def partial(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            fp = np.asarray(b.column("fp")).view(np.uint8)
            bits = np.unpackbits(fp.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(BITS)], pa.int32()), pa.array([[n], *total.tolist()], pa.list_(pa.int64()))], ["i", "counts"])

    sums = (fps.select("fp").mapInArrow(partial, "i int, counts array<long>")
            .select("i", F.posexplode("counts").alias("j", "n")).groupBy("i", "j").agg(F.sum("n").alias("n")).collect())
    got = {(r.i, r.j): r.n for r in sums}  # 64 x 64 numbers
    return got.get((-1, 0), 0), np.array([[got.get((i, j), 0) for j in range(BITS)] for i in range(BITS)], float)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal size; a partition grows by the bit most correlated with its bits."""
    p = np.diag(together) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / n - np.outer(p, p)) / np.outer(sd, sd))
    left, parts = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        own = [max(left, key=lambda b: (corr[b, list(left)].sum(), -b))]
        left.discard(own[0])
        while len(own) < size:
            own.append(max(left, key=lambda b: (corr[b, own].sum(), -b)))
            left.discard(own[-1])
        parts.append(sorted(own))
    return parts


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Dynamic programming: thresholds t_i from the keys of costs[i] with sum ``total`` and the least sum of costs."""
    best = {0: (0.0, [])}
    for c in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (v, ts) in best.items():
            for t, w in c.items():
                if s + t not in step or v + w < step[s + t][0]:
                    step[s + t] = (v + w, [*ts, t])
        best = step
    return best.get(total, (float("inf"), []))


def part_value(fp, bits: list[int]):
    """The bits of one partition, moved together."""
    runs: list[list[int]] = []
    for b in bits:
        if runs and runs[-1][0] + runs[-1][1] == b:
            runs[-1][1] += 1
        else:
            runs.append([b, 1])
    at, terms = 0, []
    for b, n in runs:
        terms.append(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit((1 << n) - 1 if n < 64 else -1)), at))
        at += n
    return reduce(lambda x, y: x.bitwiseOR(y), terms)


def plan(fps: DataFrame, radius: int) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds with the least estimated cost."""
    n, together = bit_statistics(fps)
    if n == 0:
        return [], []
    p = np.diag(together) / n
    layouts = [group_bits(n, together, m) for m in range(1, min(radius + 1, MAX_PARTITIONS) + 1)]
    values = [F.struct(F.lit(k).alias("l"), F.lit(i).alias("i"), part_value(F.col("fp"), bits).alias("v")) for k, parts in enumerate(layouts) for i, bits in enumerate(parts)]
    equal = {(r.l, r.i): float(r.pairs) for r in fps.select(F.explode(F.array(*values)).alias("x")).groupBy("x").count()
             .groupBy("x.l", "x.i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    plans = []
    for k, parts in enumerate(layouts):
        costs = []
        for i, bits in enumerate(parts):
            differ = 2 * p[bits] * (1 - p[bits])
            chance = np.zeros(MAX_THRESHOLD + 1)  # chance that 0, 1, .. bits differ, bits taken alone
            chance[0] = 1
            for q in differ:
                chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
                chance[0] *= 1 - q
            near = max(equal[k, i], n * (n - 1) / 2 * chance[0]) / max(chance[0], 1e-300)
            costs.append({-1: 0.0} | {t: PROBE_COST * n * sum(comb(len(bits), d) / (2 if d else 1) for d in range(t + 1)) + min(near * chance[:t + 1].sum(), n * n / 2)
                                      for t in range(min(MAX_THRESHOLD, radius) + 1)})
        plans.append((*allocate(costs, radius - len(parts) + 1), parts))
    _, thresholds, parts = min(plans, key=lambda x: x[0])
    return parts, thresholds


def probe_masks(width: int, threshold: int) -> list[tuple[int, int]]:
    """(bits to flip, highest of them) of every pattern up to ``threshold`` bits; each unordered pair needs one direction only."""
    return [(sum(1 << b for b in c), 1 << max(c)) for d in range(1, threshold + 1) for c in combinations(range(width), d)]


def links(fps: DataFrame, radius: int, parts: list[list[int]], thresholds: list[int]) -> DataFrame:
    """Components ``(node, root)`` of the fingerprints within ``radius`` bits of one another."""
    used = [(i, bits, t) for i, (bits, t) in enumerate(zip(parts, thresholds, strict=True)) if t >= 0]
    keys = F.array(*[F.struct(F.lit(i).alias("i"), part_value(F.col("fp"), bits).alias("v")) for i, bits, _ in used])
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius

    # the star of each bucket
    members = fps.select("fp", F.explode(keys).alias("k"))
    hubs = frozen(members.groupBy("k").agg(F.min("fp").alias("hub")), "hubs")  # written: a join at a hot key can be split
    star = members.join(hubs, "k").filter(F.col("fp") != F.col("hub")).filter(near("fp", "hub"))
    first = components(star.select(F.col("hub").alias("a"), F.col("fp").alias("b")))

    rooted = frozen(fps.join(first.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "rooted")
    held = rooted.select("fp", "root", F.explode(keys).alias("k"))

    # what is left: probes against members of other components
    def probes(i: int, bits: list[int], t: int):
        own = F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v"))
        if not t:
            return F.array(own)
        masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(h).cast("long").alias("h")) for m, h in probe_masks(len(bits), t)])
        flips = F.transform(F.filter(masks, lambda x: F.col(f"v{i}").bitwiseAND(x["h"]) == 0),
                            lambda x: F.struct(F.lit(i).alias("i"), F.col(f"v{i}").bitwiseXOR(x["m"]).alias("v")))
        return F.concat(F.array(own), flips)

    valued = rooted.select("fp", "root", *[part_value(F.col("fp"), bits).alias(f"v{i}") for i, bits, _ in used])
    sent = valued.select("fp", "root", F.explode(F.concat(*[probes(*u) for u in used])).alias("k"))
    buckets = frozen(held.groupBy("k").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "buckets")
    # a probe matters unless all members of its bucket are of its own component
    asked = sent.join(buckets, "k").filter((F.col("lo") != F.col("root")) | (F.col("hi") != F.col("root"))).select("k", F.col("fp").alias("fa"), F.col("root").alias("ra"))
    there = held.select("k", F.col("fp").alias("fb"), F.col("root").alias("rb"))
    found = asked.join(there, (asked.k == there.k) & (F.col("ra") != F.col("rb")) & near("fa", "fb"))
    second = components(found.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return (rooted.join(second.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
            .select(F.col("fp").alias("node"), F.coalesce("top", "root").alias("root")))


def near_components(docs: DataFrame, words: int, radius: int, id_col: str = "doc_id", text_col: str = "text", keep_payload: bool = True) -> DataFrame:
    """Every row: payload (if kept), id, fp, component_id, and ``kept`` for one row of each component.

    The row that stays is the one with the smallest id (rows without id last).
    """
    rows = payload(docs)
    own = ["payload"] if keep_payload else []
    rows = frozen(rows.select(*own, field(id_col).alias("id"), fingerprint_udf(words)(field(text_col)).alias("fp"), F.monotonically_increasing_id().alias("row")), "fingerprints")
    last = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    fps = frozen(rows.groupBy("fp").agg(F.min(last).alias("least")), "distinct-fps")
    parts, thresholds = plan(fps, radius)
    if not parts:
        roots = fps.select(F.col("fp").alias("node"), F.col("fp").alias("root"))
    else:
        roots = links(fps.select("fp"), radius, parts, thresholds)
    labelled = frozen(fps.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "least"), "labelled")
    ids = frozen(labelled.groupBy("root").agg(F.min("least").alias("least")), "component-ids")
    by_fp = labelled.select("fp", "root").join(ids, "root").select("fp", F.col("least.id").alias("component_id"), F.col("least.row").alias("keep_row"))
    return rows.join(by_fp, "fp").withColumn("kept", F.col("row") == F.col("keep_row")).drop("keep_row", "row")


def near_dedup(docs: DataFrame, words: int, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    return near_components(docs, words, radius, id_col, text_col).filter("kept").select("payload.*")
