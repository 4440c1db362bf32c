"""Quality classifier: Bradley-Terry pairwise ranking.

A document's utility is w.x over features of its whole text; the chance that
document i is preferred to j is the logistic function of w.(x_i - x_j).  All pairs
of a document labelled 1 and one labelled 0 are preferences; w minimises their
mean logistic loss on the feature differences with a small penalty.  The threshold
is the quantile of the training utilities at the share of label 0, and the score is
a logistic function of the utility that is ``cut`` at that quantile, so scores
from ``cut`` up are predicted 1.

Features of all documents are computed in one pass that moves no rows and are
written without the texts; where the rows themselves are wanted, a second pass
computes them again rather than keep a copy of the table.  The model is fitted on
all labelled rows without listing their pairs: a Newton step takes two passes of
sums over the rows.  One gives the number and feature sum of each label's rows by
bins of the utility, at most 2 x ``BINS``, of which the gradient over all pairs is
made (a pair's chance is expanded to the second order around the means of its two
bins); the other gives the second moments, weighted by bin.  The quantile is exact, from counts by
leading bits.  Only these sums and counts reach the driver.  Ids, labels and other
columns are no features.

Defined results: a null text counts as empty, and empty texts have features too;
labels other than 0 and 1, nulls, and ids whose labels contradict one another
aren't learned from; without both labels every score is ``cut``, so nothing is
rejected; repeated rows get the same score; rows without id are scored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import discard, field, frozen, payload

#: Bins of the utility, at most, and their least width.
BINS = 1024
BIN_WIDTH = 1 / 16
PENALTY = 1e-3
CUT = 0.3

#: Byte classes: letters, upper case, digits, white space, line ends, sentence ends, commas, other signs, wide characters.
_CLASSES = np.zeros((256, 9), np.float64)
for _k, _bytes in enumerate(("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\r\x0b\x0c", "\n", ".!?", ",;:", "|#$%&*+=<>@^_~\\/{}[]")):
    _CLASSES[list(_bytes.encode()), _k] = 1
_CLASSES[128:, 8] = 1

NAMES = ["log_words", "log_bytes", "letters", "upper", "digits", "white", "line_ends", "sentence_ends", "commas", "signs", "wide",
         "bars", "bangs", "word_bytes", "distinct_words", "top_word", "repeated_next", "distinct_lines", "line_words", "sentence_words", "short_text", "capital_words", "sign_words"]


def features(text: str) -> list[float]:
    raw = text.encode()
    words = raw.split()
    n, m = max(1, len(raw)), max(1, len(words))
    share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / n
    lines = [x for x in text.split("\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    again = sum(map(bytes.__eq__, words, words[1:]))
    ends = max(1, raw.count(b". ") + raw.count(b".\n") + raw.count(b"? ") + raw.count(b"! "))
    return [np.log1p(len(words)), np.log1p(len(raw)), *share, raw.count(b"|") / m, raw.count(b"!") / m, len(raw) / m / 10,
            len(seen) / m / np.sqrt(1 / min(m, 400)) / 20, max(seen.values(), default=0) / m, again / m,
            len(set(lines)) / max(1, len(lines)), np.log1p(m / max(1, len(lines))), np.log1p(m / ends), float(len(words) < 20),
            sum(map(bytes.isupper, words)) / m, sum(not w.isalnum() and not w[:-1].isalnum() for w in words) / m]


@F.arrow_udf(T.ArrayType(T.FloatType()))
def feature_udf(text: pa.Array) -> pa.Array:
    return pa.array([features(t.as_py() or "") for t in text], pa.list_(pa.float32()))


#: Sums over training rows by key: the keys and the vector to add for each, of the features and labels of some rows.
Part = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    found, first = np.unique(keys[order], return_index=True)
    return found, np.add.reduceat(values[order], first, axis=0) if len(found) else values


def standard(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / sd, -8, 8)
    return np.hstack([z, z**2 / 8])  # too little and too much can both be bad


def _solve(sums: Callable[[Part, int, int], np.ndarray], d: int) -> dict:
    """The model; ``sums(part, size, width)`` gives the sums of ``part`` over all rows for the keys below ``size``."""
    n, total, square = np.split(sums(lambda x, y: grouped(y, np.hstack([np.ones((len(x), 1)), x, x**2])), 2, 1 + 2 * d), [1, 1 + d], axis=1)
    if not n.all():
        return {"weights": [0.0] * d, "quantile": 0.0, "scale": 1.0}
    mean = total.sum(axis=0) / n.sum()
    sd = np.sqrt(np.maximum(0, square.sum(axis=0) / n.sum() - mean**2)) + 1e-6
    mean, sd = mean.astype(np.float32).astype(float), sd.astype(np.float32).astype(float)
    w = np.zeros(2 * d)
    for _ in range(30):  # Newton steps on the logistic loss of all differences
        half = BINS // 2
        width = max(BIN_WIDTH, 8 * np.abs(w).sum() / half)  # no utility is over 8 x the sum of the weights

        def bins(x: np.ndarray, y: np.ndarray, w=w, width=width) -> tuple[np.ndarray, np.ndarray]:
            z = standard(x, mean, sd)
            return y * BINS + np.clip(np.floor((z * w).sum(axis=1) / width).astype(int) + half, 0, BINS - 1), z

        def first(x: np.ndarray, y: np.ndarray, bins=bins, w=w) -> tuple[np.ndarray, np.ndarray]:
            key, z = bins(x, y)
            return grouped(key, np.hstack([np.ones((len(z), 1)), z, z * (z * w).sum(axis=1)[:, None]]))

        table = sums(first, 2 * BINS, 1 + 4 * d)
        (n0, s0, c0), (n1, s1, c1) = (np.split(t, [1, 1 + 2 * d], axis=1) for t in (table[:BINS], table[BINS:]))
        n0, n1 = n0[:, 0], n1[:, 0]
        u0, u1 = ((s @ w) / np.maximum(n, 1) for n, s in ((n0, s0), (n1, s1)))
        c0, c1 = c0 - u0[:, None] * s0, c1 - u1[:, None] * s1  # with the distance from the mean of the bin
        v0, v1 = c0 @ w, c1 @ w
        miss = 1 / (1 + np.exp(np.clip(u1[:, None] - u0[None, :], -30, 30)))  # chance of the wrong order
        slope = miss * (1 - miss)
        pairs = n0.sum() * n1.sum()
        curve = slope * (1 - 2 * miss) / 2
        grad0 = (n1 @ miss + v1 @ curve + (n1 @ curve) * v0 / np.maximum(n0, 1)) @ s0 + (n1 @ slope) @ c0
        grad1 = (miss @ n0 + curve @ v0 + (curve @ n0) * v1 / np.maximum(n1, 1)) @ s1 - (slope @ n0) @ c1
        grad = (grad0 - grad1) / pairs + PENALTY * w
        weight = np.concatenate([n1 @ slope, slope @ n0])

        def second(x: np.ndarray, y: np.ndarray, bins=bins, weight=weight) -> tuple[np.ndarray, np.ndarray]:
            key, z = bins(x, y)
            return np.arange(2 * d), (z * weight[key][:, None]).T @ z

        cross = s1.T @ slope @ s0
        step = np.linalg.solve((sums(second, 2 * d, 2 * d) - cross - cross.T) / pairs + PENALTY * np.eye(2 * d), grad)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    # rounded, so that the order of additions doesn't show
    return {"mean": mean.tolist(), "sd": sd.tolist(), "weights": np.round(w, 6).tolist(), "scale": 1.0, "share": float(n[0, 0] / n.sum())}


def utilities(x: np.ndarray, model: dict) -> np.ndarray:
    return (standard(x, np.array(model["mean"]), np.array(model["sd"])) * np.array(model["weights"])).sum(axis=1)  # the same for a row in any batch


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Weights (bias-free) and the quantile of the utilities; x holds one row per labelled document."""

    def sums(part: Part, size: int, width: int) -> np.ndarray:
        out = np.zeros((size, width))
        key, value = part(x, np.asarray(y, int))
        out[key] += value
        return out

    model = _solve(sums, x.shape[1])
    return model if "mean" not in model else model | {"quantile": float(np.quantile(utilities(x, model), model["share"]))}


def matrix(x: pa.Array) -> np.ndarray:
    return np.asarray(x.flatten(), np.float64).reshape(len(x), len(NAMES))


def fit_rows(rows: DataFrame) -> dict:
    """``fit`` of a table (x, y) of any size, which is read several times."""

    def sums(part: Part, size: int, width: int) -> np.ndarray:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, used = np.zeros((size, width)), np.zeros(size, bool)
            for b in batches:
                if len(b):
                    key, value = part(matrix(b.column("x")), np.asarray(b.column("y"), int))
                    out[key] += value
                    used[key] = True
            key = np.flatnonzero(used)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32) * width), pa.array(out[key].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(key), vectors], ["key", "v"])

        got = rows.select("x", "y").mapInArrow(partial, "key long, v array<double>").groupBy("key").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("v")).toArrow()
        out = np.zeros((size, width))
        out[got.column("key").to_numpy()] = np.asarray(got.column("v").combine_chunks().flatten()).reshape(len(got), width)
        return out

    model = _solve(sums, len(NAMES))
    if "mean" not in model:
        return model

    @F.arrow_udf(T.LongType())
    def ordered(x: pa.Array) -> pa.Array:  # whole numbers in the order of the utilities
        bits = (utilities(matrix(x), model) + 0.0).view(np.int64)
        return pa.array(bits ^ ((bits >> 63) & np.int64((1 << 63) - 1)))

    keys = frozen(rows.select(ordered("x").alias("u")), "utilities")
    quantile = _quantile(keys, model["share"])
    discard(keys)
    return model | {"quantile": quantile}


def _quantile(keys: DataFrame, share: float) -> float:
    """As ``np.quantile`` of the doubles that ``u`` stands for."""
    place = (keys.count() - 1) * share
    rank, left = int(place), keys
    for bits in (48, 32, 16, 0):  # the row of this rank is in one of at most 65536 groups
        at = F.shiftright("u", bits)
        counts = left.groupBy(at.alias("g")).count().toArrow().sort_by("g")
        upto = np.cumsum(counts.column("count").to_numpy())
        k = int(np.searchsorted(upto, rank, side="right"))
        rank -= int(upto[k - 1]) if k else 0
        left = left.filter(at == counts.column("g")[k].as_py())
    low = counts.column("g")[k].as_py()
    high = low if rank + 1 < counts.column("count")[k].as_py() or place == int(place) else keys.filter(F.col("u") > low).agg(F.min("u")).first()[0]
    value = lambda key: float(np.array([key ^ ((key >> 63) & ((1 << 63) - 1))], np.int64).view(np.float64)[0])
    return value(low) + (value(high) - value(low)) * (place - int(place))


def scores(x: np.ndarray, model: dict, cut: float) -> np.ndarray:
    if "mean" not in model:
        return np.full(len(x), cut)
    u = utilities(x, model)
    return 1 / (1 + np.exp(-np.clip(model["scale"] * (u - model["quantile"]) + np.log(cut / (1 - cut)), -500, 500)))


def score_udf(model: dict, cut: float):
    @F.arrow_udf(T.DoubleType())
    def score(x: pa.Array) -> pa.Array:
        return pa.array(scores(matrix(x), model, cut))

    return score


def training_rows(featured: DataFrame, labels: DataFrame, keep) -> DataFrame:
    """Features and labels of all rows that may be learned from."""
    clean = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y")).filter("id is not null and y in (0, 1)")
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("hi")).filter("y = hi"))
    return featured.select("id", "x").join(clean.filter(keep), "id").select("x", "y")


def score_documents(docs: DataFrame, labels: DataFrame, keep=None, cut: float = CUT,
                    id_col: str = "doc_id", text_col: str = "text", keep_payload: bool = True) -> DataFrame:
    """Every row: payload (if kept), id, score, predicted.

    ``labels`` has doc_id and quality; ``keep`` is a condition on the column
    ``id`` for rows that may be learned from (all by default).
    """
    rows = payload(docs).select("payload", field(id_col).alias("id"))
    featured = frozen(rows.select("id", feature_udf(field(text_col)).alias("x")), "features")
    learned = frozen(training_rows(featured, labels, F.lit(True) if keep is None else keep), "training")
    model = fit_rows(learned)
    discard(learned)
    scored = rows.withColumn("x", feature_udf(field(text_col))) if keep_payload else featured
    return scored.withColumn("score", score_udf(model, cut)("x")).withColumn("predicted", (F.col("score") >= cut).cast("int")).drop("x")


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows predicted 1, with the columns of ``docs``."""
    return score_documents(docs, labels, None, cut, id_col=id_col, text_col=text_col).filter("predicted = 1").select("payload.*")
