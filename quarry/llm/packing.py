"""Packing: shortest-pack-first over the length histogram.

Each document is tokenised and ended by one id.  Whole multiples of the sequence
length are sequences of their own; the remainders are packed.  The packer sees
only the histogram of remainder lengths (at most ``length`` - 1 numbers, so it
runs in the driver whatever the corpus is) and works on groups of equal packs:
lengths go longest first, each onto the pack group with the most free space, as
often as it fits there; a group is split where its packs get different numbers.
Where nothing fits, new packs are opened, but never more than the tokens need
plus a share ``SLACK`` of them: so many sequences there are at most, whatever
the histogram.

Lengths that find no pack any more are laid end to end over the free spaces,
themselves laid end to end with the largest first, and cut where a space ends.
A pack group's free space more than halves each time it is visited, so the work
is bounded by the number of lengths, not by that of documents.

The answer is a list of placements: of the documents with remainder length l,
those of rank a to b lie whole in the sequences q, q + 1, ..., round by round,
or in pieces along the free spaces of a pack group from a place of the line on.
Documents are ranked within their length by a two-level numbering (a hot length
is spread over blocks) and joined to their placements by length and block of
ranks; ids meet their placements by an equi join on the row key.  Until then ids
take 16 bits where the vocabulary allows it.

Defined results: null and empty texts have the end id only; rows without id and
repeated rows are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
from math import isqrt
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.bpe import byte_alphabet
from quarry.llm.common import field, frozen, numbered, payload
from quarry.llm.fragments import Fragments

#: Sequences beyond those the tokens need, as a share of them: spaces of a few ids may then stay empty.
SLACK = 0.0005

# byte classes: white space, letters, digits, apostrophe, other ASCII, rest
_SPACE, _LETTER, _DIGIT, _APOSTROPHE, _SIGN, _WIDE = range(6)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[128:] = _WIDE
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[39] = _APOSTROPHE
#: The pre-tokenizer never joins these neighbours: white space is dropped, digits stand alone,
#: letters and other signs don't mix; an apostrophe may start a contraction, so nothing is cut beside it.
_SPLIT = np.zeros((6, 6), bool)
_SPLIT[_SPACE, 1:] = _SPLIT[1:, _SPACE] = True
for _a, _b in ((_LETTER, _DIGIT), (_LETTER, _SIGN), (_DIGIT, _SIGN)):
    _SPLIT[_a, _b] = _SPLIT[_b, _a] = True
_SPLIT[_DIGIT, _DIGIT] = True


_KINDS = _CLASS.tobytes()
#: Whether to cut between bytes of two classes, by 6 * first + second; and the same for white space alone.
_WHITE = np.arange(6) == _SPACE
_CUT, _CUT_WHITE = (np.resize(np.append(t.ravel(), np.zeros(220, bool)), 256).astype(np.uint8).tobytes() for t in (_SPLIT, _WHITE[:, None] ^ _WHITE[None, :]))
_UPPER = np.isin(np.arange(256), np.arange(65, 91)).astype(np.uint8).tobytes()


def word_cuts(special: list[bytes]):
    """Cuts for a lower-casing tokenizer that drops white space.

    A-Z are lower-cased here already, except before a byte of a wider character,
    which could be a combining mark.  A batch that holds a special token's
    string is cut at white space only.
    """

    def cuts(data: np.ndarray, offsets: np.ndarray):
        raw = data.tobytes()
        plain = not any(s in raw for s in special)
        kind = np.frombuffer(raw.translate(_KINDS), np.uint8)
        if plain:
            upper = np.frombuffer(raw.translate(_UPPER), np.uint8)
            before_wide = np.append(kind[1:] == _WIDE, False)
            data = data + (upper & ~before_wide) * np.uint8(32)
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = np.frombuffer((kind[:-1] * np.uint8(6) + kind[1:]).tobytes().translate(_CUT if plain else _CUT_WHITE), bool)
        cut[offsets] = True
        at = np.flatnonzero(cut)
        held = kind[at[:-1]] != _SPACE
        return data, at[:-1][held], at[1:][held]

    return cuts


_LETTERS = {byte: letter for letter, byte in byte_alphabet().items()}
#: Lower-case letters that no normalisation changes: a-z and those of Latin-1.
_PLAIN_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def whole_word(fragment: str) -> str | None:
    """A word of plain letters; its bytes stand for themselves, by their letters of the vocabulary."""
    if not _PLAIN_WORD.fullmatch(fragment):
        return None
    return fragment if fragment.isascii() else "".join([_LETTERS[b] for b in fragment.encode()])


def id_type(tokenizer_json: str) -> str:
    """Little-endian unsigned 16 bits if all ids fit, else 32."""
    t = json.loads(tokenizer_json)
    return "<u2" if max([*t["model"]["vocab"].values(), *[a["id"] for a in t["added_tokens"]]]) < 1 << 16 else "<u4"


def encode_udf(tokenizer_path: str, end_id: int):
    """Ids of a text and the end id, in the type ``id_type`` gives."""
    model = Path(tokenizer_path).read_text(encoding="utf-8")
    kind = id_type(model)

    @F.arrow_udf(T.BinaryType())
    def encode(text: pa.Array) -> pa.Array:
        worker = Fragments.of(model, whole_word)
        special = [t.content.encode() for t in worker.tokenizer.get_added_tokens_decoder().values()]
        end = np.array([end_id], kind).tobytes()
        return pa.array([ids.astype(kind).tobytes() + end for part in worker.encode(text, word_cuts(special)) for ids in part], pa.binary())

    return encode


def widen_udf(kind: str):
    """Ids of the type ``kind`` as unsigned 32-bit integers."""
    @F.arrow_udf(T.BinaryType())
    def widen(ids: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(i, kind).astype("<u4").tobytes() for i in ids.to_pylist()], pa.binary())

    return widen


class Placement(NamedTuple):
    """Documents of remainder length ``rem`` with ranks lo <= r < hi.

    Without ``free``, they lie whole in the ``many`` sequences from ``sequence`` on, one after the other and round by
    round, the first round at ``offset``.  With it, rank r covers the places from ``at`` + r * rem on of the line of
    free spaces, of which the places from ``base`` on are ``free`` in each of these sequences, behind ``offset``.
    """

    rem: int
    lo: int
    hi: int
    sequence: int
    many: int
    offset: int
    free: int | None = None
    at: int = 0
    base: int = 0


def pack_histogram(counts: dict[int, int], length: int, slack: float = SLACK) -> tuple[list[Placement], int]:
    """Placements for ``counts[l]`` documents of each remainder length l < length, and the number of sequences."""
    tokens = sum(l * n for l, n in counts.items())
    most = -(-tokens // length) + int(slack * tokens / length)
    packs: list[tuple[int, int, int]] = []  # (-free, first sequence, packs)
    sequences = 0
    out: list[Placement] = []
    over: list[tuple[int, int, int]] = []
    for l in sorted((l for l, n in counts.items() if l and n), reverse=True):
        lo, n = 0, counts[l]
        while lo < n:
            if not packs or -packs[0][0] < l:
                new = min(-(-(n - lo) // (length // l)), most - sequences)
                if not new:
                    over.append((l, lo, n))
                    break
                heapq.heappush(packs, (-length, sequences, new))
                sequences += new
            free, first, many = heapq.heappop(packs)
            free = -free
            per = free // l
            width = min(many, -(-(n - lo) // per))
            k = min(n - lo, width * per)
            out.append(Placement(l, lo, lo + k, first, width, length - free))
            lo += k
            each, more = divmod(k, width)  # the first ``more`` packs got one more
            for left, start, end in ((free - (each + 1) * l, 0, more), (free - each * l, more, width), (free, width, many)):
                if left and start < end:
                    heapq.heappush(packs, (-left, first + start, end - start))
    packs.sort()
    base = at = 0  # places on the line of free spaces
    for l, lo, hi in over:
        at -= lo * l
        while lo < hi:
            free, first, many = packs[0]
            end = base - free * many
            upto = min(hi, -(-(end - at) // l))
            out.append(Placement(l, lo, upto, first, many, length + free, -free, at, base))
            lo = min(hi, (end - at) // l)  # the last one may go on in the next group
            if end <= at + hi * l:
                base = end
                packs.pop(0)
        at += hi * l
    return out, sequences


def placed(rows: DataFrame, length: int) -> DataFrame:
    """``(row, pieces)``: pieces of (start, length, sequence_id, offset); ``rows`` (row, n) must be frozen."""
    spark = rows.sparkSession
    split = rows.select("row", (F.col("n") % length).cast("int").alias("rem"), F.floor(F.col("n") / length).alias("full"))
    histogram = split.groupBy("rem").agg(F.count("*").alias("docs"), F.sum("full").alias("full")).orderBy("rem").collect()  # one row per length below the sequence length
    placements, sequences = pack_histogram({r.rem: r.docs for r in histogram}, length)
    base, bases = sequences, []
    for r in histogram:
        bases.append((r.rem, base))
        base += r.full
    ranked = numbered(split, "rem", ["row"], "rank", {"full": "full_before"})
    ranked = ranked.join(F.broadcast(spark.createDataFrame(bases, "rem int, base long")), "rem")

    block = max(1024, isqrt(sum(r.docs for r in histogram)))
    kinds = [pa.int64()] * len(Placement._fields)
    cols = [pa.array(c, k) for c, k in zip(zip(*placements, strict=True) if placements else [()] * len(kinds), kinds, strict=True)]
    given = spark.createDataFrame(pa.table(cols, [f"p_{c}" for c in Placement._fields]))
    given = given.select("*", F.explode(F.sequence(F.floor(F.col("p_lo") / block), F.floor((F.col("p_hi") - 1) / block))).alias("block"))
    here = (F.col("rem") == F.col("p_rem")) & (F.floor(F.col("rank") / block) == F.col("block")) & (F.col("rank") >= F.col("p_lo")) & (F.col("rank") < F.col("p_hi"))
    piece = lambda start, n, sequence, offset: F.struct(
        (F.col("full") * length + start).alias("start"), n.cast("long").alias("length"), sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
    nth, of_line = F.col("rank") - F.col("p_lo"), F.col("p_at") + F.col("rank") * F.col("rem") - F.col("p_base")
    uncut = F.array(piece(F.lit(0), F.col("rem"), F.col("p_sequence") + nth % F.col("p_many"), F.col("p_offset") + F.floor(nth / F.col("p_many")) * F.col("rem")))
    spaces = F.sequence(F.greatest(F.lit(0), F.floor(of_line / F.col("p_free"))), F.least(F.col("p_many") - 1, F.floor((of_line + F.col("rem") - 1) / F.col("p_free"))))

    def part(j):
        begin, end = F.greatest(j * F.col("p_free"), of_line), F.least((j + 1) * F.col("p_free"), of_line + F.col("rem"))
        return piece(begin - of_line, end - begin, F.col("p_sequence") + j, F.col("p_offset") + begin - j * F.col("p_free"))

    pieces = F.when(F.col("p_free").isNull(), uncut).otherwise(F.transform(F.when(F.col("p_free").isNotNull(), spaces), part))
    parts = ranked.join(given, here).groupBy("row").agg(F.flatten(F.collect_list(pieces)).alias("parts"))  # as many as cuts of one document
    whole = F.transform(F.when(F.col("full") > 0, F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).otherwise(F.array().cast("array<long>")), lambda i: F.struct(
        (i * length).alias("start"), F.lit(length).cast("long").alias("length"), (F.col("base") + F.col("full_before") + i).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return ranked.join(parts, "row", "left").select("row", F.concat(whole, F.coalesce("parts", F.array().cast(parts.schema["parts"].dataType))).alias("pieces"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids (binary, little-endian unsigned 32 bits), doc_tokens, sequence_id, offset."""
    kind = id_type(Path(tokenizer_path).read_text(encoding="utf-8"))
    width = np.dtype(kind).itemsize
    tokens = payload(docs).select(field(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), encode_udf(tokenizer_path, end_id)(field(text_col)).alias("ids"))
    tokens = frozen(tokens.withColumn("n", F.floor(F.length("ids") / width)), "tokens")
    plan = placed(tokens.select("row", "n"), length)
    each = tokens.join(plan, "row").select("id", "ids", "n", F.explode("pieces").alias("p"))
    cut = F.expr(f"substring(ids, cast({width} * p.start + 1 as int), cast({width} * p.length as int))")
    cut = cut if kind == "<u4" else widen_udf(kind)(cut)
    return each.select("id", "p.start", "p.length", cut.alias("ids"), F.col("n").alias("doc_tokens"), "p.sequence_id", "p.offset")
