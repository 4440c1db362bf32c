"""Substring dedup: every run of consecutive sentences is hashed and matched globally.

Words are runs of characters that aren't white space; in scripts written without
spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every character is one.  A
sentence begins after . ! or ? (with closing quotes or brackets) and white
space, after a full-width stop, or on a new line.  One of more than
``UNIT_WORDS`` words is cut where the words say so: before a word whose hash with
its neighbour is the smallest of ``CUT_WORDS`` boundaries in a row (winnowing),
so from the first 12 to the last 12 words of a passage the cuts are the same
wherever it stands, also spliced into the middle of a sentence; where one pair
of words repeats on and on, only every 12th place is cut.

From each unit starts the shortest run of at least two units with at least
``min_words`` words, and at each unit ends the shortest such run: so no tail of
a repeated passage is missed.  With ``min_words`` 2 every run of two sentences
counts, also formulas that many clean texts share.  A run's key is its words in
order, whatever white space is between them.  What any non-first occurrence of a
repeated run covers is removed; the first one has the smallest id, then text
key, then place.

Work is vectorised over the characters of many texts at once: word hashes are
differences of prefix sums over characters, run keys (128 bits) the same over
words, and runs are found by binary search in the running number of words.

Defined results: null and empty texts and texts under two units or ``min_words``
words stay as they are (null stays null); rows that agree in id and text count
as one document and get the same result; rows without id come after all others;
a text may become empty, its row stays; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices
from quarry.llm.runs import CUT, RUN, with_text, without_repeats

MIN_UNITS = 2
MIN_WORDS = 20
#: Sentences over so many words are cut, at one of every ``CUT_WORDS`` boundaries in a row at least.
UNIT_WORDS = 16
CUT_WORDS = 12
#: Bytes of text worked on at a time; the arrays beside it take some hundred bytes for each.
SLICE_BYTES = 1 << 18

#: Characters that are words: Thai and Lao, Burmese, Khmer, kana, ideographs.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]
STOPS, WIDE_STOPS, CLOSING = ".!?", "。！？｡", "\"'”’)]」』）】》〉"

_OTHER, _SPACE, _WORD, _STOP, _WIDE, _CLOSE = range(6)
# odd multipliers of the prefix sums: characters to words, words to two run keys
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_U = np.uint64


@cache
def _classes() -> np.ndarray:
    kind = np.zeros(0x110000, np.uint8)
    kind[[c for c in range(0x3001) if chr(c).isspace()]] = _SPACE
    for a, b in UNSPACED:
        kind[a:b + 1] = _WORD
    for chars, k in ((STOPS, _STOP), (WIDE_STOPS, _WIDE), (CLOSING, _CLOSE)):
        kind[[ord(c) for c in chars]] = k
    return kind


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n modulo 2**64."""
    if base not in _powers or len(_powers[base]) <= n:
        rows = np.full(max(n + 1, 1 << 16), base, _U)
        rows[0] = 1
        _powers[base] = np.multiply.accumulate(rows)
    return _powers[base][:n + 1]


def spans_hash(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` of each span, wherever it lies, from differences of prefix sums modulo 2**64."""
    n = len(values)
    sums = np.zeros(n + 1, _U)
    np.cumsum(values * powers(base, n)[:n], out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mixed((sums[ends] - sums[starts]) * powers(inverse, n)[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Units(NamedTuple):
    """Units of several texts: ``text`` they are in, characters ``start`` to ``end`` there, their first ``word``;
    ``words``: hashes of all words.  ``word`` has one more entry, the number of words."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray
    words: np.ndarray


def segmented(texts: list[str]) -> Units:
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(length)])
    n = int(offsets[-1])
    code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    kind = _classes()[code]
    space, own = kind == _SPACE, kind == _WORD
    begins = np.zeros(n + 1, bool)  # a text begins here
    begins[offsets] = True
    edge = ~space
    edge[1:] &= space[:-1] | own[1:] | own[:-1] | begins[1:-1]
    first = np.flatnonzero(edge)  # of each word
    if not len(first):
        return Units(*[np.zeros(0, np.int64)] * 3, np.zeros(1, np.int64), np.zeros(0, _U))
    stop = edge | space | begins[:-1]
    stops = np.append(np.flatnonzero(stop), n)
    last = stops[np.searchsorted(stops, first, side="right")]
    words = spans_hash(mixed(code.astype(_U) + _U(1)), _BASES[0], first, last)
    text = np.searchsorted(offsets, first, side="right") - 1

    at = np.arange(n)
    solid = np.maximum.accumulate(np.where(space, -1, at))  # the last character that isn't white space
    bare = np.maximum.accumulate(np.where(kind == _CLOSE, -1, at))  # the last that closes nothing
    lines = np.concatenate([[0], np.cumsum(code == 10)])
    before = solid[np.maximum(first - 1, 0)]
    sign = bare[np.maximum(before, 0)]
    sign_kind = np.where(sign >= offsets[text], kind[np.maximum(sign, 0)], _OTHER)
    opens = np.ones(len(first), bool)
    opens[1:] = text[1:] != text[:-1]
    sentence = opens | (lines[first] > lines[before + 1]) | (sign_kind == _WIDE) | (sign_kind == _STOP) & (before < first - 1)
    unit = np.flatnonzero(sentence | _cuts(words, sentence))
    start = np.where(opens[unit], 0, first[unit] - offsets[text[unit]])
    closes = np.append(opens[unit][1:], True)
    end = np.where(closes, length[text[unit]], np.append(start[1:], 0))
    return Units(text[unit], start, end, np.append(unit, len(first)), words)


def _cuts(words: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """The words before which a long sentence is cut."""
    number = np.cumsum(sentence) - 1
    inner = ~sentence & (np.bincount(number) > UNIT_WORDS)[number]
    key = mixed(np.concatenate([[_U(0)], words[:-1]]) * _U(_BASES[1]) + words)
    reach = np.zeros(len(words), np.int64)
    left, right = inner.copy(), inner.copy()
    for d in range(1, CUT_WORDS):  # boundaries to both sides that aren't smaller (to the right: greater)
        left[:d] = right[-d:] = False
        left[d:] &= inner[:-d] & (number[:-d] == number[d:]) & (key[:-d] >= key[d:])
        right[:-d] &= inner[d:] & (number[d:] == number[:-d]) & (key[d:] > key[:-d])
        reach += left
        reach += right
    same = np.zeros(len(words), bool)
    same[1:] = inner[1:] & inner[:-1] & (key[1:] == key[:-1])
    at = np.arange(len(words))
    nth = at - np.maximum.accumulate(np.where(same, 0, at))
    return inner & (reach + 1 >= CUT_WORDS) & (nth % CUT_WORDS == 0)


def runs_of(u: Units, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First units and the units behind the last of all runs, by place."""
    n = len(u.text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    number = np.arange(n)
    opens = np.append(True, u.text[1:] != u.text[:-1])
    head = np.maximum.accumulate(np.where(opens, number, 0))  # the first unit of the text
    tail = np.append(np.flatnonzero(opens)[1:], n)[np.cumsum(opens) - 1]  # behind its last
    to = np.maximum(number + MIN_UNITS, np.searchsorted(u.word, u.word[:-1] + min_words))
    begin = np.minimum(number + 1 - MIN_UNITS, np.searchsorted(u.word, u.word[1:] - min_words, side="right") - 1)
    ahead, back = to <= tail, begin >= head
    pairs = np.unique(np.concatenate([number[ahead] * (n + 1) + to[ahead], begin[back] * (n + 1) + number[back] + 1]))
    return np.divmod(pairs, n + 1)


def hasher(min_words: int):
    """Runs of a text; places are characters."""
    @F.arrow_udf(T.ArrayType(RUN))
    def run_hashes(text: pa.Array) -> pa.Array:
        parts, ends = [[] for _ in range(4)], [np.zeros(1, np.int64)]
        for part in slices(text, SLICE_BYTES):
            u = segmented([t or "" for t in part.to_numpy(zero_copy_only=False).tolist()])
            first, behind = runs_of(u, min_words)
            keys = [spans_hash(u.words, base, u.word[first], u.word[behind]).view(np.int64) for base in _BASES[1:]]
            start = u.start[first]
            for rows, column in zip(parts, (*keys, start.astype(np.int32), (u.end[behind - 1] - start).astype(np.int32)), strict=True):
                rows.append(column)
            ends.append(np.bincount(u.text[first], minlength=len(part)))
        kinds = (np.int64, np.int64, np.int32, np.int32)
        rows = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, k), *p])) for k, p in zip(kinds, parts, strict=True)], ["h1", "h2", "pos", "len"])
        pa.default_memory_pool().release_unused()
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(ends)), pa.int32()), rows)

    return run_hashes


@F.arrow_udf(CUT)
def without_spans(text: pa.Array, removed: pa.Array) -> pa.Array:
    texts, spans, counts = [], [], []
    for t, gone in zip(text, removed, strict=True):
        t = t.as_py()
        merged: list[list[int]] = []
        for a, b in sorted((r["pos"], r["pos"] + r["len"]) for r in gone.as_py() or ()):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        edges = [0, *[x for span in merged for x in span], None]
        texts.append("".join([t[a:b] for a, b in zip(edges[::2], edges[1::2])]) if merged else t)
        spans.append([{"start": a, "end": b} for a, b in merged])
        counts.append(sum(b - a for a, b in merged))
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(counts, pa.int32())], ["text", "spans", "n_removed"])


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row: payload, id, text without repeated spans, spans cut out, n_removed (both in characters)."""
    return without_repeats(docs, hasher(min_words), without_spans, id_col, text_col, spare_first=False)


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows with the columns of ``docs``."""
    return with_text(substring_dedup(docs, min_words, id_col, text_col), docs.columns, text_col, chars_col)
