"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised as the model says (a space in front, spaces written as
U+2581) and cut into words: before every space sign, and between two characters
that stand side by side inside no piece.  The distinct words of a slice lie in
one flat array of symbols.  Each round finds the best rank of a pair in every
word (a segmented minimum) and merges its occurrences at once, the leftmost
first where they overlap; words without a pair left leave the arrays.

One merge at a time, as the library does it, a new symbol's pair that ranks at
least as high goes before the other occurrences.  Where a piece can be
outranked so by a longer one, a word's occurrences are merged only up to the
first that makes such a pair, so every vocabulary gives the library's ids.
Space signs alone have the lowest score of all pieces: their runs, after all
else, are cut by a table of the lengths that are pieces.  Characters without a
piece become bytes.

The ids of a text hold its pieces in order; decoding takes the pieces' bytes by
id, turns space signs into spaces, drops the space in front, and replaces bytes
that aren't UTF-8 one by one, as the library does.

Models must be BPE with byte fallback and identity normalisation; others are
refused with a ValueError.  Defined results: null and empty texts have no ids,
and no ids decode to an empty text; repeated rows and rows without id are
encoded like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import field, payload, slices

SPACE, SPACE_SIGN = 0x20, 0x2581
#: Words whose ids are kept from one slice to the next.
KEPT = 1 << 17
_CODES = 0x110000
#: Bits of the table of neighbours; two pairs in one place only make a word longer.
_TABLE_BITS = 22
_LEAD = np.array([0, 0, 0xC0, 0xE0, 0xF0])


def _places(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint32) * np.uint32(0x9E3779B1) + right.astype(np.uint32) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _TABLE_BITS)


class Model:
    """Tables of one model file."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(data)
        spec, kinds = proto.normalizer_spec, pb.ModelProto.SentencePiece
        plain = spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
        trained = proto.trainer_spec
        if trained.model_type != pb.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix or not plain:
            raise ValueError("only BPE models with byte fallback, a space in front and identity normalisation")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.size = len(proto.pieces)
        self.kept_words, self.kept_ids = pa.array([], pa.binary()), pa.array([], pa.list_(pa.int32()))
        pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        score = [p.score for p in proto.pieces]
        sign = chr(SPACE_SIGN)
        self.space = pieces.get(sign, -1)
        runs = {len(p): i for p, i in pieces.items() if not p.strip(sign)}
        rest = [score[i] for p, i in pieces.items() if len(p) > 1 and p.strip(sign)]
        if any(sign in p[1:] for p in pieces if p.strip(sign)) or len({score[i] for i in runs.values()}) > 1 or rest and min(rest) <= score[self.space]:
            raise ValueError("space signs must come first in a piece, and pieces of them alone last in rank")

        self.char_ids = np.arange(_CODES, dtype=np.int64) + self.size  # characters without a piece: behind all ids
        for p, i in pieces.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        ranks = {s: r for r, s in enumerate(sorted({score[i] for i in pieces.values()}, reverse=True))}
        self.no_rank = len(ranks)
        made: dict[int, tuple[int, int]] = {}
        self.outranked = np.zeros(self.size, bool)
        beside = set()
        for p, i in pieces.items():
            if not p.strip(sign):
                continue
            for c in range(1, len(p)):
                beside.add((ord(p[c - 1]), ord(p[c])))
                parts = pieces.get(p[:c]), pieces.get(p[c:])
                if None not in parts:
                    made[parts[0] * self.width + parts[1]] = ranks[score[i]], i
                    for part in parts:
                        self.outranked[part] |= score[part] <= score[i]
        self.beside = np.zeros(1 << _TABLE_BITS, bool)
        self.beside[_places(*np.array(sorted(beside)).T)] = True
        self.keys = np.array(sorted(made), np.int64)
        self.rank = np.array([made[k][0] for k in self.keys.tolist()] + [self.no_rank], np.int32)
        self.piece = np.array([made[k][1] for k in self.keys.tolist()] + [-1], np.int64)
        self.runs = self._run_table(runs)

        bytes_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.byte_ids = np.array(sorted(bytes_of, key=bytes_of.get), np.int64)
        unknown = trained.unk_surface.encode()
        surface = {kinds.NORMAL: lambda i, p: p.replace(sign, " ").encode(), kinds.BYTE: lambda i, p: bytes([bytes_of[i]]), kinds.UNKNOWN: lambda i, p: unknown}
        self.surface = pa.array([surface[p.type](i, p.piece) if p.type in surface else b"" for i, p in enumerate(proto.pieces)], pa.binary())
        self.spaced = np.array([p.type == kinds.NORMAL and p.piece.startswith(sign) for p in proto.pieces])
        self.silent = np.array([p.type == kinds.CONTROL for p in proto.pieces])

    @property
    def width(self) -> int:
        return self.size + _CODES

    def _run_table(self, runs: dict[int, int]) -> np.ndarray:
        """``[m, o]``: the id that starts at place o of a run of m space signs, or -1; m up to the longest piece.

        Leftmost first: of all neighbours that make a piece, the first pair is merged.
        """
        longest = max(runs, default=1)

        def cut(n: int) -> list[int]:
            parts = [1] * n
            while (at := next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in runs), None)) is not None:
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            return parts

        if any(cut(n + longest) != [longest, *cut(n)] for n in range(1, longest + 1)):
            raise ValueError("runs of space signs are not cut from the left")
        table = np.full((longest + 1, longest), -1, np.int64)
        for m in range(1, longest + 1):
            o = 0
            for n in cut(m):
                table[m, o] = runs[n]
                o += n
        return table

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair in the tables of ranks and pieces; the last entry stands for none."""
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[np.minimum(at, len(self.keys) - 1)] == key, at, len(self.keys))

    def merged(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each word after all merges, and how many; ``size``: symbols per word before, none empty."""
        none = len(self.keys)
        word = np.repeat(np.arange(len(size)), size)
        pair = np.full(len(sym), none)
        inside = np.flatnonzero(word[:-1] == word[1:])
        pair[inside] = self.pairs(sym[inside], sym[inside + 1])
        done_word, done_sym = [], []
        while len(word):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            count = np.diff(np.append(first, len(word)))
            rank = self.rank[pair]
            best = np.minimum.reduceat(rank, first)
            live = best < self.no_rank
            if not live.all():
                stays = np.repeat(live, count)
                done_word.append(word[~stays])
                done_sym.append(sym[~stays])
                word, sym, pair, rank, best, count = word[stays], sym[stays], pair[stays], rank[stays], best[live], count[live]
                if not len(word):
                    break
            at = np.flatnonzero(rank == np.repeat(best, count))
            chain = np.diff(at, prepend=-2) != 1  # of neighbours that overlap: the first, the third, ...
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(chain, place, 0))) % 2 == 0]
            new = self.piece[pair[at]]
            if self.outranked[new].any():
                upto = self._before_better(word, sym, rank, at, new)
                at, new = at[upto], new[upto]
            sym[at] = new
            stays = np.ones(len(sym), bool)
            stays[at + 1] = False
            word, sym, pair = word[stays], sym[stays], pair[stays]
            at = at - np.arange(len(at))
            at = np.union1d(at, np.maximum(at - 1, 0))
            pair[at] = none
            at = at[at + 1 < len(word)]
            at = at[word[at] == word[at + 1]]
            pair[at] = self.pairs(sym[at], sym[at + 1])
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(size))

    def _before_better(self, word, sym, rank, at, new) -> np.ndarray:
        """Which merges to make: in each word those up to the first whose new pairs rank as high."""
        at_left, at_right = np.maximum(at - 1, 0), np.minimum(at + 2, len(sym) - 1)
        joined = np.diff(at, prepend=-9) == 2  # the left neighbour is new as well
        left = np.where(joined, np.roll(new, 1), sym[at_left])
        r_left = np.where((at > 0) & (word[at_left] == word[at]), self.rank[self.pairs(left, new)], self.no_rank)
        r_right = np.where((at + 2 < len(sym)) & (word[at_right] == word[at]), self.rank[self.pairs(new, sym[at_right])], self.no_rank)
        better = np.minimum(r_left, r_right) <= rank[at]
        before = np.cumsum(better) - better
        starts = np.diff(word[at], prepend=-1) != 0
        return before == np.maximum.accumulate(np.where(starts, before, 0))

    def ids_of(self, words: pa.Array) -> pa.ListArray:
        """Ids of words given as binary arrays of 32-bit code points."""
        at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        code = np.frombuffer(words.buffers()[2], "<u4", count=at[-1] // 4)[at[0] // 4:]
        sym, count = self.merged(self.char_ids[code], np.diff(at) // 4)
        bare = sym >= self.size
        if bare.any():
            code = np.where(bare, sym - self.size, 0)
            n = np.where(bare, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
            ends = np.cumsum(n)
            count = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])])
            of = np.repeat(np.arange(len(sym)), n)
            k = np.arange(len(of)) - (ends - n)[of]
            n, code = n[of], code[of]
            tail = code >> (6 * (n - 1 - k))
            byte = np.where(k == 0, _LEAD[n] | tail, 0x80 | tail & 0x3F)
            sym = np.where(bare[of], self.byte_ids[np.where(bare[of], byte, 0)], sym[of])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(sym, pa.int32()))

    def recalled(self, words: pa.Array) -> pa.ListArray:
        """``ids_of`` distinct words, most of which earlier slices had; all words of a slice are kept, those of earlier ones up to ``KEPT``."""
        at = pc.index_in(words, value_set=self.kept_words)
        fresh = pc.is_null(at)
        new = words.filter(fresh)
        if len(new):
            made = pa.concat_arrays([self.kept_ids, self.ids_of(new)])
            isnew = np.asarray(fresh)
            place = np.where(isnew, len(self.kept_words) + np.cumsum(isnew) - 1, np.asarray(at.fill_null(0)))
            ids = made.take(pa.array(place))
            kept = pa.concat_arrays([self.kept_words, new])
            self.kept_words, self.kept_ids = (kept, made) if len(kept) <= KEPT and kept.nbytes <= 64 * KEPT else (words, ids)
            return ids
        return self.kept_ids.take(at)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and the number of each."""
        length = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(length)])
        if not offsets[-1]:
            return np.zeros(0, np.int32), length
        code = np.frombuffer("".join([" " + t for t in texts if t]).encode("utf-32-le"), "<u4").copy()
        code[code == SPACE] = SPACE_SIGN
        begins = code == SPACE_SIGN
        begins[1:] |= ~self.beside[_places(code[:-1], code[1:])]
        begins[offsets[:-1][length > 0]] = True
        at = np.append(np.flatnonzero(begins), len(code))
        words = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(code)]).dictionary_encode()
        known = self.recalled(words.dictionary)
        per_word = np.diff(np.asarray(known.offsets))[np.asarray(words.indices)]
        ids = np.asarray(known.take(words.indices).flatten())
        upto = np.concatenate([[0], np.cumsum(per_word)])[np.searchsorted(at, offsets)]
        return self._runs_cut(ids, upto)

    def _runs_cut(self, ids: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        white = ids == self.space
        breaks = np.zeros(len(ids) + 1, bool)
        breaks[upto] = True
        starts = white & np.concatenate([[True], ~white[:-1]]) | white & breaks[:-1]
        lone = np.flatnonzero(white)
        run = np.cumsum(starts[lone]) - 1
        size = np.bincount(run) if len(run) else np.zeros(0, np.int64)
        place = lone - lone[starts[lone]][run]
        longest = self.runs.shape[1]
        block = np.minimum(size[run] - place // longest * longest, longest)
        cut = self.runs[block, place % longest]
        ids = ids.astype(np.int32)
        ids[lone] = cut
        stays = ids >= 0
        total = np.concatenate([[0], np.cumsum(stays)])
        return ids[stays], np.diff(total[upto])

    def decode(self, ids: pa.ListArray) -> list[str]:
        flat, at = np.asarray(ids.flatten()), np.concatenate([[0], np.cumsum(np.diff(np.asarray(ids.offsets)))])
        data = self.surface.take(pa.array(flat, pa.int32()))
        ends = np.frombuffer(data.buffers()[1], np.int32)[:len(data) + 1]
        raw = data.buffers()[2].to_pybytes() if data.buffers()[2] else b""
        out = []
        heard = np.append(np.flatnonzero(~self.silent[flat]), len(flat))
        mute = np.flatnonzero(self.silent[flat])
        for a, b in zip(at, at[1:]):
            f = heard[np.searchsorted(heard, a)]
            front = int(f < b and self.spaced[flat[f]])
            # bytes don't go together across a control id
            edges = [ends[a] + front, *ends[mute[slice(*np.searchsorted(mute, [max(a, f), b]))]], ends[b]]
            out.append("".join([raw[x:y].decode("utf-8", "replace_each") for x, y in zip(edges, edges[1:])]))
        return out


def _replace_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


@cache
def model_of(data: bytes) -> Model:
    import codecs

    codecs.register_error("replace_each", _replace_each)
    return Model(data)


def encode_udf(model_path: str):
    """Ids of a text."""
    data = Path(model_path).read_bytes()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(text: pa.Array) -> pa.Array:
        model, ids, counts = model_of(data), [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for part in slices(text):
            flat, n = model.encode([t or "" for t in part.to_pylist()])
            ids.append(flat)
            counts.append(n)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))

    return encode


def decode_udf(model_path: str):
    """The text of ids."""
    data = Path(model_path).read_bytes()

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        return pa.array(model_of(data).decode(ids.fill_null([])), pa.string())

    return decode


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (array of integers)."""
    return payload(docs).select(field(id_col).alias("id"), encode_udf(model_path)(field(text_col)).alias("ids"))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with the decoded text."""
    return encoded.withColumn("decoded", decode_udf(model_path)("ids"))
