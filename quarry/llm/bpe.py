"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can't be merged across, so a
text may be cut between its two bytes.  The pairs come from the vocabulary
itself; the cut must also leave the pre-tokenizer's words as they are, hence it
is made only before a byte that

* doesn't continue a character and isn't an apostrophe (which could begin a
  contraction), and
* is white space, or follows an ASCII byte that isn't white space: a piece of
  white space never loses the word behind it, and a regular expression that
  matches from left to right goes on after a cut as it would have without it.

Special tokens are matched by the library before all else; their strings are
fragments of their own.  Each distinct fragment is encoded once (``fragments``),
the ids are concatenated.  Decoding joins the tokens' bytes and replaces what
isn't UTF-8, as the library does.

Defined results: a null text counts as empty and has no ids; repeated rows and
rows without id are encoded like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import field, payload
from quarry.llm.fragments import Fragments

_WHITE = [9, 10, 11, 12, 13, 32]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    for themselves, and the others, in order, for the characters from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


_SPACE_LETTER = next(c for c, b in byte_alphabet().items() if b == 32)


@cache
def vocabulary(tokenizer_json: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of each id, and the special tokens' strings."""
    model, letters = json.loads(tokenizer_json), byte_alphabet()
    special = {t["id"]: t["content"].encode() for t in model["added_tokens"]}
    tokens = {i: bytes(letters[c] for c in t) for t, i in model["model"]["vocab"].items() if i not in special} | special
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)], sorted(special.values())


@cache
def forced_boundaries(tokenizer_json: str) -> np.ndarray:
    """Whether a text may be cut between two bytes, by 256 * first + second."""
    tokens, special = vocabulary(tokenizer_json)
    inside = np.zeros((256, 256), bool)
    for t in set(tokens) - set(special):
        b = np.frombuffer(t, np.uint8)
        inside[b[:-1], b[1:]] = True
    begins = np.ones(256, bool)
    begins[128:192] = begins[39] = False
    white = np.isin(np.arange(256), _WHITE)
    plain = (np.arange(256) < 128) & ~white
    return (~inside & begins[None, :] & (white[None, :] | plain[:, None])).ravel()


def byte_cuts(tokenizer_json: str):
    may_cut, special = forced_boundaries(tokenizer_json), vocabulary(tokenizer_json)[1]

    def cuts(data: np.ndarray, offsets: np.ndarray):
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = may_cut[data[:-1].astype(np.int32) * 256 + data[1:]]
        cut[offsets] = True
        raw = data.tobytes()
        for s in special:
            at = raw.find(s)
            while at >= 0:
                end = at + len(s)
                if not np.isin(np.arange(at + 1, end), offsets).any():  # not across two texts
                    cut[at + 1:end] = False
                    cut[[at, end]] = True
                    at = raw.find(s, end)
                else:
                    at = raw.find(s, at + 1)
        at = np.flatnonzero(cut)
        return data, at[:-1], at[1:]

    return cuts


def whole_word(fragment: str) -> str | None:
    """ASCII letters after at most one space: one word; the space has a letter of its own in the vocabulary."""
    letters = fragment[1:] if fragment[:1] == " " else fragment
    return _SPACE_LETTER * (len(fragment) - len(letters)) + letters if letters.isascii() and letters.isalpha() else None


def encode_udf(tokenizer_path: str):
    """Ids of a text as little-endian unsigned 32-bit integers."""
    model = Path(tokenizer_path).read_text(encoding="utf-8")

    @F.arrow_udf(T.BinaryType())
    def encode(text: pa.Array) -> pa.Array:
        cuts = byte_cuts(model)
        return pa.array([ids.tobytes() for part in Fragments.of(model, whole_word).encode(text, cuts) for ids in part], pa.binary())

    return encode


def decode_udf(tokenizer_path: str):
    """The text of ids."""
    model = Path(tokenizer_path).read_text(encoding="utf-8")

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        tokens = vocabulary(model)[0]
        return pa.array([b"".join(map(tokens.__getitem__, np.frombuffer(i or b"", "<u4").tolist())).decode("utf-8", "replace") for i in ids.to_pylist()], pa.string())

    return decode


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (binary)."""
    return payload(docs).select(field(id_col).alias("id"), encode_udf(tokenizer_path)(field(text_col)).alias("ids"))


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` with the decoded text."""
    return encoded.withColumn("decoded", decode_udf(tokenizer_path)("ids"))
