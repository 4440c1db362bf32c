"""Exact tokenisation of many texts by encoding each distinct fragment once.

``cuts`` say where a text may be cut so that the ids of the fragments, joined,
are the ids of the text; each tokenizer family has its own rule.  The fragments
of a batch are made distinct in Arrow, unknown ones are encoded by the public
tokenizers library, and a bounded memory keeps the ids of known ones.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from quarry.llm.common import slices

#: Fragments a worker remembers as used lately, and as many from before; those not used again are forgotten.
REMEMBERED = 160_000

_workers: dict = {}


class Fragments:
    """Tokenizer and memory of one Python worker.

    ``word(fragment)`` may give the string that the library's model gets for a
    fragment which normalisation and pre-tokenization leave in one piece; the
    model is then called without them.
    """

    def __init__(self, tokenizer_json: str, word: Callable[[str], str | None]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.word = word
        self.known: dict[str, bytes] = {}  # ids as little-endian unsigned 32-bit integers
        self.before: dict[str, bytes] = {}

    @classmethod
    def of(cls, tokenizer_json: str, word: Callable[[str], str | None] = lambda fragment: None) -> Fragments:
        key = hash(tokenizer_json)
        if key not in _workers:
            _workers.clear()
            _workers[key] = cls(tokenizer_json, word)
        return _workers[key]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        new, known, before, word, tokenize = [], self.known, self.before, self.word, self.tokenizer.model.tokenize
        for t in texts:
            if t not in known:
                if t in before:
                    known[t] = before[t]
                elif (w := word(t)) is None:
                    new.append(t)
                else:
                    known[t] = array("I", [x.id for x in tokenize(w)]).tobytes()
        for at in range(0, len(new), 10_000):
            part = new[at:at + 10_000]
            self.known.update(zip(part, (array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True))
        return [self.known[t] for t in texts]

    def encode(self, text: pa.Array, cuts: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[list[np.ndarray]]:
        """The ids of each text as little-endian unsigned 32-bit integers, slice by slice; null counts as empty."""
        for part in slices(text):
            data, offsets = utf8(part)
            data, starts, ends = cuts(data, offsets)
            if not len(starts):
                yield [np.zeros(0, "<u4")] * len(part)
                continue
            size = ends - starts
            edge = np.zeros(len(data) + 1, np.int8)
            edge[starts] += 1
            edge[ends] -= 1
            inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
            at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            words = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(at), pa.py_buffer(data[inside])]).dictionary_encode()
            known = self.ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
            n = np.fromiter(map(len, known), np.int64, len(known)) // 4
            table = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.frombuffer(b"".join(known), "<u4")))
            ids = np.asarray(table.take(words.indices).flatten())
            per_word = n[np.asarray(words.indices)]
            upto = np.concatenate([[0], np.cumsum(per_word)])[np.searchsorted(starts, offsets)]
            yield [ids[a:b] for a, b in zip(upto, upto[1:])]
            pa.default_memory_pool().release_unused()


def utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets of each."""
    parts = [t or b"" for t in text.cast(pa.binary()).to_pylist()]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
