import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from quarry.llm import pieces as P
from quarry.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF

PATH = public_tokenizers.path("piece_bpe_32k.model")
DATA = open(PATH, "rb").read()
PLAIN = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(model, texts):
    ids, counts = model.encode(texts)
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at:at + n].tolist())
        at += n
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="thecinger  ▁\n\t\x00日本語中国é́ü😀🎉0189.,!?'<s>", max_size=80),
                          st.sampled_from(["", " ", " " * 15, " " * 31 + "a" + " " * 47, "the" * 50, "xyxy" * 40, "</s><0x0A>", "▁" * 20, "de la the theater"])), max_size=8))
def test_ids_are_those_of_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encoded(P.model_of(DATA), texts) == PLAIN.encode(texts, num_threads=1)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 262), st.just(28705)), max_size=10), max_size=6))
def test_texts_are_those_of_the_library(ids):
    assert P.model_of(DATA).decode(pa.array(ids, pa.list_(pa.int32()))) == [PLAIN.decode(i) for i in ids]


def test_every_run_of_spaces():
    texts = [f"{a}{' ' * n}{b}" for n in range(100) for a in ("", "x") for b in ("", "the", "日", "\n")]
    assert encoded(P.model_of(DATA), texts) == PLAIN.encode(texts, num_threads=1)


def test_a_longer_piece_that_ranks_above_its_parts():
    """A vocabulary made for it: with ``abc`` above ``ab``, the second ``ab`` of a word comes after the first one's ``abc``."""
    proto = pb.ModelProto()
    proto.ParseFromString(DATA)
    kept = [p for p in proto.pieces if p.type != 1 or len(p.piece) == 1]
    del proto.pieces[:]
    proto.pieces.extend(kept)
    for piece, score in (("ab", -5), ("abc", -4), ("ca", -3), ("aba", -5), ("abcab", -5), ("bb", -2), ("abb", -9), ("▁▁", -1e9), ("▁a", -6)):
        proto.pieces.add(piece=piece, score=score)
    data = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = P.Model(data)
    assert model.outranked.any()
    from itertools import product
    texts = ["".join(t) for n in range(8) for t in product("abc", repeat=n)] + ["abab" * 9 + "c", "abcab" * 7]
    assert encoded(model, texts) == library.encode(texts, num_threads=1)


def test_other_models_are_refused():
    proto = pb.ModelProto()
    proto.ParseFromString(DATA)
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        P.Model(proto.SerializeToString())


def test_odd_rows(odd_docs, no_docs):
    rows = P.decode(P.encode(odd_docs, PATH), PATH).collect()
    assert len(rows) == len(ODD)
    assert sorted((str(r.id), list(r.ids), r.decoded) for r in rows) == sorted((str(i), PLAIN.encode(t or ""), t or "") for i, t in ODD)
    assert P.decode(P.encode(no_docs, PATH), PATH).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_sentencepiece_round_trip"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = PLAIN.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(PLAIN.decode(ids).encode()).hexdigest()


def test_kept_words_change_nothing(monkeypatch):
    from pathlib import Path

    from quarry.llm import pieces
    from quarry.llm.queries import PIECE_BPE

    data = Path(PIECE_BPE).read_bytes()
    texts = [[f"word{i * 7 % 90} tail{k} x é世  {i}", "", f"again word{k}"] for k in range(6) for i in range(20)]
    model = pieces.Model(data)
    none = model.kept_words, model.kept_ids

    def encoded(t, forget=False):
        if forget:
            model.kept_words, model.kept_ids = none
        return [a.tolist() for a in model.encode(t)]

    want = [encoded(t, forget=True) for t in texts]
    sizes = []
    for kept in (0, 10, 1 << 17):
        monkeypatch.setattr(pieces, "KEPT", kept)
        model.kept_words, model.kept_ids = none
        assert [encoded(t) for t in texts] == want
        sizes.append(len(model.kept_words))
    assert sizes[0] <= sizes[1] < sizes[2]  # of the last slice only, or of all
