import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import bpe as B
from quarry.llm.fragments import Fragments
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = open(PATH).read()
PLAIN = Tokenizer.from_file(PATH)


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def test_bytes_of_tokens_are_those_of_the_library():
    tokens = B.vocabulary(MODEL)[0]
    for i in range(0, len(tokens), 7):
        assert PLAIN.decode([i], skip_special_tokens=False) == tokens[i].decode("utf-8", "replace")


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aB1'!$# \n\t\r\x0b\x1c\x85\xa0é́　 sreTvmld<|>endoftextqx\U0001f600", max_size=60),
                          st.sampled_from(["<|endoftext|>", "a <|endoftext|> b", "<|endo", "ftext|>", "#'s '''re x'll 12's \n  a\n\n  b ", "  \xa0  x", None])), max_size=8))
def test_ids_are_those_of_the_library(texts):
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    got = [i.tolist() for part in Fragments.of(MODEL, B.whole_word).encode(pa.array(texts, pa.string()), B.byte_cuts(MODEL)) for i in part]
    assert got == [ids(t) for t in texts]


def test_cuts_split_words(spark):
    data = np.frombuffer(b"one two, three", np.uint8)
    _, starts, _ = B.byte_cuts(MODEL)(data, np.array([0, len(data)]))
    assert {0, 3, 8} <= set(starts.tolist())


def test_odd_rows(odd_docs, no_docs):
    rows = B.decode(B.encode(odd_docs, PATH), PATH).collect()
    assert len(rows) == len(ODD)
    want = sorted((str(i), ids(t), t or "") for i, t in ODD)
    assert sorted((str(r.id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows) == want
    assert B.encode(no_docs, PATH).count() == 0


def test_invalid_utf8_is_replaced_as_the_library_does(spark):
    parts = [[i] for i in (447, 123, 50256, 220)] + [[447, 220, 447]]
    df = spark.createDataFrame([(k, bytearray(np.array(p, "<u4").tobytes())) for k, p in enumerate(parts)], "id long, ids binary")
    got = {r.id: r.decoded for r in B.decode(df, PATH).collect()}
    assert got == {k: PLAIN.decode(p, skip_special_tokens=False) for k, p in enumerate(parts)}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in B.decode(B.encode(docs, PATH), PATH).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == ids(texts[r.id]) and r.decoded == PLAIN.decode(ids(texts[r.id]), skip_special_tokens=False)
