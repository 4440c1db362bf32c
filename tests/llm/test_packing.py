import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing as P
from quarry.llm.fragments import Fragments
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
SPECIAL = [b"<|startoftext|>", b"<|endoftext|>"]


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def check_rows(rows, texts_by_id, length):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        assert r.length == len(r.ids) // 4 > 0
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    assert sorted(sequences) == list(range(len(sequences)))
    for i, texts in texts_by_id.items():
        want = [ids(t) + [2] for t in texts]
        # pieces of rows that share an id are told apart by their sorted starts and contents
        assert sum(n for _, p, _ in docs[i] for n in [len(p)]) == sum(map(len, want))
        if len(want) == 1:
            assert [x for _, p, _ in sorted(docs[i]) for x in p] == want[0]
            assert all(n == len(want[0]) for _, _, n in docs[i])
    assert set(docs) == set(texts_by_id)
    return len(sequences)


@pytest.mark.parametrize("length", [64, 4096])
def test_odd_rows(odd_docs, no_docs, length):
    by_id = defaultdict(list)
    for i, t in ODD:
        by_id[i].append(t)
    check_rows(P.pack(odd_docs, PATH, 2, length).collect(), by_id, length)
    assert P.pack(no_docs, PATH, 2, length).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: [r.text] for r in docs.collect()}
    n = check_rows(P.pack(docs, PATH, 2, 1024).collect(), texts, 1024)
    total = sum(len(ids(t)) + 1 for (t,) in texts.values())
    assert n == -(-total // 1024)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aB1'!$ \n\té́ß 　sSrtTm<|>endofxÅÅ\U0001f600", max_size=60),
                          st.sampled_from(["<|endoftext|>", "a<|endoftext|>b", "H̱ ẖ", "it's don't '''s 12's", "<|STARTOFTEXT|>", None])), max_size=6))
def test_ids_are_those_of_the_library(texts):
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    worker = Fragments.of(open(PATH).read(), P.whole_word)
    got = [i.tolist() for part in worker.encode(pa.array(texts, pa.string()), P.word_cuts(SPECIAL)) for i in part]
    assert got == [ids(t) for t in texts]


def expand(placements, length):
    """Pieces per (remainder, rank), and fill per sequence, place by place."""
    pieces, fills = defaultdict(list), defaultdict(list)
    for p in placements:
        for r in range(p.lo, p.hi):
            i = r - p.lo
            if p.free is None:
                pieces[p.rem, r].append((0, p.rem))
                fills[p.sequence + i % p.many].append((p.offset + i // p.many * p.rem, p.rem))
                continue
            for x in range(p.at + r * p.rem, p.at + (r + 1) * p.rem):  # one id after the other
                j, place = divmod(x - p.base, p.free)
                if 0 <= j < p.many:
                    pieces[p.rem, r].append((x - p.at - r * p.rem, 1))
                    fills[p.sequence + j].append((p.offset + place, 1))
    return pieces, fills


@pytest.mark.parametrize("seed", range(12))
def test_histogram_packer(seed):
    rng = random.Random(seed)
    length = rng.choice([16, 100, 1000])
    counts = Counter(min(length - 1, int(rng.lognormvariate(3, rng.choice([0.3, 1.5]))) + 1) for _ in range(rng.randint(0, 3000)))
    if seed > 8:
        counts, length = [{51: 200}, {99: 300, 2: 40, 1: 5}, {99: 50, 98: 50, 60: 31}][seed - 9], 100
    placements, n = P.pack_histogram(counts, length, 0)
    pieces, fills = expand(placements, length)
    assert set(pieces) == {(l, r) for l, m in counts.items() for r in range(m)}
    for (l, _), own in pieces.items():
        at = 0
        for start, k in sorted(own):
            assert start == at
            at += k
        assert at == l
    assert set(fills) <= set(range(n))
    for own in fills.values():
        at = 0
        for offset, k in sorted(own):
            assert offset == at
            at += k
        assert at <= length
    assert n == -(-sum(l * m for l, m in counts.items()) // length)  # the optimum


HISTOGRAMS = [{4065: 10, 100: 3}, {4080: 20, 50: 6}, {3500: 7, 700: 7}, {3000: 4, 1200: 4, 900: 4}, {4095: 9, 2048: 9}, {2049: 5, 3000: 5}, {1: 9}, {4095: 2}, {l: 1 for l in range(1, 4096)}]


@pytest.mark.parametrize("counts", HISTOGRAMS, ids=lambda c: str(c)[:24])
@pytest.mark.parametrize("times", [10**2, 10**5, 10**9])
def test_padding_and_work_are_bounded(counts, times):
    counts = {l: n * times for l, n in counts.items()}
    placements, n = P.pack_histogram(counts, 4096)
    tokens = sum(l * m for l, m in counts.items())
    best = -(-tokens // 4096)
    assert best <= n <= best * 1.001
    assert len(placements) < 30_000


def test_any_law_of_lengths_stays_within_the_bound():
    rng = np.random.default_rng(1)
    for spread in (0.3, 1.0, 2.0):
        lengths = np.minimum(rng.lognormal(6, spread, 10**6).astype(int) + 1, 4095)
        counts = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)]))
        placements, n = P.pack_histogram(counts, 4096)
        assert n <= -(-int(lengths.sum()) // 4096) * 1.001 and len(placements) < 30_000


def test_a_cut_document_is_whole_in_its_pieces(make_docs):
    """Lengths that fit no pack: with 48 ids a sequence, documents of 31 ids are cut over the spaces left."""
    docs = [(i, " ".join(["the cat"] * 15)) for i in range(40)] + [(100 + i, " ".join(["dog"] * (i % 46 + 1))) for i in range(60)]
    n = check_rows(P.pack(make_docs(docs), PATH, 2, 48).collect(), {i: [t] for i, t in docs}, 48)
    assert n == -(-sum(len(ids(t)) + 1 for _, t in docs) // 48)


def test_query(spark):
    from zlib import crc32

    from quarry.llm.queries import QUERIES
    docs = {r.doc_id: np.array(ids(r.text) + [2], "<u4") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op8_packing"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == set(docs)
    covered = Counter()
    for r in rows:
        own = docs[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == crc32(own[r.start:r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
    assert covered == {i: len(x) for i, x in docs.items()}
