import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup as X
from tests.llm.conftest import ODD


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("m", [1, 2, 3, 7, 100, 2048])
def test_perfect_hash_is_a_bijection(m):
    keys = np.frombuffer(b"".join(hashlib.sha256(f"{m}-{i}".encode()).digest() for i in range(m)), np.uint8).reshape(m, 32).copy()
    seed, pilots, slots = X.perfect_hash(keys)
    assert sorted(slots) == list(range(m))
    assert (X.slots_of(keys, seed, pilots, m) == slots).all()


@pytest.mark.parametrize("history", ["default", "none", "all"])
def test_odd_rows(odd_docs, history):
    cond = {"default": None, "none": F.lit(False), "all": F.lit(True)}[history]
    got = X.exact_groups(odd_docs, history=cond).collect()
    groups = defaultdict(list)
    for i, t in ODD:
        groups[low(t)].append(i)
    assert len(got) == len(ODD)
    kept = defaultdict(int)
    for r in got:
        ids = groups[low(r.payload.text)]
        assert r.size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert bytes(r.digest) == hashlib.sha256(low(r.payload.text).encode()).digest()
        kept[low(r.payload.text)] += r.kept
        if r.kept:
            assert r.id == r.keep_id
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_incremental_batch_marks_nonmembers(make_docs):
    docs = make_docs([(i, f"text {i % 50}") for i in range(200)])
    rows = X.exact_groups(docs, history=F.col("id") < 30).collect()
    known = {r.payload.text for r in rows if r.known}
    assert known == {f"text {i}" for i in range(30)}
    assert all(r.size == 4 and r.keep_id == 150 + int(r.payload.text.split()[1]) for r in rows)


def test_kept_rows_have_the_columns_of_the_input(odd_docs, no_docs):
    out = X.exact_dedup(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == len({low(t) for _, t in ODD})
    assert X.exact_dedup(no_docs).count() == 0
