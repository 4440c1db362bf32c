import zlib
from hashlib import sha256

import numpy as np
import pytest

from quarry.llm import merkle as M
from quarry.llm.queries import LEAF, QUERIES
from tests.llm.conftest import DOCS, ODD, SF


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, n_chars):
    cells = [n_chars if c == "n_chars" else row[c] for c in LEAF]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in cells])


def tree(nodes):
    """The root, and each leaf's (sibling, side) steps."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            steps[k].append((nodes[p ^ 1] if p ^ 1 < len(nodes) else None, p % 2))
        nodes = [H(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], steps


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["n_chars"]), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = {name: tree([x[2] for x in sorted(groups[name], key=lambda x: x[:3])]) for name in names}
    root, above = tree([made[n][0] for n in names]) if names else (None, [])
    out = []
    for name, up in zip(names, above):
        for (_, _, leaf, r), own in zip(sorted(groups[name], key=lambda x: x[:3]), made[name][1]):
            x = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                x = leaf_of(r, r["n_chars"] + 1)
            for sibling, right in own + up:
                x = H(x) if sibling is None else H(sibling, x) if right else H(x, sibling)
            out.append((r["doc_id"], leaf, made[name][0], root, H(*[s for s, _ in own + up if s]), x, x == root))
    return sorted(out, key=str)


def run(docs, height):
    from pyspark.sql import functions as F

    from quarry.llm.queries import TAMPERED
    claim = F.when(F.expr(TAMPERED), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    m = M.manifest(M.document_rows(docs, LEAF, claims={"claim": {"n_chars": claim}}), height)
    return sorted(((r.id, *[bytes(r[c]).hex() for c in ("leaf", "subroot", "root", "proof", "folded")], r.folded == r.root) for r in M.proofs(m, "claim").collect()), key=str)


@pytest.mark.parametrize("levels", range(1, 12))
def test_van_emde_boas_order(levels):
    """Each place once, and the two halves of the height apart."""
    places = [M.addresses(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    upper = levels // 2
    if upper:
        assert np.concatenate(places[:upper]).max() == (1 << upper) - 2
        size = (1 << levels - upper) - 1
        for tree_number in range(1 << upper):
            own = [p[tree_number << d:(tree_number + 1) << d] for d, p in enumerate(places[upper:])]
            assert sorted(np.concatenate(own).tolist()) == list(range((1 << upper) - 1 + tree_number * size, (1 << upper) - 1 + (tree_number + 1) * size))


@pytest.mark.parametrize("height", [1, 2, 10])
def test_against_brute_force(spark, height):
    rows = [(i * 3 % 101, f"text {i} é", [None, "", "en", "de", "é"][min(i % 7, 4)], None if i % 4 else "s", None if i % 5 == 0 else i, None, i, None, None, None, 5) for i in range(75)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    want = brute([r.asDict() for r in docs.collect()])
    assert run(docs, height) == want
    assert {w[-1] for w in want} == {True, False}


def test_odd_rows(odd_docs, no_docs):
    assert run(odd_docs, 2) == brute([r.asDict() for r in odd_docs.collect()]) and len(ODD) == odd_docs.count()
    assert run(no_docs, 2) == []


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(make_docs, n):
    docs = make_docs([(i, "x") for i in range(n)])
    assert run(docs, 1) == brute([r.asDict() for r in docs.collect()])


def test_query(spark):
    rows = QUERIES["op13_merkle_manifest"](spark, SF).collect()
    want = brute([r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert sorted([tuple(r) for r in rows], key=str) == want
