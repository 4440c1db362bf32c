import zlib

import numpy as np
import pytest

from quarry.llm import quality as Q
from quarry.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF

LABELS = "doc_id long, quality int, toxic int"


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (10, 0, 0), (7, 1, 0), (8, 1, 0), (None, 1, 0), (2, None, 0), (6, 0, 0), (6, 1, 0), (3, 5, 0), (99, 1, 0), (1, 1, 1)], LABELS)
    rows = Q.score_documents(odd_docs, labels).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by = {}
    for r in rows:  # equal texts get equal scores
        assert by.setdefault(r.payload.text or "", r.score) == r.score
    assert Q.accepted(odd_docs, labels).columns == odd_docs.columns
    assert Q.score_documents(no_docs, labels).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (7, 1, 0)], [(1, 0, 0)]])
def test_without_both_labels_nothing_is_rejected(spark, odd_docs, labels):
    rows = Q.score_documents(odd_docs, spark.createDataFrame(labels, LABELS)).collect()
    assert all(r.predicted == 1 for r in rows)


def test_only_texts_matter(spark, make_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], LABELS)
    texts = [f"quiet words number {i} follow here." if i % 2 else f"LOUD!! {i} $$$ || ||" for i in range(40)]
    a = Q.score_documents(make_docs(list(enumerate(texts))), labels)
    b = a.collect()
    assert np.mean([r.predicted == r.id % 2 for r in b]) > 0.9


def test_the_loss_of_the_pairs_is_at_its_minimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    m = Q.fit(x, y)
    z = np.clip((x - m["mean"]) / np.array(m["sd"]), -8, 8)
    u = np.hstack([z, z**2 / 8]) @ np.array(m["weights"])
    assert np.mean((u[y == 1][:, None] > u[y == 0][None, :])) > 0.95
    assert abs((u < m["quantile"]).mean() - (y == 0).mean()) < 0.01
    assert np.all((Q.scores(x, {**m}, 0.3)[:3] >= 0.3) == (u[:3] >= m["quantile"]))


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op5_quality_classifier"](spark, sf).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def some_rows(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(Q.NAMES))).astype(np.float32).astype(float)
    return x, (x[:, 0] - x[:, 1] ** 2 + rng.normal(size=n) > 0.5).astype(int)


def test_all_pairs_are_learned_from():
    x, y = some_rows(500, 2)
    m = Q.fit(x, y)
    w, z = np.array(m["weights"]), Q.standard(x, np.array(m["mean"]), np.array(m["sd"]))
    good, bad = z[y == 1], z[y == 0]
    miss = 1 / (1 + np.exp((good @ w)[:, None] - (bad @ w)[None, :]))
    grad = (bad.T @ miss.sum(axis=0) - good.T @ miss.sum(axis=1)) / miss.size + Q.PENALTY * w
    assert np.abs(grad).max() < 1e-4


def test_a_table_is_fitted_as_its_matrix(spark):
    x, y = some_rows(900, 3)
    rows = spark.createDataFrame([(r.tolist(), int(k)) for r, k in zip(x, y)], "x array<float>, y int")
    a, b = Q.fit(x, y), Q.fit_rows(rows.repartition(5))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=0, atol=3e-6) for k in a)


@pytest.mark.parametrize("n", [1, 2, 999])
def test_quantile_of_a_table(spark, n):
    v = np.round(np.random.default_rng(n).normal(size=n), 2)
    bits = v.view(np.int64)
    keys = spark.createDataFrame([(int(k),) for k in bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))], "u long")
    for share in (0.0, 0.37, 1.0):
        assert abs(Q._quantile(keys, share) - np.quantile(v, share)) < 1e-12
