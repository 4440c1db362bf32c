"""The pipeline's stages against brute force, on a small table with planted cases."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm.common import text_key
from quarry.llm import quality as Q
from quarry.llm import substring_dedup as S
from tests.llm.test_runs import brute, char_cut, plain_runs
from tests.llm.test_simhash import fingerprint, roots

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(6, 14))).capitalize() + "."
    passage = " ".join(sentence() for _ in range(7))
    texts = [" ".join(sentence() for _ in range(rng.randint(3, 25))) for _ in range(120)]
    texts += [passage + "\n" + " ".join(sentence() for _ in range(12)) for _ in range(6)]
    texts += [t.upper() if k % 2 else t for k, t in enumerate(texts[:10])]
    texts += [t + " Tail." for t in texts[30:34]]
    texts += ["!!! ||| " + " ||| ".join(word().upper() + "!!" for _ in range(40)) for _ in range(40)]
    texts += [None, "", "word", " ".join(word() for _ in range(12000))]
    where = str(tmp_path_factory.mktemp("docs"))
    rows = [(i, t, None, None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{where}/documents.parquet")
    labels = [(i, int("|||" not in (t or "")), 0) for i, t in enumerate(texts) if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = {r.id: r.score for r in Q.score_documents(docs, labels).collect()}
    kept = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]

    def step(name, current):
        out = steps[name](spark, current, folder)
        assert out.columns == docs.columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        return out, {r.doc_id: r.text for r in out.collect()}

    out, got = step("quality", docs)
    kept = {i: t for i, t in kept.items() if scored[i] >= 0.3}
    assert got == kept and not any("|||" in (t or "") for t in got.values()) and len(got) >= 140

    out, got = step("exact_dedup", out)
    best = {}
    for i, t in sorted(kept.items()):
        best[re.sub("[A-Z]", lambda m: m[0].lower(), t or "")] = i
    kept = {i: t for i, t in kept.items() if i in best.values()}
    assert got == kept

    out, got = step("simhash_near_dedup", out)
    fps = {i: fingerprint(t, 4) for i, t in kept.items()}
    comp = roots(fps.values(), 4)
    least = {}
    for i in sorted(kept):
        least.setdefault(comp[fps[i]], i)
    kept = {i: t for i, t in kept.items() if i in least.values()}
    assert got == kept

    keyed = [tuple(r) for r in out.select("doc_id", text_key(out.text), "text").collect()]
    out, got = step("substring_dedup", out)
    assert got == dict(brute(keyed, plain_runs(S.MIN_WORDS), char_cut, False))
    assert sum(len(t or "") for t in got.values()) < sum(len(t or "") for t in kept.values())

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in steps["packing"](spark, out, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in pieces.items()} == {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in got.items()}

    run = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.start, r.length) for r in run.collect()) == sorted((i, a, len(p)) for i, v in pieces.items() for a, p in v)


def test_empty_table(spark, folder, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
