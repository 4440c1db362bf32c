import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import divergence as D
from quarry.llm.queries import QUERIES
from tests.llm.conftest import DOCS, ODD, SF


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, min_docs=3, top=200):
    docs, used = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        ws = words(text)
        docs[lang or ""].update(set(ws))
        used[lang or "", source or ""].update(ws)
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        groups = {s: c for (l, s), c in used.items() if l == lang}
        total = Counter()
        for c in groups.values():
            total.update(c)

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(total)
        gap = lambda a, b, t: (a[t] - b[t]) ** 2 // b[t]
        for s in groups:
            pairs = [(sum(gap(p[s], p[o], t) for t in kept), o) for o in groups if o != s]
            terms = [(gap(p[s], q, t), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())))]
    return sorted(out)


def run(docs, **how):
    return sorted(tuple(r) for r in D.audit(docs, **how).collect())


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, source, 1, "p", 7, "r", "d", "h", 1) for k, (t, lang, source) in enumerate(rows)], DOCS).repartition(4)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="abZé\x01 Aa", max_size=40), st.sampled_from(["a" * 300, "a" * 300 + "b", "a" * 264, "abcdefgh", "abcdefghi", "", "日本 語"])), max_size=12))
def test_pointers_are_sorted_as_their_terms(texts):
    data = D._LOWER[np.frombuffer(b"".join(t.encode() + b"\0" for t in texts), np.uint8)]
    starts, ends = D.pointers(data)
    terms = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert terms == [w.encode() for t in texts for w in words(t)]
    order, runs = D.sorted_pointers(data, starts, ends)
    assert [(terms[k], k) for k in order] == sorted((t, k) for k, t in enumerate(terms))
    assert [terms[order[r]] for r in runs] == sorted(set(terms))


def test_against_brute_force_with_many_sources(spark):
    """More sources than fit in a block, one of them with a third of the rows, and languages without kept terms."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{chr(97 + k % 26)}{'x' * (k % 11)}é"[:12] for k in range(60)]
    rows = [(" ".join(rng.choice(vocabulary, rng.integers(0, 12))), ["en", "", None, "de"][k % 4], f"s{k % 3 and k * 7 % 75}") for k in range(600)]
    rows += [("lonely words", "xx", "a"), ("other ones", "xx", "b"), ("", "xx", None), ("Ab aB AB ab", "yy", "s")] + [("same text here", "zz", "hot")] * 50
    assert run(frame(spark, rows)) == brute(rows)
    assert run(frame(spark, rows), min_docs=1, top=3) == brute(rows, 1, 3)


@pytest.mark.parametrize("size", [1, 4000])
def test_shards_of_any_size(spark, size):
    rows = [(f"the cat {k % 5} the dog{'s' * (k % 3)}", "en", f"s{k % 4}") for k in range(40)]
    assert run(frame(spark, rows), shard_bytes=size) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(t, None, "s") for _, t in ODD]
    assert run(odd_docs) == brute(rows)
    more = odd_docs.withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.col("source")))
    assert run(more) == brute([(r.text, r.lang, r.source) for r in more.collect()])
    assert run(no_docs) == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(tuple(r) for r in QUERIES["op12_source_divergence"](spark, SF).collect()) == brute([(r.text, r.lang, r.source) for r in docs])
