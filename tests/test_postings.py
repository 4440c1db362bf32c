"""The posting-list index: exact lists, hot keywords over many files, and searches that open only the files they need."""

import random
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import postings as P


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, (1 << 64) - 1), st.sampled_from([127, 128, 16383, 16384, (1 << 63) - 1])), max_size=40))
def test_numbers_come_back(values):
    data, size = P.to_bytes(np.array(values, np.uint64))
    assert P.from_bytes(data).tolist() == values and size.sum() == len(data)
    assert all(n == max(1, -(-v.bit_length() // 7)) for v, n in zip(values, size.tolist()))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = [("the", "o1", i * 3) for i in range(30000)] + [(f"w{rng.randint(0, 800)}", f"o{rng.randint(0, 9)}", rng.randint(-2**62, 2**62)) for _ in range(8000)]
    rows = sorted(set(rows + [("é", "o1", 5), ("the", None, 7), ("the", "o2", -1), ("the", "o2", 1)]), key=str)
    df = spark.createDataFrame(rows, "keyword string, owner string, id bigint").repartition(5)
    return rows, P.PostingIndex.build(df, str(tmp_path_factory.mktemp("index")) + "/i", parts=12)


def test_all_postings(index):
    rows, i = index
    assert sorted((tuple(r) for r in i.postings().collect()), key=str) == rows
    assert i.segments().agg(F.max("n")).first()[0] <= P.SEGMENT


def test_a_hot_keyword_lies_in_many_files(index):
    _, i = index
    sizes = {r.part: r.n for r in i.segments().groupBy("part").agg(F.sum("n").alias("n")).collect()}
    assert len(sizes) == 12 and max(sizes.values()) < 3 * sum(sizes.values()) / 12
    assert i.directory().filter("keyword = 'the' and owner = 'o1'").count() >= 6


def test_search_opens_the_files_it_needs(index, spark):
    rows, i = index
    asked = [("w17", "o3"), ("é", "o1"), ("the", "o2"), ("nothing", "o1"), ("the", "nobody"), ("é", "o1")]
    requests = spark.createDataFrame([(k, *a) for k, a in enumerate(asked)], "n int, keyword string, owner string")
    want = sorted(((n, w, o, d) for n, (w, o) in enumerate(asked) for d in [x for k, p, x in rows if (k, p) == (w, o)] or [None]), key=str)
    assert sorted((tuple(r[c] for c in ("n", "keyword", "owner", "id")) for r in i.search(requests).collect()), key=str) == want
    needed = {r.part for r in i.directory().collect() if (r.keyword, r.owner) in asked}
    opened = i.files_of(i.lists_of(requests)).select("_metadata.file_path").distinct().collect()
    assert 0 < len(opened) == len(needed) < 6
    scans = i.search(requests)._jdf.queryExecution().executedPlan().toString().split("FileScan")
    assert any("steps" in s and "PartitionFilters: [part" in s for s in scans)


def test_an_empty_index(spark, tmp_path):
    i = P.PostingIndex.build(spark.createDataFrame([], "keyword string, owner string, id bigint"), f"{tmp_path}/i")
    assert i.postings().count() == 0
    assert [tuple(r) for r in i.search(spark.createDataFrame([("a", "b")], "keyword string, owner string")).collect()] == [("a", "b", None)]


def _shuffle_files(spark):
    of = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in of for p in Path(d).rglob("shuffle_*.data")}


def test_stored_parts_leave_no_shuffle_files(spark, tmp_path):
    rows = [(f"w{i % 50}", f"o{i % 3}", i) for i in range(2000)]
    before = _shuffle_files(spark)
    i = P.PostingIndex.build(spark.createDataFrame(rows, "keyword string, owner string, id bigint").repartition(3), f"{tmp_path}/i", parts=4)
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert i.segments().agg(F.sum("n")).first()[0] == 2000


def test_hits_reach_the_join_as_arrays(index, spark):
    rows, i = index
    requests = spark.createDataFrame([(n, "the", "o1") for n in range(3)] + [(3, "the", "nobody"), (4, None, "o1")], "n int, keyword string, owner string")
    found = i.search(requests)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(ids") < plan.index("Join LeftOuter") and "LeftSemi" in plan
    got = found.groupBy("n").agg(F.count("id"), F.min("id"), F.max("id"), F.count(F.lit(1))).sort("n").collect()
    assert [tuple(r) for r in got] == [(n, 30000, 0, 89997, 30000) for n in range(3)] + [(3, 0, None, None, 1), (4, 0, None, None, 1)]
    assert found.columns == ["keyword", "owner", "n", "id"]


def test_segments_are_decoded_many_at_a_time(monkeypatch):
    rng = random.Random(6)
    lists = {f"w{k:04}": sorted({rng.randint(-2**63, 2**63 - 1) for _ in range(rng.randint(1, 4))} | ({-2**63, 2**63 - 1} if k % 7 == 0 else set())) for k in range(3000)}
    rows = pa.RecordBatch.from_pylist([{"keyword": w, "owner": "o", "id": i} for w, ids in lists.items() for i in ids] + [{"keyword": "x", "owner": None, "id": 5}],
                                      pa.schema([("keyword", pa.string()), ("owner", pa.string()), ("id", pa.int64())]))
    [segments] = P._segments([rows])
    calls, plain = [], P.from_bytes
    monkeypatch.setattr(P, "from_bytes", lambda data: calls.append(len(data)) or plain(data))
    assert [r for b in P._postings([segments, segments.slice(0, 0)]) for r in b.to_pylist()] == rows.to_pylist()
    assert len(segments) == 3001 and len(calls) == 1
    monkeypatch.setattr(P, "IDS_AT_ONCE", 100)
    assert [r for b in P._postings([segments.slice(10, 2000)]) for r in b.to_pylist()] == [{"keyword": w, "owner": "o", "id": i} for w, ids in [*lists.items()][10:2010] for i in ids]


def test_the_directory_is_sorted_and_has_a_row_per_list_and_file(index, spark):
    _, i = index
    want = i.segments().groupBy(*P.KEYS, "part").agg(F.min("first_id"), F.max("last_id"), F.sum("n"))
    assert sorted(map(tuple, i.directory().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    stored = sorted(Path(f"{i.path}/directory").glob("*.parquet"))
    keys = [(w is not None, w or "", o is not None, o or "", p) for f in stored for w, o, p in zip(*(pq.read_table(f).column(c).to_pylist() for c in (*P.KEYS, "part")), strict=True)]
    assert keys == sorted(keys)


def test_many_requests_for_one_list_are_stored_in_few_bytes(spark, tmp_path):
    rng = random.Random(8)
    ids = rng.sample(range(1 << 40), 10000)
    i = P.PostingIndex.build(spark.createDataFrame([("the", "o", n) for n in ids], "keyword string, owner string, id bigint"), f"{tmp_path}/i")
    requests = spark.createDataFrame([(7 * n, "the", "o") for n in range(100)], "n bigint, keyword string, owner string")
    i.search(requests).write.parquet(f"{tmp_path}/found")
    found = spark.read.parquet(f"{tmp_path}/found")
    assert found.distinct().count() == found.count() == 1_000_000  # over 1.7 MB with the hits of one request after the other
    assert sum(p.stat().st_size for p in Path(f"{tmp_path}/found").glob("*.parquet")) < 600_000


@pytest.mark.parametrize("size", [1, 3, 512])
def test_requests_are_grouped_and_none_is_lost(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(P, "GROUP", size)
    rows = [("a", "o", n) for n in (5, 3, 9)] + [("b", "p", 1), (None, "o", 2), ("a", None, 4)]
    i = P.PostingIndex.build(spark.createDataFrame(rows, "keyword string, owner string, id bigint"), f"{tmp_path}/i", parts=2)
    asked = [(n, "a", "o", [n], "x") for n in range(8)] * 2 + [(n, "z", "o", None, None) for n in range(5)] + [(1, None, "o", [], "y"), (1, None, "o", [], "y"), (2, "a", None, None, "y"), (None, "b", "p", None, None)]
    schema = "n int, keyword string, owner string, `r.asked` array<int>, asked string"
    found = i.search(spark.createDataFrame(asked, schema).repartition(3))
    assert found.columns == ["keyword", "owner", "n", "r.asked", "asked", "id"]
    want = [(w, o, n, x, s, j) for n, w, o, x, s in asked for j in ([k for a, b, k in rows if (a, b) == (w, o) and None not in (w, o)] or [None])]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    bare = spark.createDataFrame([("b", "p"), ("b", "p"), ("q", "p"), (None, None)], "keyword string, owner string")
    assert sorted(map(tuple, i.search(bare).collect()), key=str) == [("b", "p", 1), ("b", "p", 1), ("q", "p", None), (None, None, None)]
    assert i.search(bare).columns == ["keyword", "owner", "id"]


def test_the_rows_of_a_hot_list_are_not_made_by_the_code_that_joins(index, spark):
    _, i = index
    requests = spark.createDataFrame([(n, "the", "o1") for n in range(1000)], "n int, keyword string, owner string")
    found = i.search(requests)
    assert found.agg(F.count("id"), F.countDistinct("n"), F.countDistinct("id")).first() == (30_000_000, 1000, 30000)
    few = i.search(requests.limit(2))
    few.collect()
    plan = few._jdf.queryExecution().executedPlan().toString()
    stage = dict(re.findall(r"\*\((\d+)\) (Generate explode\(ids|SortMergeJoin \[owner|BroadcastHashJoin \[owner)", plan.split("Initial Plan")[0])[::-1])
    assert len(stage) == 2  # the stages of code differ


def test_lists_are_cut_into_pieces(monkeypatch):
    monkeypatch.setattr(P, "PIECE", 4)
    lists = {"a": [1, 2, 3, 5, 8, 13, 21, 34], "b": [7], "c": list(range(-3, 6))}
    rows = pa.RecordBatch.from_pylist([{"keyword": w, "owner": "o", "id": i} for w, ids in lists.items() for i in ids])
    got = [r for b in P._lists(P._segments([rows])) for r in b.to_pylist()]
    assert [(r["keyword"], r["ids"]) for r in got] == [("a", [1, 2, 3, 5]), ("a", [8, 13, 21, 34]), ("b", [7]), ("c", [-3, -2, -1, 0]), ("c", [1, 2, 3, 4]), ("c", [5])]
