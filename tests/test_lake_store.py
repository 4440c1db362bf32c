"""The stored lake: the answers of a plain scan, from the chunks that may hold them only."""

import os
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import lake_store as L

START = datetime(2024, 3, 1)
TEXT = st.text(st.sampled_from("abAB é\U0001f600x"), max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=8), st.integers(0, 3), st.integers(1, 9))
def test_filters_hold_every_text_of_a_line(lines, skip, width):
    old, L.SLICE = L.SLICE, width
    try:
        array = pa.array([*[""] * skip, *lines], pa.string()).slice(skip).fill_null("")
        held = {int(p) for at in L._line_places(array, 1) for p in at}
    finally:
        L.SLICE = old
    expect = set()
    for line in lines:
        for a in range(len(line or "")):
            for b in range(a + 1, len(line) + 1):
                expect |= set(L.text_places(line[a:b].upper() if line[a:b].isascii() else line[a:b], 1).get(0, []))
    assert held == expect  # nothing across two lines either


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["GET", "error", "timeout", "Straße", "ok", "café", "user", "disk"]
    rows = []
    for i in range(4000):
        ts = None if i % 400 == 7 else START + timedelta(seconds=rng.randint(0, 5 * 86400) if i % 3 else 2 * 86400)  # a burst at one time
        line = None if i % 500 == 9 else " ".join(rng.choice(words) for _ in range(6)) + f" id={i}"
        rows.append((rng.choice(["web", "web", "web", "db", None]), ts, line, i))
    df = spark.createDataFrame(rows, "service string, ts timestamp_ntz, line string, n int")
    return rows, L.LakeStore.build(df, str(tmp_path_factory.mktemp("lake")) + "/l", chunks=24, pages=2)


def _ids(df):
    return sorted(r.n for r in df.select("n").collect())


def test_answers_are_those_of_a_scan(lake):
    rows, store = lake
    assert _ids(store.lines()) == list(range(4000))
    for a, b in [("2024-03-02 00:00:00", "2024-03-03 00:00:00"), ("2024-03-01 13:00:00", "2024-03-04 01:30:00"), ("2024-03-02 05:00:00", "2024-03-02 06:00:00")]:
        lo, hi = datetime.fromisoformat(a), datetime.fromisoformat(b)
        assert _ids(store.between(a, b)) == [n for _, ts, _, n in rows if ts and lo < ts <= hi]
        hit = store.holding(["ERROR id=1", "straße"], a, b)
        assert _ids(hit) == [n for _, ts, x, n in rows if ts and lo < ts <= hi and x and ("error id=1" in x or "Straße".lower() in x.replace("S", "s"))]
    for text in ["id=1234", "café disk", "no such text", "d=", "é"]:
        assert _ids(store.holding([text])) == [n for _, _, x, n in rows if x and text in x], text


def _spoil(store, keep):
    """Spoil the files of all chunks but ``keep``: whoever opens one fails.  Returns how many."""
    spoiled = 0
    for folder, _, files in os.walk(f"{store.path}/lines"):
        for f in files:
            if f.endswith(".parquet") and int(folder.rsplit("part=", 1)[1]) not in keep:
                with open(f"{folder}/{f}", "wb") as out:
                    out.write(b"spoiled")
                spoiled += 1
    return spoiled


def test_a_search_opens_only_its_chunks(spark, lake, tmp_path):
    rows, store = lake
    copy = L.LakeStore.build(store.lines().drop("day", "part"), str(tmp_path / "copy"), chunks=24, pages=8)
    rare = "ok id=" + next(x.rsplit("=", 1)[1] for _, _, x, _ in rows[1000:] if x and " ok id=" in x)
    keep = {r.chunk for r in copy.may_hold([rare]).collect()}
    assert 0 < len(keep) < 24
    want = [n for _, _, x, n in rows if x and rare in x]
    assert _spoil(copy, keep) and _ids(copy.holding([rare])) == want
    day = L.LakeStore.build(store.lines().drop("day", "part"), str(tmp_path / "day"), chunks=24)
    meets = {r.part for r in day.chunks().filter("day = '2024-03-04'").collect()}
    assert _spoil(day, meets) > 10
    assert _ids(day.between("2024-03-04 00:00:00", "2024-03-04 23:59:59")) == [n for _, ts, _, n in rows if ts and ts.day == 4 and ts > datetime(2024, 3, 4)]


def test_an_empty_lake(spark, tmp_path):
    empty = spark.createDataFrame([], "service string, ts timestamp_ntz, line string")
    store = L.LakeStore.build(empty, str(tmp_path / "e"))
    assert store.holding(["abc"]).count() == store.between("2024-01-01", "2024-02-01").count() == 0


def _tree(rows, depth, fan_out, level=0):
    """The sequential version: lines (tokens) of one node to their templates."""
    length = len(rows[0])
    if level == min(depth, length):
        tail = [c[0] if len(set(c)) == 1 else "<*>" for c in zip(*rows)][level:]
        return {r: tail for r in rows}
    groups = {}
    wide = len({r[level] for r in rows}) > fan_out
    for r in rows:
        groups.setdefault("<*>" if wide else r[level], []).append(r)
    return {r: [t, *rest] for t, part in groups.items() for r, rest in _tree(part, depth, fan_out, level + 1).items()}


def test_templates_are_those_of_the_sequential_tree(spark):
    from quarry.operators.loglake import placed_lines, templates

    rng = random.Random(8)
    rows = [(rng.choice(["a", "a", None]), " ".join(rng.choice("uvwxyz") * rng.randint(1, 3) for _ in range(rng.randint(1, 7)))) for _ in range(1500)]
    rows += [("b", f"start {w} now") for w in "abcdefghijkl"] + [("b", "retry 17 of 20"), ("b", " retry 3\tof 20 "), ("b", ""), ("b", None)]
    got = {(r.service, tuple(r.tokens)): (r.template, r.n) for r in placed_lines(spark.createDataFrame(rows, "service string, line string"), depth=3, fan_out=5).collect()}
    seen = {}
    for service, line in rows:
        if line is not None:
            toks = tuple("<*>" if any(c.isdigit() for c in t) else t for t in line.split()) or ("",)
            seen[service, toks] = seen.get((service, toks), 0) + 1
    want = {}
    for service, length in {(s, len(t)) for s, t in seen}:
        part = sorted(t for s, t in seen if s == service and len(t) == length)
        want |= {(service, t): (list(template), seen[service, t]) for t, template in _tree(part, 3, 5).items()}
    assert got == want
    sizes = {r.template: r["size"] for r in templates(spark.createDataFrame(rows, "service string, line string"), fan_out=5).filter(F.col("service") == "b").collect()}
    assert sizes == {"start <*> now": 12, "retry <*> of <*>": 2, "": 1}
