"""Operators against brute-force Python folds on small in-memory fixtures (edge cases)."""

import bisect
import hashlib
import json
import random
from datetime import datetime, timedelta

from quarry.operators import replay as rp
from quarry.operators.fold import replay_fold
from quarry.operators.late import late_flags
from quarry.operators.monitoring import cumulative_histogram, histogram_quantile
from quarry.operators.ordering import count_decreases, count_in_range, global_row_number, running_last
from quarry.operators.partitioning import ring_node

ES_DDL = "seq long, time string, type string, photo_id long, data string"

# Three photos: one renamed twice, one with a filter and its undo, one deleted and added anew.
EXAMPLE = [
    (1, "2024-05-01T08:00:00.000Z", "addPhoto", 71, {"user": 5, "path": "/st/aa/one.jpg"}),
    (2, "2024-05-01T08:00:01.000Z", "addPhoto", 72, {"user": 6, "path": "/st/bb/two.jpg"}),
    (3, "2024-05-01T08:10:00.000Z", "updatePhotoData", 71, {"user": 5, "title": "Harbour"}),
    (4, "2024-05-01T08:20:00.000Z", "addPhoto", 73, {"user": 5, "path": "/st/cc/three.jpg"}),
    (5, "2024-05-02T09:00:00.000Z", "replacePhoto", 73, {"user": 5, "path": "/st/dd/grey.jpg", "operation": "/filter/grey"}),
    (6, "2024-05-02T09:01:30.000Z", "replacePhoto", 73, {"user": 5, "path": "/st/cc/three.jpg", "operation": "/undo"}),
    (7, "2024-05-02T10:00:00.000Z", "deletePhoto", 72, {"user": 6}),
    (8, "2024-05-03T07:00:00.000Z", "updatePhotoData", 71, {"user": 5, "title": "Harbour at dawn"}),
    (9, "2024-05-03T07:30:00.000Z", "addPhoto", 72, {"user": 6, "path": "/st/ee/again.jpg"}),
]


def _log(spark, rows):
    df = spark.createDataFrame([(s, t, ty, p, json.dumps(d)) for s, t, ty, p, d in rows], ES_DDL)
    return rp.decode(df)


def _state(df):
    return {r["photo_id"]: {"user": r["user"], "path": r["path"], "title": r["title"]} for r in df.collect()}


def _py(rows):
    """Closed form of the replay (E2), photo by photo: a photo exists if an event other than a deletion follows its
    last deletion; since then, its user comes from the last addition, its path from the last addition or
    replacement, its title from the last title change, which an addition empties."""
    out = {}
    for pid in {p for _, _, _, p, _ in rows}:
        own = [(s, ty, d) for s, _, ty, p, d in rows if p == pid]
        dead = max((s for s, ty, _ in own if ty == "deletePhoto"), default=0)
        live = sorted((s, ty, d) for s, ty, d in own if s > dead)
        if live:
            last = lambda *kinds: max((s for s, ty, _ in live if ty in kinds), default=None)
            at = {s: (ty, d) for s, ty, d in live}
            add, where, name = last("addPhoto"), last("addPhoto", "replacePhoto"), last("addPhoto", "updatePhotoData")
            out[pid] = {"user": at[add][1].get("user") if add else None, "path": at[where][1].get("path") if where else None,
                        "title": None if name is None else "" if at[name][0] == "addPhoto" else at[name][1].get("title")}
    return out


def _norm(state):
    return {k: {f: v.get(f) for f in ("user", "path", "title")} for k, v in state.items()}


def _random_log(n=400, photos=12, seed=7):
    rng = random.Random(seed)
    types = ["addPhoto", "updatePhotoData", "replacePhoto", "deletePhoto", "likePhoto"]
    rows = []
    for s in range(1, n + 1):
        ty = rng.choice(types)
        d = {"user": rng.randint(1, 5)}
        if ty in ("addPhoto", "replacePhoto"):
            d["path"] = f"/st/{s}.jpg"
        if ty == "updatePhotoData":
            d["title"] = f"t{s}"
        rows.append((s, f"2021-12-{1 + s // 100:02d}T00:00:{s % 60:02d}.000Z", ty, rng.randint(1, photos), d))
    return rows


def test_replay_worked_example(spark):
    st = _state(rp.current_state(_log(spark, EXAMPLE)))
    assert st == {71: {"user": 5, "path": "/st/aa/one.jpg", "title": "Harbour at dawn"},
                  72: {"user": 6, "path": "/st/ee/again.jpg", "title": ""},
                  73: {"user": 5, "path": "/st/cc/three.jpg", "title": ""}}
    st = _state(rp.state_at(_log(spark, EXAMPLE), "2024-05-02T09:30:00Z"))
    assert st[71]["title"] == "Harbour" and st[72]["path"] == "/st/bb/two.jpg" and st[73]["path"] == "/st/cc/three.jpg"


def test_replay_matches_fold_on_random_logs(spark):
    for seed in (1, 2, 3):
        rows = _random_log(seed=seed)
        log = _log(spark, rows)
        want = _norm(_py(rows))
        assert _state(rp.current_state(log)) == want
        assert _state(replay_fold(log, n_blocks=5)) == want
        assert _state(rp.replay_from_snapshot(log, 150)) == want


def test_history_matches_fold_after_each_event(spark):
    rows = _random_log(n=200, photos=5, seed=11)
    h = {r["seq"]: r for r in rp.history(_log(spark, rows), n_blocks=7).collect()}
    for i, (s, _, ty, p, _) in enumerate(rows):
        state = _py(rows[: i + 1])
        if ty == "deletePhoto":
            assert not h[s]["exists"]
        else:
            want = state[p]
            assert (h[s]["user"], h[s]["path"], h[s]["title"]) == (want.get("user"), want.get("path"), want.get("title"))


def test_mutable_table_drops_partial_rows(spark):
    rows = [(1, "t", "updatePhotoData", 1, {"title": "x"}), (2, "t", "addPhoto", 2, {"user": 1, "path": "/p"}),
            (3, "t", "deletePhoto", 2, {}), (4, "t", "replacePhoto", 2, {"path": "/q"})]
    log = _log(spark, rows)
    assert set(_state(rp.current_state(log))) == {1, 2}
    assert _state(rp.mutable_table(log)) == {}


def _late(events):
    """W3 by definition: an event is late if, before it, its window had an event already and some time seen
    lies more than two hours behind the window's end."""
    start = lambda t: t.replace(minute=0, second=0, microsecond=0) - timedelta(hours=t.hour % 6)
    late = set()
    for n, (eid, t) in enumerate(events):
        before = [x for _, x in events[:n]]
        if any(start(x) == start(t) for x in before) and max(before) > start(t) + timedelta(hours=8):
            late.add(eid)
    return late


def test_late_flags_match_per_event_fold(spark):
    rng = random.Random(5)
    base = datetime(2024, 1, 1)
    ev = [(i, base + timedelta(seconds=rng.randint(0, 3 * 86400))) for i in range(600)]
    arrival = {i: (t + timedelta(seconds=rng.randint(0, 10 * 3600))) for i, t in ev}
    order = sorted(ev, key=lambda e: (arrival[e[0]], e[0]))
    want = _late(order)
    df = spark.createDataFrame([(i, t, int(arrival[i].timestamp() * 1e6)) for i, t in ev],
                               "event_id long, ts timestamp_ntz, arrival long")
    got = {r["event_id"] for r in late_flags(df, "ts", ["arrival", "event_id"], n_blocks=9).filter("late").collect()}
    assert got == want and len(want) > 0


def _h(x):
    return int(hashlib.md5(str(x).encode()).hexdigest()[:8], 16)


def test_ring_matches_bisect(spark):
    for nodes in (4, 5):
        ring = sorted((_h(f"node{n}-{i}"), n) for n in range(nodes) for i in range(100))
        keys = [h for h, _ in ring]
        df = spark.range(3000).withColumnRenamed("id", "k")
        got = {r["k"]: r["node"] for r in ring_node(df, "k", nodes).collect()}
        want = {k: ring[bisect.bisect(keys, _h(k)) % len(ring)][1] for k in range(3000)}
        assert got == want


def test_count_in_range_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 3), rng.randint(0, 50) * 1000) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, u int, t long")
    got = {r["id"]: r["c"] for r in count_in_range(df, ["u"], "t", "id", 5000, name="c").collect()}
    for i, u, t in rows:
        assert got[i] == sum(1 for _, u2, t2 in rows if u2 == u and t - 5000 < t2 <= t)


def test_running_values_and_numbering(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice("ab"), rng.choice([None, rng.randint(0, 99)])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, p string, v int")
    got = {r["id"]: r["v_last"] for r in running_last(df, ["p"], ["id"], ["v"], n_blocks=7).collect()}
    last = {}
    for i, p, v in rows:
        if v is not None:
            last[p] = v
        assert got[i] == last.get(p)
    nums = {r["id"]: r["row_no"] for r in global_row_number(df, ["id"], n_blocks=5).collect()}
    assert nums == {i: i + 1 for i in range(300)}
    dec = count_decreases(df.na.fill({"v": 0}), ["id"], "v").first()["decreases"]
    vals = [v or 0 for _, _, v in rows]
    assert dec == sum(1 for a, b in zip(vals, vals[1:]) if b < a)


def test_histogram_quantile_interpolates(spark):
    vals = [0.01, 0.02, 0.15, 0.15, 0.4, 0.7, 2.5, 100.0]
    df = spark.createDataFrame([("c", v) for v in vals], "c string, v double")
    hist = cumulative_histogram(df, ["c"], "v", [0.05, 0.2, 1.0])
    cum = {r["le"]: r["cum_count"] for r in hist.collect()}
    assert cum == {0.05: 2, 0.2: 4, 1.0: 6, float("inf"): 8}
    q = {r["c"]: r["quantile"] for r in histogram_quantile(hist, ["c"], 0.5).collect()}
    assert abs(q["c"] - 0.2) < 1e-9  # rank 4 is the end of the 2nd bucket
    q = histogram_quantile(hist, ["c"], 0.3).first()["quantile"]
    assert abs(q - (0.05 + 0.15 * (2.4 - 2) / 2)) < 1e-9
    q = histogram_quantile(hist, ["c"], 0.99).first()["quantile"]
    assert q == 1.0  # +Inf bucket -> highest finite bound


def test_delivery_modes(spark):
    from quarry.plans.streaming_q import x12

    rows = {r["mode"]: r for r in x12(spark, "/root/testdata/sf0.001").collect()}
    assert rows["at-most-once"]["lost"] >= 0
    assert rows["idempotent"]["charged_twice"] == 0 and rows["idempotent"]["lost"] == 0
    assert rows["at-least-once"]["charged_twice"] == rows["at-most-once"]["lost"]


def test_pushdown_and_pruning(spark):
    from quarry.plans.predicates import p3
    from quarry.plans.scans import s16

    plan = p3(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    plan = s16(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_stable_hash_matches_python(spark):
    from quarry.functions.core import stable_hash

    got = {r["id"]: r["h"] for r in spark.range(50).select("id", stable_hash("id").alias("h")).collect()}
    assert got == {i: _h(i) for i in range(50)}



def test_lists_by_position_have_one_shape_at_any_size(spark):
    from quarry.operators.documents import positioned

    rows = [(1, 7)] * 3000 + [(1, i) for i in range(1500)] + [(2, 5), (2, 4), (3, None)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    for distinct in (True, False):
        want = {}
        for k, v in sorted(set(rows) if distinct else rows, key=lambda r: (r[0], r[1] is not None, r[1])):
            want.setdefault(k, []).append(v)
        got = {}
        for r in sorted(positioned(df, ["k"], "v", "item", distinct).collect(), key=lambda r: (r["k"], r["pos"])):
            got.setdefault(r["k"], []).append(r["item"])
            assert r["pos"] == len(got[r["k"]]) - 1
        assert got == want


def test_running_values_over_blocks(spark):
    from quarry.operators import ordering

    rng = random.Random(4)
    rows = [(i, rng.choice("abc"), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, p string, v int")
    got = {r["id"]: (r["_rank"], r["_run_max"]) for r in ordering.prefix_running(df, ["p"], ["id"], "v", 7).collect()}
    seen, mx = {}, {}
    for i, p, v in rows:
        seen[p] = seen.get(p, 0) + 1
        mx[p] = max(mx.get(p, v), v)
        assert got[i] == (seen[p], mx[p])


def test_blocks_follow_the_data(spark):
    """One outlier, a hot value and text keys: no block holds over twice its share, and values are right."""
    from quarry.operators import ordering

    rows = [(0 if i == 0 else 10**12 + (7 if i % 3 else i), str(i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "t long, s string, i long").repartition(5)
    sizes = [r["count"] for r in ordering.with_blocks(df, ["t", "s"], 10).groupBy("_blk").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 2 * 3000 / 10
    for cols in (["t", "s"], ["s"]):
        got = {r["i"]: r["row_no"] for r in ordering.global_row_number(df, cols, 10).collect()}
        order = sorted(rows, key=lambda r: (r[0], r[1]) if len(cols) == 2 else r[1])
        assert got == {r[2]: n + 1 for n, r in enumerate(order)}


def test_worker_load_of_contiguous_partitions(spark):
    from quarry.plans.streaming_q import worker_load

    counts = spark.createDataFrame(list(enumerate([135, 41, 181, 47, 42, 77])), "partition int, n long")
    w = spark.createDataFrame([(1,), (3,), (6,), (8,)], "workers int")
    got = {r["workers"]: (r["busiest"], r["idle"]) for r in worker_load(counts, w).collect()}
    assert got == {1: (523, 0), 3: (228, 0), 6: (181, 0), 8: (181, 2)}


def test_modulo_moves_most_keys_ring_moves_a_fifth(spark):
    from quarry.plans.partitioning import h3

    r = {x["method"]: x for x in h3(spark, "/root/testdata/sf0.01").collect()}
    assert r["hash % nodes"]["moved_share"] == 0.8
    assert 0.1 <= r["consistent hashing"]["moved_share"] <= 0.3
    assert r["consistent hashing"]["moved_elsewhere"] == 0


def test_strict_parsers_fail_fast(spark):
    import pytest

    from quarry.functions.core import log_time_strict, parse_access_strict

    ok = spark.createDataFrame([('1.2.3.4 - u1 [01/Jan/2024:00:00:07 +0000] "GET /st/1 HTTP/1.1" 200 5',)], "line string")
    assert ok.select(log_time_strict("line").alias("t")).first()["t"] == datetime(2024, 1, 1, 0, 0, 7)
    assert ok.select(parse_access_strict("line").alias("r")).first()["r"]["status"] == 200
    bad = spark.createDataFrame([("junk line",)], "line string")
    with pytest.raises(Exception):
        bad.select(log_time_strict("line")).collect()
    with pytest.raises(Exception):
        bad.select(parse_access_strict("line")).collect()


def test_parsers_survive_bad_lines(spark):
    from quarry.functions import core as fn

    one = lambda text, col: spark.createDataFrame([(text,)], "x string").select(col.alias("y")).first()["y"]
    bad = one("junk", fn.parse_access("x"))
    assert (bad["status"], bad["time"], bad["path"], bad["is_parsed"]) == (None, None, "", False)
    assert one(None, fn.parse_access("x"))["is_parsed"] is False
    good = one('1.2.3.4 - u1 [01/Jan/2024:00:00:07 +0000] "GET /st/1 HTTP/1.1" 200 5 "-" "x"', fn.parse_access("x"))
    assert (good["ip"], good["user"], good["method"], good["path"], good["status"], good["is_parsed"]) == ("1.2.3.4", "u1", "GET", "/st/1", 200, True)
    assert one('a=1 image.format=jpeg a=2 m="say \\"hi\\" now" e=', fn.logfmt("x")) == {"a": "2", "image.format": "jpeg", "m": 'say "hi" now', "e": ""}
    assert one("", fn.logfmt("x")) == {}
    assert one("a=1\n b=2\na=3\nc=99999999999999999999\nno", fn.report_to_map("x")) == {"a": 3, "b": 2, "c": None}
    assert one('{"a": 12, "b": "12", "c": 1.5, "d": 99999999999999999999999, "e": null, "f": [1], "g": -3}', fn.int_fields("x")) == {"a": 12, "g": -3}
    assert one("not json", fn.int_fields("x")) is None


def test_a_replaced_table_gives_new_answers(spark, tmp_path):
    from quarry.plans.registry import load_all

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    query = load_all()["L1_ingest_labels_time"].build
    counts = []
    for n in (10, 50):
        events.orderBy("event_id").limit(n).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
        counts.append(sum(r["lines"] for r in query(spark, str(tmp_path)).collect()))
    assert counts[0] < counts[1]
