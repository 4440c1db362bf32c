"""The window reporter against an event-by-event fold, for several cuts into micro-batches."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.streaming.closing import WindowReporter

BASE = datetime(2024, 1, 1)


def start(t):
    return t.replace(hour=t.hour // 6 * 6, minute=0, second=0, microsecond=0)


def fold(events):
    """Event by event in order of arrival: reports by window, and (counted, late) by window."""
    counts, closed, late, latest = {}, {}, Counter(), None
    for _, t, obj in events:
        w = start(t)
        if w in closed:
            late[w] += 1
        else:
            counts.setdefault(w, Counter())[obj] += 1
        latest = t if latest is None else max(t, latest)
        for w in list(counts):
            if w + timedelta(hours=8) < latest:
                closed[w] = counts.pop(w)
    text = {w: (sum(c.values()), ", ".join(f"{o} {n}" for o, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:3])) for w, c in closed.items()}
    return text, {w: (sum(c.values()), late[w]) for w, c in (counts | closed).items()}


@pytest.fixture(scope="module")
def arrivals():
    rng = random.Random(6)
    events = [(i, BASE + timedelta(seconds=rng.randint(0, 4 * 86400)), rng.choice("abcde")) for i in range(400)]
    delay = {i: timedelta(seconds=rng.randint(0, 12 * 3600)) for i, _, _ in events}
    return sorted(events, key=lambda e: (e[1] + delay[e[0]], e[0]))


@pytest.mark.parametrize("cuts", [[], [200], [1, 2, 150, 390]])
def test_any_micro_batches_give_the_same(spark, tmp_path, arrivals, cuts):
    reports, totals = fold(arrivals)
    assert sum(n for _, n in totals.values()) > 10 and len(reports) > 8
    reporter = WindowReporter(spark, str(tmp_path))
    edges = [0, *cuts, len(arrivals)]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        rows = [(t, obj, n, i) for n, (i, t, obj) in enumerate(arrivals)][a:b]
        batch = spark.createDataFrame(rows, "ts timestamp_ntz, obj string, arrival bigint, event_id bigint").orderBy(F.rand(3)).repartition(3)
        reporter(batch, k)
        if k == 1:
            reporter(batch, k)  # a batch that runs again changes nothing
    got = reporter.reports().collect()
    assert {r.window_start: (r.total, r.top) for r in got} == reports and len(got) == len(reports)
    state = reporter.state(len(edges) - 2)
    assert {r.window_start: (r.n, r.late) for r in state.groupBy("window_start").agg(F.sum("n").alias("n"), F.sum("late").alias("late")).collect()} == totals
    assert state.filter("reported").count() == len(reports)  # one row per closed window


def test_a_batch_is_read_once(spark, tmp_path, arrivals):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    ddl = "ts timestamp_ntz, obj string, arrival bigint, event_id bigint"
    batch = spark.createDataFrame([(t, obj, n, i) for n, (i, t, obj) in enumerate(arrivals)], ddl).mapInArrow(counted, ddl)
    WindowReporter(spark, str(tmp_path))(batch, 0)
    assert read.value == len(arrivals)
