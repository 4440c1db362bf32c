"""Consumer groups: positions equal a walk over the messages, whatever files were processed; commits follow the results."""

import random

import pytest

from quarry.streaming.groups import GroupTopic
from quarry.streaming.topic import MESSAGE_DDL


def _messages(spark, offsets):
    rows = [(None, f"m{o}", "t", p, o, None, []) for p, o in offsets]
    return spark.createDataFrame(rows, MESSAGE_DDL)


def _topic(spark, tmp_path):
    """Partition 0 holds most messages; offsets have gaps; partition 5 comes with the second append."""
    rng = random.Random(5)
    offsets = sorted({(rng.choice([0, 0, 0, 1, 2]), rng.randrange(400)) for _ in range(300)})
    topic = GroupTopic(spark, str(tmp_path / "topic"))
    topic.append(_messages(spark, offsets), 0, messages_per_file=20)
    more = [(p, o + 400) for p, o in offsets if o % 3 == 0] + [(5, 9)]
    topic.append(_messages(spark, more), 1, messages_per_file=20)
    return topic, offsets + more


def _positions(topic, group):
    return {r.partition: (r.high_watermark, r.committed, r.lag, r.waiting) for r in topic.positions(group).collect()}


def _walk(messages, seen):
    out = {}
    for p in {p for p, _ in messages}:
        mine = sorted(o for q, o in messages if q == p)
        at = -1
        for o in mine:
            if (p, o) not in seen:
                break
            at = o + 1
        out[p] = (mine[-1] + 1, at, mine[-1] + 1 - max(at, 0), sum((p, o) not in seen for o in mine))
    return out


def test_positions_after_any_files(spark, tmp_path):
    topic, messages = _topic(spark, tmp_path)
    files = topic.directory().collect()
    assert sum(f.partition == 0 for f in files) > 5 and max(f.messages for f in files) <= 20
    assert _positions(topic, "nobody") == _walk(messages, set())
    rng = random.Random(6)
    for trial in range(4):
        done = rng.sample(files, rng.choice([1, len(files) // 2, len(files) - 2]))
        group = f"g{trial}"
        for batch, part in enumerate((done[::2], done[1::2], done[:1])):  # the last one is committed twice
            topic.commit(group, batch, spark.createDataFrame([(f.partition, f.file) for f in part], "partition int, file string"))
        seen = {(p, o) for p, o in messages for f in done if p == f.partition and f.first <= o <= f.last}
        assert _positions(topic, group) == _walk(messages, seen)


def test_a_group_commits_what_it_has_stored(spark, tmp_path):
    topic, messages = _topic(spark, tmp_path)
    got = {}

    def store(batch, number):
        if number == 2 and not got.get("failed"):
            got["failed"] = True
            raise RuntimeError("results of batch 2 are not stored")
        got[number] = [(r.partition, r.offset) for r in batch.collect()]

    with pytest.raises(Exception, match="batch 2"):
        topic.consume("a", store, files_per_batch=3)
    seen = set(got[0] + got[1])
    assert _positions(topic, "a") == _walk(messages, seen)
    topic.consume("a", store, files_per_batch=3)
    got.pop("failed")
    assert sorted(m for part in got.values() for m in part) == sorted(messages)
    assert all(lag == waiting == 0 for _, _, lag, waiting in _positions(topic, "a").values())
    topic.append(_messages(spark, [(1, 2000), (1, 2001)]), 2)
    assert _positions(topic, "a")[1][2:] == (2002 - _walk(messages, set(messages))[1][0], 2)
    assert _positions(topic, "b") == _walk(messages + [(1, 2000), (1, 2001)], set())


def test_query(spark):
    from quarry.verify import compare, duck_con

    from .conftest import SF_SMALL

    r = compare(spark, "X16b_lag_from_stored_commits", SF_SMALL, duck_con(SF_SMALL))
    assert r["status"] == "ok" and r["rows"] == 18
