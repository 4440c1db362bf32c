"""Audited logs: lost rows are those of a multiset difference; only blocks that differ are opened."""

import os
import random
from collections import Counter

import pytest

from quarry.operators.audit import AuditedLog

DDL = "seq long, at timestamp, s string, x double"


def _rows(n, rng):
    from datetime import datetime, timedelta

    return [(i, datetime(2024, 1, 1) + timedelta(microseconds=i), rng.choice([None, "", "a", "é,\":"]), rng.choice([None, 0.5, 1e300])) for i in range(n)]


def _log(spark, tmp_path, **more):
    return AuditedLog(spark, str(tmp_path / "log"), DDL, "seq", **{"block_rows": 50, "fan_out": 4, **more})


def _df(spark, rows):
    return spark.createDataFrame(rows, DDL)


def _got(df):
    return Counter(tuple(r) for r in df.collect())


def _spoil(log, version, keep):
    for d, _, files in os.walk(f"{log.path}/rows/v={version}"):
        block = os.path.basename(d)
        if block.startswith("block=") and int(block[6:]) not in keep:
            for f in files:
                with open(f"{d}/{f}", "wb") as out:
                    out.write(b"spoiled")


def test_append_is_no_loss_and_opens_the_last_block_only(spark, tmp_path):
    rows = _rows(1000, random.Random(1))
    log = _log(spark, tmp_path)
    log.store(_df(spark, rows[:470]), 1)
    log.store(_df(spark, rows[470:]), 2, base=1)
    whole = log.store(_df(spark, rows[::-1]), 3)
    assert log.root(2) == whole != log.root(1)
    assert log.differing(1, 2) == [10] and log.differing(2, 3) == []
    _spoil(log, 1, {10})
    _spoil(log, 2, {10})
    assert log.lost(1, 2).count() == 0


def test_changed_and_removed_rows_are_named_from_their_blocks(spark, tmp_path):
    rng = random.Random(2)
    rows = _rows(1000, rng)
    log = _log(spark, tmp_path)
    log.store(_df(spark, rows), 1)
    other = [r for r in rows if r[0] != 333]
    other[700] = (*other[700][:2], "changed", 2.0)
    other[701] = (other[701][0], other[701][1].replace(microsecond=0), *other[701][2:])  # microseconds count
    log.store(_df(spark, other), 2)
    blocks = {1 + 333 // 50, 1 + rows[701][0] // 50, 1 + rows[702][0] // 50}
    assert log.differing(1, 2) == sorted(blocks)
    for v in (1, 2):
        _spoil(log, v, blocks)
    assert _got(log.lost(1, 2)) == Counter([rows[333], rows[701], rows[702]])


def test_any_two_versions_as_multisets(spark, tmp_path):
    rng = random.Random(3)
    log = _log(spark, tmp_path, block_rows=7, fan_out=3)
    base = [(rng.choice([None, -5, *range(120)]), None, rng.choice(["a", None]), 1.0) for _ in range(150)] * 2
    stored = {}
    for v in range(1, 5):
        stored[v] = rng.sample(base, rng.choice([20, 150, 299])) if v < 4 else []
        log.store(_df(spark, stored[v]), v)
    for a in stored:
        for b in stored:
            assert _got(log.lost(a, b)) == Counter(stored[a]) - Counter(stored[b])
    assert log.root(4) == ""


def test_damage_behind_the_back_of_the_log(spark, tmp_path):
    rows = _rows(300, random.Random(4))
    log = _log(spark, tmp_path)
    log.store(_df(spark, rows), 1)
    assert log.damaged(1).count() == 0
    _df(spark, [(101, None, "forged", 0.0)]).write.mode("overwrite").parquet(f"{log.path}/rows/v=1/block=3")
    assert [r.block for r in log.damaged(1).collect()] == [3]


@pytest.mark.parametrize("name", ["Q13_append_only_audit", "Q13b_rows_lost_between_versions"])
def test_queries(spark, name):
    from quarry.verify import compare, duck_con

    from .conftest import SF_SMALL

    r = compare(spark, name, SF_SMALL, duck_con(SF_SMALL))
    assert r["status"] == "ok" and r["rows"] > 0
