"""A fold kept across runs: equal to the whole fold after every run, and only new events and their buckets are touched."""

import random

from pyspark.sql import functions as F

from quarry.operators.fold import ReplayFold, StoredFold, replay_fold

DDL = "photo_id long, seq long, type string, user int, path string, title string"


def test_runs_add_up_to_the_whole_fold(spark, tmp_path):
    rng = random.Random(5)
    kinds = ["addPhoto", "updatePhotoData", "replacePhoto", "deletePhoto", "other"]
    rows = [(rng.choice([None, 1, 1, 1, *range(30)]), s, rng.choice(kinds), rng.choice([None, 4]), f"p{s}", rng.choice([None, "", f"t{s}"])) for s in range(600)]
    rows.append((3, 600, "addPhoto", 9, "last", None))
    log = spark.createDataFrame(rows, DDL)
    kept = StoredFold(spark, str(tmp_path / "f"), "photo_id", "bigint", "seq", ReplayFold(), buckets=8).create()
    assert kept.position() is None and kept.state().count() == 0
    for upto in (249, 599, 600):
        before = kept.table.manifest()
        kept.advance(log.filter(F.col("seq") <= upto), n_blocks=3)
        whole = replay_fold(log.filter(F.col("seq") <= upto), n_blocks=3)
        assert kept.position() == upto
        assert sorted(map(str, kept.state().collect())) == sorted(map(str, whole.collect()))
    assert sum(before[b] != now for b, now in kept.table.manifest().items()) == 1  # the last run had one event
    again = kept.table.manifest()
    kept.advance(log)
    assert kept.table.manifest() == again
