"""max_over_time at each step against its definition."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.operators.monitoring import max_over_time

DAY = datetime(2024, 1, 1)


@pytest.mark.parametrize(("range_s", "step_s"), [(900, 2), (30, 10), (7, 7)])
def test_each_step_has_the_maximum_of_its_range(spark, range_s, step_s):
    rng = random.Random(range_s)
    rows = [(rng.choice(["a", "a", "b", None]), DAY + timedelta(milliseconds=500 * rng.randint(-4000, 4000)), rng.randint(-9, 9)) for _ in range(700)]
    rows += [("a", DAY, 5), ("a", None, 99)]
    got = max_over_time(spark.createDataFrame(rows, "host string, t timestamp_ntz, v int"), ["host"], "t", F.sum("v"), range_s, step_s).collect()
    total = {}
    for host, t, v in rows:
        if t is not None:
            at = -(-int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1)) // (step_s * 1_000_000)) * step_s
            total[host, at] = total.get((host, at), 0) + v
    want = {(h, at): (n, max(m for (g, b), m in total.items() if g == h and at - range_s < b <= at)) for (h, at), n in total.items()}
    assert {(r.host, (r.step - datetime(1970, 1, 1)) // timedelta(seconds=1)): (r.total, r.max_over_time) for r in got} == want
    assert len(got) == len(want)


def test_a_range_of_whole_steps_only(spark):
    with pytest.raises(ValueError):
        max_over_time(spark.range(0).withColumn("t", F.lit(None).cast("timestamp_ntz")), [], "t", F.sum("id"), 15, 2)
