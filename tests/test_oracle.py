"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from quarry.plans.registry import load_all
from quarry.verify import compare, duck_con

from .conftest import SF_SMALL

NAMES = sorted(load_all())


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["status"] in ("ok", "rows-only"), r.get("problems")
    assert r["rows"] >= 0


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["path", "views"]
    assert len(df.collect()) == 5
    assert set(e.oracle_sql()) <= set(e.queries())
