"""Every registered query of the engine against its SQL."""

import oracle
import pytest

from millrace.plans.catalogue import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf, name):
    got_cols, got, want_cols, want = oracle.both(spark, duck, QUERIES[name], ORACLE[name], sf)
    assert got_cols == want_cols
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["rank", "id", "price", "label"] and df.count() == 20
    assert {"top_orders_ranked"} <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
