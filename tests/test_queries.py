"""Every registered query of the library equals its SQL, or at least gives rows, on the smallest tables."""

import pytest

from gridframe import plans
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    df = plans.QUERIES[name](spark, SF)
    if name in plans.SQL:
        assert_same(df, SF, plans.SQL[name])
    else:
        assert df.count() >= 1


@pytest.mark.parametrize("name", ["snapshot_checks", "snapshot_validation", "target_reconcile", "source_reconcile", "fold_checks", "split_rules"])
def test_query_on_larger_tables(spark, name):
    """Damage and exceptions that depend on which ids a table holds, such as an id 0, differ between sizes."""
    assert_same(plans.QUERIES[name](spark, LARGER), LARGER, plans.SQL[name])


def test_registry_has_sql_for_registered_names_only():
    assert set(plans.SQL) <= set(plans.QUERIES)
