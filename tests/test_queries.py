"""Every query of the library against its SQL, or at least its shape, over the smallest tables."""

from __future__ import annotations

import pytest

from loremill.plans import registry
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
#: Joins of small inputs that can have no row at this size.
MAY_BE_EMPTY = {"j4_orphan_raw", "l6_active_runs", "j5_orphan_entities", "l2_tombstones", "f10_orphan_projects"}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    said = compare(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)
    assert not said or (said == "no rows" and name in MAY_BE_EMPTY), said


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
