"""Every query with an SQL counterpart gives the same rows on the small tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.check import connect, difference

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_counterpart_has_a_query():
    assert set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert difference(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry_has_a_row_per_cell(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and {r["qos_state"] for r in rows} <= {"bon", "dégradé", "critique"}
