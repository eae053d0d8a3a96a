"""Every registered query with a SQL twin gives the twin's rows."""

import pytest

import __spark_entry__ as entry
from compare import difference, duck

CON = duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_twin(spark, folder, name):
    assert difference(spark, CON, folder, name, entry) == ""


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["Id", "Category", "predicted"] and out.count() == 50
