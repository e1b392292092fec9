import pytest
from compare import SF, duck_rows, spark_rows

import __spark_entry__
from quarry import queries as own


@pytest.mark.parametrize("name", sorted(own.SQL))
def test_query_equals_its_sql(spark, name):
    assert spark_rows(own.Q[name](spark, SF)) == duck_rows(own.SQL[name])


def test_every_query_has_sql():
    assert set(own.Q) == set(own.SQL)


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["l_table", "l_column"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
