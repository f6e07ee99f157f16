"""Every registered query against its SQL on the given tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, spark_rows, spark_types, sql_rows, sql_types
from viewtide.oracles import ORACLES
from viewtide.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    frame, sql = entry.queries()[name](spark, sf_dir), entry.oracle_sql()[name]
    assert spark_types(frame) == sql_types(con, sql)
    assert spark_rows(frame) == sql_rows(con, sql)


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["fact_id", "product_id"]
