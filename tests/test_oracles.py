import pytest

import __spark_entry__ as entry_module
from verify import actual, expected

SF = "/root/testdata/sf0.001"

QUERIES = {n: q for n, q in entry_module.queries().items() if n in entry_module.QUERIES}
ORACLES = entry_module.ORACLES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    columns, rows = actual(QUERIES[name](spark, SF))
    want_columns, want = expected(SF, ORACLES[name])
    assert columns == want_columns
    assert sum(rows.values()) > 0
    assert rows == want


def test_flagship(spark):
    out = entry_module.entry(spark)
    assert out.count() == 3
    assert out.schema == entry_module.entry(spark).schema
