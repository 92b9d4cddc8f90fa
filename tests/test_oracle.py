"""Every registered query against its SQL on the smallest trial tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as driver
from retailmart.trial.oracle import ORACLE
from retailmart.trial.queries import QUERIES

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "double": "DOUBLE",
}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, SMALL)
    found = database.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in found.description}
    assert {f.name: TYPES.get(t := f.dataType.simpleString(), t.upper()) for f in df.schema} == types
    order = sorted(types)
    places = [list(types).index(c) for c in order]
    expected = sorted((repr(tuple(r[p] for p in places)) for r in found.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*order).collect()) == expected
    assert expected


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["product_name", "category_name"]
    assert not df.isEmpty()
