"""Every query against its SQL form."""

import __spark_entry__ as contract
import pytest
from compare import database, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return database(FOLDER)


OWN = [name for name, query in contract.queries().items() if query.__module__.startswith("tillstream.plans.")]


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, tables, name):
    mine = contract.queries()[name](spark, FOLDER).toPandas()
    other = tables.execute(contract.oracle_sql()[name]).df()
    assert differences(mine, other) is None
    assert len(mine) > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["mid", "uid", "ch", "vc", "dt", "hr", "mi", "ts"]
    assert result.count() == 397
