import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
SQLS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_check_has_a_query():
    assert set(SQLS) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    query = entry.queries()[name]
    if name in SQLS:
        assert compare(spark, con, name, query, SQLS[name], SF) is None
    else:
        assert query(spark, SF).count() > 0
