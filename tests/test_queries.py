"""Every registered query of the floor-plan engine that SQL can express gives what its SQL gives."""

import pytest

from planweave import queries
from tests.compare import DATA, duck, same

@pytest.fixture(scope="module")
def db():
    return duck()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, db, name):
    same(queries.QUERIES[name](spark, DATA), db, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
