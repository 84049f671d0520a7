from __future__ import annotations

import pytest

from gleaner import registry
from tests.compare import duck, same

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = registry.QUERIES[name](spark, FOLDER)
    if name in registry.ORACLE_SQL:
        equal, what = same(df, registry.ORACLE_SQL[name], con)
        assert equal, what
    else:
        assert df.count() > 0
