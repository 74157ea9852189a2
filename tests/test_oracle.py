"""Every registered query against its SQL twin."""

import pytest

from runweave.plans import ORACLE, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        found = [d for d in differences(df, ORACLE[name], con) if d != "SQL gives no rows"]
        assert not found, "\n".join(found)
    else:
        assert df.count() > 0


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE)
