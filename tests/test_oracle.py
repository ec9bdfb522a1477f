"""Every checked query against its SQL on the sample tables."""

import oracle
import pytest

from musterroll.workload import CHECKS


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_sql(spark, sf_dir, con, name):
    check = CHECKS[name]
    assert oracle.compare(check.run(spark, sf_dir), check.sql, con) is None
