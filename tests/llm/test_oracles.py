"""Registered operator queries against their SQL twins."""

import pytest

from shelfcount.llm.queries import ORACLES, QUERIES
from shelfcount_checks.compare import connect, difference

from ..conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None
