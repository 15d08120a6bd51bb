"""The queries of this subpackage that SQL can express, against DuckDB."""

import pytest
from seriesmill.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import both


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_oracle(spark, name):
    mine, theirs = both(spark, QUERIES[name], ORACLE_SQL[name])
    assert mine == theirs and mine
