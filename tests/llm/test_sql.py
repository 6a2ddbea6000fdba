"""Every query of this subpackage that has SQL against DuckDB on sf0.001."""

import pytest
from test_oracle import check_oracle, con  # noqa: F401

from spindex.llm import catalog


@pytest.mark.parametrize("key", sorted(catalog.SQL))
def test_matches_sql(spark, con, key):  # noqa: F811
    check_oracle(spark, con, key)
