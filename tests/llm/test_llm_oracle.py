"""Every query of this part that SQL can express, against DuckDB on the smallest tables."""

import pytest
from compare import connect, differences

from shelfwise.llm.queries import ORACLE, QUERIES
from shelfwise.llm.staging import forget


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), connect(small), ORACLE[name]) == []
    forget(spark)


def test_what_sql_cannot_express():
    rest = {name.split("_")[0] for name in set(QUERIES) - set(ORACLE)}
    assert rest == {"op1", "op2", "op8", "op9", "op10", "op13"}
