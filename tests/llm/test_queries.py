"""What the driver contract registers of this subpackage."""

import re

import __spark_entry__ as entry_module
from tarmac.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    registered = entry_module.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)


def test_sql_is_registered_where_there_is_some():
    assert set(ORACLE_SQL) == {"op1_quality_rules", "op8_mixing", "op9_line_dedup", "op11_lexical_search", "op13_filter_audit"}
    assert set(ORACLE_SQL) <= set(entry_module.oracle_sql())
    assert "pipeline" not in entry_module.oracle_sql()
