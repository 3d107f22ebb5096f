"""DuckDB SQL that recomputes every registered query for the correctness gate."""


def oracle_sql() -> dict[str, str]:
    from tarmac.oracle.metrics_sql import BUSINESS_SQL
    from tarmac.oracle.relational_sql import RELATIONAL_SQL

    return {**BUSINESS_SQL, **RELATIONAL_SQL}
