"""Independent DuckDB SQL for each registered query (the correctness oracle)."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from oracle import accrual_sql, attainment_sql, operators_sql
    from oracle.fixtures_sql import with_tables
    out = {}
    for mod in (attainment_sql, accrual_sql, operators_sql):
        for name, body in mod.SQL.items():
            out[name] = with_tables(body)
    return out
