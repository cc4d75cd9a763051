"""Independent DuckDB SQL for the registered queries, written from the operator descriptions."""

from __future__ import annotations

from fixtures import duckdb_sql
from oracles import jobs, reporting, resources, statements

ALL: dict[str, str] = {**jobs.ORACLES, **resources.ORACLES, **statements.ORACLES, **reporting.ORACLES}


def oracle_sql() -> dict[str, str]:
    return {name: duckdb_sql(text) for name, text in ALL.items()}
