"""Independent DuckDB statements for every query.

They state the results with other means than the Spark code: plain fan-out
joins instead of weights, ranked distinct terms instead of bit counts, ordered
windows over attempts instead of cells.  Equal attempts of one term are ordered
by the attempt id on both sides.
"""

from __future__ import annotations

import re

from gradewell.oracle import kpis, layers, statements

TABLES: dict[str, str] = {**layers.TABLES, **kpis.TABLES}


def with_tables(statement: str, given: tuple[str, ...] = ()) -> str:
    """Prefix a statement with the table definitions it needs, except those ``given``."""
    needed: set[str] = set(given)
    queue = [statement]
    while queue:
        text = queue.pop()
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                queue.append(TABLES[name])
    needed -= set(given)
    if not needed:
        return statement
    body = ",\n".join(f"{name} AS MATERIALIZED (\n{TABLES[name].strip()}\n)" for name in TABLES if name in needed)
    return f"WITH {body}\n{statement.strip()}"


def oracle_sql() -> dict[str, str]:
    return {key: with_tables(text) for key, text in statements.STATEMENTS.items()}
