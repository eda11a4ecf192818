"""Put the needed common table expressions in front of a query."""

from __future__ import annotations

import re

from .tables import TABLES

_WORD = re.compile(r"[a-z_0-9]+")
_NEEDS = {name: [t for t in TABLES if t != name and t in set(_WORD.findall(sql))] for name, sql in TABLES.items()}


def with_tables(sql: str) -> str:
    needed: set[str] = set()
    todo = [t for t in TABLES if t in set(_WORD.findall(sql))]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _NEEDS[name]
    head = ",\n".join(f"{name} AS ({TABLES[name]})" for name in TABLES if name in needed)
    if not head:
        return sql
    if sql.startswith("WITH "):
        return f"WITH {head},\n{sql.removeprefix('WITH ')}"
    return f"WITH {head}\n{sql}"
