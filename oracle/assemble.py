"""Puts the common table expressions a statement mentions in front of it."""

from __future__ import annotations

import re

from oracle import marts, raw, staging

TABLES = {**raw.TABLES, **staging.TABLES, **marts.TABLES}


def _disputed() -> dict[str, str]:
    tables = {}
    for name, text in TABLES.items():
        if name not in raw.DISPUTED:
            tables.setdefault(name, text)
            continue
        tables[f"undisputed_{name}"] = text
        if name == "raw_cost_library":
            tables["changed_library"] = TABLES["changed_library"].replace(
                name, f"undisputed_{name}"
            )
        tables[name] = raw.DISPUTED[name]
    return tables


DISPUTED_TABLES = _disputed()


def assemble(text: str, tables: dict[str, str] = TABLES) -> str:
    needed: set[str] = set()

    def visit(statement: str) -> None:
        for name in tables:
            if name not in needed and re.search(rf"\b{name}\b", statement):
                needed.add(name)
                visit(tables[name])

    visit(text)
    # ``tables`` lists every table after the ones it reads.
    parts = [f"{name} AS ({tables[name].strip()})" for name in tables if name in needed]
    return f"WITH {', '.join(parts)} {text.strip()}" if parts else text.strip()
