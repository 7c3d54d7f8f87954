"""SQL for lists of values."""

from __future__ import annotations


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def members(values: list) -> str:
    return "(" + ", ".join(_literal(value) for value in values) + ")"
