"""Literals and casts for generated SQL expressions."""

from __future__ import annotations

import math


def sql_double(v: float) -> str:
    v = float(v)
    return f"{v!r}D" if math.isfinite(v) else f"double('{v}')"


def number(column: str) -> str:
    """SQL text of a column as a double."""
    return f"CAST(`{column}` AS DOUBLE)"


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return sql_double(v) if isinstance(v, float) else str(v)
