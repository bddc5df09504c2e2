"""Python texts as SQL literals."""

from __future__ import annotations


def sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
