"""Names and literals for expressions written as SQL text.

Wide expressions (pivots, rule chains, scores) are built as text: one call to the JVM per column instead of one per
operator keeps the driver quick when there are hundreds of them.
"""

from __future__ import annotations

from collections.abc import Iterable


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, int):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def listing(values: Iterable[object]) -> str:
    return ", ".join(literal(v) for v in values)


def mapping(pairs: Iterable[tuple[object, object]]) -> str:
    return "map(" + ", ".join(f"{literal(k)}, {literal(v)}" for k, v in pairs) + ")"
