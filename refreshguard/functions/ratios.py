"""Percentages and changes as SQL expressions, safe on zero denominators.

Expressions are text: a family has well over a hundred of them, and one
``selectExpr`` is one call into the JVM where column objects are thousands.
"""

from __future__ import annotations


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def percent(part: str, whole: str) -> str:
    """``part / whole * 100`` as double; 0 when there is nothing to divide by."""
    return f"coalesce(try_divide(double({part}), double({whole})) * 100, 0D)"


def change_percent(current: str, previous: str) -> str:
    """Change against ``previous`` in percent; NULL unless previous is above 0."""
    return (f"if({previous} > 0, try_divide(double({current} - {previous}), "
            f"double({previous})) * 100, null)")


def within(change: str, threshold: float) -> str:
    """True up to and including the threshold, which is a fraction."""
    return f"abs(({change}) / 100) <= {threshold}D"


def share_text(key: str, value: str) -> str:
    """``key: 12.3%``"""
    return f"concat(coalesce(string({key}), 'None'), ': ', format_string('%.1f%%', {value}))"


def share_list(top: str, total: str) -> str:
    """The shares of an array of ``(key, n, ...)`` as one text."""
    item = share_text("x.key", percent("x.n", total))
    return f"array_join(transform({top}, x -> {item}), ', ')"
