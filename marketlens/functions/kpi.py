"""Guarded ratio KPIs and conditional aggregates.

Every KPI is ``CASE WHEN den > 0 THEN CAST(num * k / den AS DECIMAL(p,s)) ELSE 0 END`` with the
whole CASE cast once (a bare ``ELSE 0`` widens the decimal type).  Arithmetic stays in
decimal: scale factors are decimal literals, never Python floats.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value, precision: int | None = None, scale: int | None = None) -> Column:
    """Decimal literal (``100.0`` in SQL is a decimal, ``F.lit(100.0)`` would be a double)."""
    lit = F.lit(Decimal(str(value)))
    if precision is not None:
        lit = lit.cast(f"decimal({precision},{scale or 0})")
    return lit


def ratio(num, den, factor=None, cast=(10, 4), default=0, guard=None, operand: str | None = "decimal(24,6)") -> Column:
    """``num * factor / den`` when ``guard`` (default ``den > 0``) holds, else ``default``.

    ``factor`` is applied to the numerator the way the SQL writes ``x * 100.0 / y``;
    ``default=None`` yields NULL instead of 0.  Operands are first brought to ``operand``
    (decimal(24,6) holds every count and amount exactly): Spark sizes a decimal quotient
    from the operand precisions, and two wide sums (e.g. decimal(28,2) / decimal(28,6))
    would leave only 6 fractional digits, which the final cast then rounds a second time.
    """
    n, d = _col(num), _col(den)
    cond = guard if guard is not None else (d > 0)
    if operand:
        n, d = n.cast(operand), d.cast(operand)
    if factor is not None:
        n = n * dec(factor)
    typ = f"decimal({cast[0]},{cast[1]})"
    other = F.lit(None).cast(typ) if default is None else F.lit(default).cast(typ)
    return F.when(cond, (n / d).cast(typ)).otherwise(other)


def share_pct(num, den, cast=(10, 2)) -> Column:
    """``num * 100.0 / NULLIF(den, 0)``: NULL when the total is 0."""
    return ratio(num, den, "100.0", cast=cast, default=None, guard=_col(den) != 0)


def safe_div(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (``x / NULLIF(y, 0)``)."""
    d = _col(den)
    return F.when(d != 0, _col(num) / d)


def change_pct(cur, prev, cast=(10, 2)) -> Column:
    """``(cur - prev) * 100.0 / prev`` when ``prev > 0`` else NULL."""
    return ratio(_col(cur) - _col(prev), prev, factor="100.0", cast=cast, default=None, guard=_col(prev) > 0)


def sum_if(cond: Column, x) -> Column:
    """``SUM(CASE WHEN cond THEN x ELSE 0 END)``."""
    return F.sum(F.when(cond, _col(x)).otherwise(F.lit(0)))


def avg_if(cond: Column, x) -> Column:
    """``AVG(CASE WHEN cond THEN x END)``."""
    return F.avg(F.when(cond, _col(x)))


def count_if(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``; NULL conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))


def count_distinct_if(id_col, cond: Column, id_is_unique: bool = False) -> Column:
    """``COUNT(DISTINCT CASE WHEN cond THEN id END)``.

    When ``id`` is the primary key of the aggregated input the distinct is redundant and a
    plain conditional count avoids the Expand that several distinct aggregates would cost.
    """
    if id_is_unique:
        return F.count(F.when(cond, _col(id_col)))
    return F.count_distinct(F.when(cond, _col(id_col)))


def min_if(cond: Column, x) -> Column:
    return F.min(F.when(cond, _col(x)))


def max_if(cond: Column, x) -> Column:
    return F.max(F.when(cond, _col(x)))
