"""Per-entity window features: row-frame moving averages, LAG comparisons, running totals.

All features that share a (partition, order) spec are added in one ``select`` so Catalyst
plans one Exchange + one Sort + one Window operator for all of them.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..functions.kpi import change_pct


def _spec(partition: Sequence[str | Column], order: Sequence[str | Column]):
    return Window.partitionBy(*partition).orderBy(*order)


def moving_avg(partition, order, col: str, rows: int) -> Column:
    """``AVG(col) OVER (PARTITION BY .. ORDER BY .. ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW)``.
    Rows, not days: gaps in the dates widen the covered span, as in the source SQL."""
    return F.avg(col).over(_spec(partition, order).rowsBetween(-(rows - 1), 0))


def lag_of(partition, order, col: str, n: int) -> Column:
    return F.lag(col, n).over(_spec(partition, order))


def lag_change_pct(partition, order, col: str, n: int, cast=(10, 2)) -> Column:
    """``(x - LAG(x, n)) * 100 / LAG(x, n)`` when the lagged value is > 0, else NULL."""
    prev = lag_of(partition, order, col, n)
    return change_pct(F.col(col), prev, cast=cast)


def running_total(partition, order, col: str, frame: str = "range") -> Column:
    """Cumulative SUM. ``range`` = SQL default frame (peers with equal order keys included),
    ``rows`` = ``ROWS UNBOUNDED PRECEDING``."""
    w = _spec(partition, order)
    if frame == "rows":
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        w = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(col).over(w)


def rank_within(partition, order, dense: bool = True) -> Column:
    """DENSE_RANK / RANK inside a partition (e.g. ad group within campaign)."""
    fn = F.dense_rank() if dense else F.rank()
    return fn.over(_spec(partition, order))

