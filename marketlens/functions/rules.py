"""First-match rule ladders (searched CASE)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def rules(ladder: Sequence[tuple[Column, object]], default=None) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END``; first match wins."""
    if not ladder:
        return F.lit(default)
    cond, value = ladder[0]
    expr = F.when(cond, value if isinstance(value, Column) else F.lit(value))
    for cond, value in ladder[1:]:
        expr = expr.when(cond, value if isinstance(value, Column) else F.lit(value))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))
