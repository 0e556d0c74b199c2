"""NULL-safe string building (SQL ``CONCAT`` treats NULL as '', Spark's returns NULL)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def concat_safe(*parts) -> Column:
    """Concatenate columns/literals, reading NULL as the empty string. Literals go in as ``F.lit``."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


def left(col, n: int) -> Column:
    """``LEFT(s, n)``."""
    return F.substring(_c(col), 1, n)
