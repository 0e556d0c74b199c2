"""Drill-down over a hierarchy: every level and the grand total from one pass over the facts.

The facts are first summed at the lowest level (partial sums before the shuffle, so a parent with a third of all rows costs
no more than any other); GROUPING SETS then expand those few rows, not the facts. A NULL id is a member of its own:
``level`` says which level a row belongs to, not which ids are NULL.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drill_down(facts: DataFrame, path: Sequence[str], sums: Mapping[str, str], level: str = "level",
               parents: Sequence[str] = ()) -> DataFrame:
    """Rows for the total (level 0), each ``path[0]`` (level 1), each (``path[0]``, ``path[1]``) (level 2), and so on.

    ``sums`` maps output name -> summed column; for those in ``parents`` ``parent_<name>`` is the parent row's sum (NULL for the total)."""
    path = list(path)
    lowest = facts.groupBy(*path).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    kinds = {f.name: f.dataType for f in lowest.schema.fields}
    out = lowest.rollup(*path).agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in sums], F.grouping_id().alias("_gid"))
    # grouping_id of a rollup: 2 ** (levels left out) - 1
    depth = F.lit(len(path)) - F.size(F.filter(F.array(*[F.lit(1 << i) for i in range(len(path))]), lambda bit: F.col("_gid").bitwiseAND(bit) > 0))
    out = out.withColumn(level, depth.cast("int")).drop("_gid")
    if not parents:
        return out
    # a parent's sum is the sum of its children: one window per level over rows of the level, by the parent's ids
    from pyspark.sql import Window
    above = [F.when(F.col(level) > i + 1, F.col(p)) for i, p in enumerate(path)]
    w = Window.partitionBy(level, *above)
    return out.withColumns({f"parent_{n}": F.when(F.col(level) > 0, F.sum(n).over(w).cast(kinds[n])) for n in parents})


def member(level: str, depth: int, column: str) -> Column:
    """``column`` on rows of ``depth`` or below, NULL above it."""
    return F.when(F.col(level) >= depth, F.col(column))
