"""Shares of a parent total and comparisons with a parent/global average.

``x * 100 / SUM(x) OVER (PARTITION BY parent)`` is computed as aggregate-then-join: the
parent totals are a partial/final hash aggregate (map-side combine, skew-safe) joined back
on the parent key.  With no parent the totals are one distributed aggregate returned as a
scalar subquery (a single struct value substituted into the plan) - never a
single-partition window and never a cross join.

Rows and totals come from one exchange (``ordered.spread``): both use the hash of the whole row, so that neither side's
columns are pruned, the two plans below the exchange stay the same, and Spark runs them, scans included, once.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import ROW_HASH, spread


def with_group_aggs(df: DataFrame, partition: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Attach ``aggs`` evaluated per ``partition`` (``agg(x) OVER (PARTITION BY partition)``)."""
    partition = list(partition)
    base = spread(df)
    least = F.lit(-2**63)
    if not partition:
        totals = base.agg(F.struct(*[c.alias(n) for n, c in aggs.items()], F.max(ROW_HASH).alias("_seen")).alias("_t")).scalar()
        return base.select(*df.columns, *[F.when(F.col(ROW_HASH) >= least, totals.getField(n)).alias(n) for n in aggs])
    tot = base.groupBy(*[F.col(p).alias(f"__p_{p}") for p in partition]).agg(*[c.alias(n) for n, c in aggs.items()], F.max(ROW_HASH).alias("_seen"))
    cond = None
    for p in partition:
        term = F.col(p).eqNullSafe(F.col(f"__p_{p}"))
        cond = term if cond is None else cond & term
    used = (F.col(ROW_HASH) >= least) & (F.col("_seen") >= least)  # always true
    return base.join(tot, cond, "left").select(*df.columns, *[F.when(used, F.col(n)).alias(n) for n in aggs])
