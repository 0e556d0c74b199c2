"""Current-vs-previous period comparison in a single pass.

Instead of aggregating the fact twice and joining (as the SQL does), every metric is summed
twice under complementary date predicates in one grouped aggregation: one scan, one
shuffle, and the union of both periods is filtered before the aggregation (pushed to the scan
when the date is a stored column).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_window


def period_compare(df: DataFrame, key: str | Sequence[str], as_of, metrics: Sequence[str], days: int = 30,
                   date_col: str = "date") -> DataFrame:
    """Closed current period [as_of - days, as_of) against the previous [as_of - 2*days, as_of - days).

    Emits ``cur_<m>`` / ``prev_<m>`` sums, the current period's first/last date and distinct day
    count, and keeps only keys active in the current period (the SQL's inner side); previous
    sums are NULL when the key had no previous rows (the SQL's LEFT JOIN)."""
    keys = [key] if isinstance(key, str) else list(key)
    cur = in_window(date_col, as_of, days, 0)
    prev = in_window(date_col, as_of, 2 * days, days)
    d = F.col(date_col)
    aggs = []
    for m in metrics:
        aggs += [F.sum(F.when(cur, F.col(m))).alias(f"cur_{m}"), F.sum(F.when(prev, F.col(m))).alias(f"prev_{m}")]
    aggs += [F.min(F.when(cur, d)).alias("period_start"), F.max(F.when(cur, d)).alias("period_end"),
             F.count_distinct(F.when(cur, d)).alias("days_in_period"), F.count(F.when(cur, F.lit(1))).alias("_n_cur")]
    return df.filter(cur | prev).groupBy(*keys).agg(*aggs).filter(F.col("_n_cur") > 0).drop("_n_cur")
