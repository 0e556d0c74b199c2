"""Measures under a filter context, many in one pass.

A measure aggregates the rows that its own filters leave. Its filters are set per column, and a filter on a column replaces
whatever a visual's axis says about that column: on a row of the axis the measure then sees the other axis columns only.
``evaluate`` turns this into one aggregation: the measures that replace the same axis columns share a grouping set, all
grouping sets are computed in one pass over the rows, and a window over the (already aggregated) result hands each
axis row the values of the sets that keep fewer columns.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Everything:
    """A filter that only removes what the axis (or an outer measure) says about its column."""


ALL = Everything()


@dataclass(frozen=True)
class Measure:
    """``aggregate(rows)`` gets a function that keeps a column's value where the filters hold (NULL elsewhere).

    ``filters``: column -> predicate on it, or ``ALL``."""
    aggregate: Callable[[Callable[[Column], Column]], Column]
    filters: Mapping[str, Callable[[Column], Column] | Everything] = field(default_factory=dict)

    def within(self, filters: Mapping[str, Callable[[Column], Column] | Everything]) -> "Measure":
        """The measure evaluated inside another CALCULATE: its own filter on a column wins over the outer one."""
        return Measure(self.aggregate, {**filters, **self.filters})

    def column(self) -> Column:
        held = None
        for name, predicate in self.filters.items():
            if not isinstance(predicate, Everything):
                held = predicate(F.col(name)) if held is None else held & predicate(F.col(name))
        return self.aggregate((lambda c: c) if held is None else lambda c: F.when(held, c))


def rows_of(**filters) -> Measure:
    """COUNTROWS under ``filters``."""
    return Measure(lambda kept: F.count(kept(F.lit(1))), filters)


def sum_of(column: str, **filters) -> Measure:
    return Measure(lambda kept: F.sum(kept(F.col(column))), filters)


def average_of(column: str, **filters) -> Measure:
    return Measure(lambda kept: F.avg(kept(F.col(column))), filters)


def is_(value) -> Callable[[Column], Column]:
    return lambda c: c == F.lit(value)


def evaluate(df: DataFrame, measures: Mapping[str, Measure], by: Sequence[str] = (),
             derived: Mapping[str, Callable[[], Column]] | None = None) -> DataFrame:
    """One row per combination of the axis columns ``by`` that the rows hold (one row in all without ``by``).

    ``derived`` adds columns computed from the measures, each in the context of its row; names that start with ``_`` leave the result."""
    by = list(by)
    kept = {name: tuple(b for b in by if b not in m.filters) for name, m in measures.items()}
    sets = list(dict.fromkeys([tuple(by), *kept.values()]))
    columns = [m.column().alias(name) for name, m in measures.items()]
    if len(sets) == 1:
        out = df.groupBy(*by).agg(*columns) if by else df.agg(*columns)
    else:
        axis = [F.col(b) for b in by]
        grouped = df.groupingSets([[F.col(b) for b in s] for s in sets], *axis).agg(*columns, F.grouping_id().alias("_set"))
        # grouping_id has a bit per axis column, the first one highest, set where the column is left out
        number = {s: sum(1 << (len(by) - 1 - i) for i, b in enumerate(by) if b not in s) for s in sets}

        def value(name: str) -> Column:
            rest = kept[name]
            if rest == tuple(by):
                return F.col(name)
            # each combination of the kept columns has one row of that set
            return F.max(F.when(F.col("_set") == number[rest], F.col(name))).over(Window.partitionBy(*rest) if rest else Window.partitionBy(F.lit(0)))

        out = grouped.select(*by, "_set", *[value(n).alias(n) for n in measures]).where(F.col("_set") == 0).drop("_set")
    if derived:
        out = out.select("*", *[fn().alias(n) for n, fn in derived.items()])
    return out.drop(*[c for c in out.columns if c.startswith("_")])
