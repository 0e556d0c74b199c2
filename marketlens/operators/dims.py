"""Attach many-to-one dimensions to a fact (LEFT JOIN, facts without a match are kept)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Mapping[str, str],
           cols: Mapping[str, str] | Sequence[str], how: str = "left", ignore_case: bool = False,
           grows: bool = False) -> DataFrame:
    """Left join ``dim`` (unique on its key) and bring ``cols`` over, renamed ``{dim_col: out}``.

    ``ignore_case`` compares text keys without regard to case, as a case-insensitive collation
    does; the fact keeps its own spelling, and ``dim`` must be unique on the folded key.

    The dimension is projected to key + wanted columns before the join so only those reach
    the shuffle.  Broadcast vs. sort-merge is left to the planner's size estimate and AQE's
    runtime statistics (a size-checked choice), never forced.

    ``grows`` marks a dimension that grows with the account base, such as keyword criteria: it is
    always merged, for the estimate goes by file sizes and columns, does not count the rows that an
    explode adds, and a broadcast chosen by it is not undone at run time.
    """
    if isinstance(on, str):
        on = {on: on}
    elif not isinstance(on, Mapping):
        on = {k: k for k in on}
    if not isinstance(cols, Mapping):
        cols = {c: c for c in cols}
    # the dimension's key columns take the fact's key names, so the join is an equi-join USING
    # those names (one operation, no duplicate key columns to drop)
    if ignore_case:
        folded = {k: F.lower(F.col(k)) for k in on}
        right = dim.select(*[F.lower(F.col(dk)).alias(f"__k_{fk}") for fk, dk in on.items()],
                           *[F.col(c).alias(o) for c, o in cols.items()])
        right = right.hint("merge") if grows else right
        cond = None
        for k, key in folded.items():
            term = key == F.col(f"__k_{k}")
            cond = term if cond is None else cond & term
        return fact.join(right, cond, how).drop(*[f"__k_{k}" for k in on])
    right = dim.select(*[F.col(dk).alias(fk) for fk, dk in on.items()],
                       *[F.col(c).alias(o) for c, o in cols.items()])
    right = right.hint("merge") if grows else right
    return fact.join(right, list(on.keys()), how)
