"""Latest version of each entity in an append-on-change history table."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order_col: str = "_fivetran_synced",
                  where: Column | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_col DESC) = 1``.

    ``where`` filters *before* ranking (e.g. the lenient not-deleted rule of the social
    schema, which falls back to an earlier version).  Catalyst plans the ``rn = 1`` filter
    as a partial ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
    one row per key: a hot key costs no more shuffle than a cold one.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if where is not None:
        df = df.filter(where)
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def not_deleted(col: str = "_fivetran_deleted", lenient: bool = False) -> Column:
    """Soft-delete predicate: strict ``= 0`` drops NULL flags, lenient ``COALESCE(x, 0) = 0`` keeps them."""
    c = F.col(col)
    if lenient:
        return ~F.coalesce(c, F.lit(False))
    return c == F.lit(False)
