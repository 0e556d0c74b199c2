"""Row positions, running totals, moving averages and LAG over a whole result, without a one-task window.

The order is cut into ranges (``ordered``). Each range counts and sums its own rows with an ordinary window; what came
before it is one small row a range, prefix-summed over at most ``k + 1`` rows and broadcast back. That gives every row
its exact position. Frames that look back a fixed number of rows then work on chunks of consecutive positions, to
which the last rows of the chunk before are added as a halo.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import ROW_HASH, OrderSpec, range_count, sort_columns, spread, with_range_numbers

#: Rows of one chunk for frames that look back (more if a frame is longer).
CHUNK_ROWS = 100_000


def running_totals(df: DataFrame, order: OrderSpec, sums: Mapping[str, str], position: str = "position",
                   buckets: int | None = None) -> DataFrame:
    """``df`` with ``ROW_NUMBER()`` as ``position`` and, per entry name -> column of ``sums``,
    ``SUM(column) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING)``.

    Rows that ``order`` leaves equal follow each other by the hash of the whole row."""
    base = spread(df)
    ranged = with_range_numbers(base, [order], range_count(df, buckets), ["_b"])
    inside = Window.partitionBy("_b").orderBy(*sort_columns(order), ROW_HASH)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.select("*", F.row_number().over(inside).cast("long").alias("_i"), *[F.sum(c).over(so_far).alias(f"_s{j}") for j, c in enumerate(sums.values())])
    # the hash keeps the narrow sums on the exchange that the rows come from
    parts = ranged.groupBy("_b").agg(F.count(ROW_HASH).alias("_n"), F.max(ROW_HASH), *[F.sum(c).alias(f"_t{j}") for j, c in enumerate(sums.values())])
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # k + 1 rows
    carried = parts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                           *[F.sum(f"_t{j}").over(before).alias(f"_c{j}") for j in range(len(sums))])
    rows = rows.join(F.broadcast(carried), "_b")

    def total(j: int, name: str):
        local, carry, kind = F.col(f"_s{j}"), F.col(f"_c{j}"), rows.schema[f"_s{j}"].dataType
        both = F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(local + carry)
        return both.cast(kind).alias(name)

    return rows.select(*df.columns, (F.col("_n0") + F.col("_i")).alias(position), *[total(j, n) for j, n in enumerate(sums)])


def look_back(df: DataFrame, position: str, averages: Mapping[str, tuple[str, int]], lags: Mapping[str, tuple[str, int]],
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df``, whose rows are numbered 1, 2, ... in ``position``, with moving averages name -> (column, rows) over
    ``ROWS rows - 1 PRECEDING`` and LAGs name -> (column, rows)."""
    halo = max([n - 1 for _, n in averages.values()] + [n for _, n in lags.values()], default=0)
    size = max(chunk_rows, halo, 1)
    at = F.col(position) - 1
    chunk, place = F.floor(at / size), at % size
    copies = F.when(place >= size - halo, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    rows = df.select("*", F.explode(copies).alias("_c"))
    w = Window.partitionBy("_c").orderBy(position)
    out = rows.select("*", *[F.avg(c).over(w.rowsBetween(1 - n, 0)).alias(name) for name, (c, n) in averages.items()],
                      *[F.lag(c, n).over(w).alias(name) for name, (c, n) in lags.items()])
    return out.where(F.col("_c") == chunk).drop("_c")
