"""One full order over a whole result, cut into ranges that tasks can work on alone.

``spread`` puts a frame behind one exchange by the hash of its whole rows. Whatever is derived from
all of its columns afterwards (split points, ordered rows, the rows themselves) reads that exchange again, so what
stands below it is computed once. ``with_range_numbers`` cuts orders into ``k`` ranges at split points taken from a hash sample
of the rows, of a size that depends on ``k`` only; it reaches the plan as a scalar subquery. Ties of the order are cut
by the row's hash, so a value that most rows share spans many ranges. The sample decides where ranges end, never what
is computed in them.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OrderSpec = Sequence[tuple[str, bool]]  # (column, ascending)

#: Column with the hash of the whole row, sampled rows per split point, and ranges at most (each row's search sees all split points).
ROW_HASH, OVERSAMPLE, MOST_RANGES = "_h", 16, 1000


def sort_columns(order: OrderSpec, of=F.col) -> list[Column]:
    # SQL sorts NULL lowest: first in ASC, last in DESC (Spark's defaults agree)
    return [of(c).asc_nulls_first() if asc else of(c).desc_nulls_last() for c, asc in order]


def range_count(df: DataFrame, buckets: int | None) -> int:
    return max(1, buckets or min(MOST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt by the hash of its whole rows, which becomes a column."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartition(whole).withColumn(ROW_HASH, whole)


def _not_before(left: Column, right, order: OrderSpec) -> Column:
    """Whether the row ``right`` sorts at or after ``left`` in ``order`` and then the row hash."""
    out = left[ROW_HASH] <= right(ROW_HASH)
    for c, asc in reversed(list(order)):
        s, v = left[c], right(c)
        before = (s < v) if asc else (s > v)
        null_first = (s.isNull() & v.isNotNull()) if asc else (s.isNotNull() & v.isNull())
        out = F.coalesce(before, F.lit(False)) | null_first | (s.eqNullSafe(v) & out)
    return out


def _split_points(base: DataFrame, orders: Sequence[OrderSpec], k: int) -> Column:
    """One struct, with the ascending split rows of every order, as a scalar subquery."""
    used = list(dict.fromkeys(c for order in orders for c, _ in order))
    row = F.struct(*used, ROW_HASH)
    # the rows of smallest second hash (the first one cuts ties): bounded by configuration, not by data
    sample = base.select(*used, ROW_HASH).orderBy(F.xxhash64(ROW_HASH), *used).limit(k * OVERSAMPLE).agg(F.collect_list(row).alias("s"))

    def points(order: OrderSpec) -> Column:
        ranked = F.array_sort("s", lambda a, b: F.when(_not_before(a, lambda c: b[c], order), -1).otherwise(1))
        return F.filter(ranked, lambda x, i: i % OVERSAMPLE == OVERSAMPLE - 1)

    return sample.select(F.struct(*[points(o).alias(f"s{j}") for j, o in enumerate(orders)]).alias("s")).scalar()


def with_range_numbers(base: DataFrame, orders: Sequence[OrderSpec], k: int, names: Sequence[str]) -> DataFrame:
    """``base`` (made by ``spread``) with, for each order, the number of the range that the row falls in."""
    splits = base.withColumn("_splits", _split_points(base, orders, k))  # a subquery may not stand inside the search itself

    def number(j: int, order: OrderSpec) -> Column:
        points = F.col("_splits").getField(f"s{j}")
        start = F.struct(F.lit(0).alias("lo"), F.size(points).alias("hi"))

        def halve(a: Column, _: Column) -> Column:
            mid = F.shiftright(a["lo"] + a["hi"], 1)
            up = _not_before(F.get(points, mid), F.col, order)
            return F.when(a["lo"] >= a["hi"], a).otherwise(F.struct(
                F.when(up, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(up, a["hi"]).otherwise(mid).alias("hi")))

        return F.aggregate(F.sequence(F.lit(1), F.lit(k.bit_length() + 1)), start, halve, lambda a: a["lo"])

    return splits.select(*base.columns, *[number(j, o).alias(n) for j, (o, n) in enumerate(zip(orders, names))])


def same(left: Column, right: Column) -> Column:
    """NULL-safe equality that stays a condition on joined rows and is not taken as a join key."""
    return F.coalesce(left == right, left.isNull() & right.isNull())
