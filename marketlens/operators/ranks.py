"""Ranks over a whole result, or within partitions of any size, that stay parallel and lazy.

``DENSE_RANK() OVER (ORDER BY x DESC)`` without PARTITION BY plans to a single task in Spark,
and a partition that holds a third of all rows is sorted by one task as well.  Here all ranks of
a call share one plan, for every input size:

1. the input stands behind one exchange (``ordered.spread``) that every later step reads again;
2. each row is written once per rank, narrow (its hash, the partition and order columns), with the number of the
   range it falls in: ranges cut (partition, order, row hash), so a hot partition and a value shared by
   most rows both span many of them;
3. one exchange by (rank, range), and ordinary windows inside each range;
4. each range hands on what its first and last partition need to go on from the range before: one small row a range,
   combined by windows over at most ``k + 1`` rows a rank and broadcast back;
5. the ranks of a row come together by its hash, and join the rows where the exchange of step 1 left them.

Results equal the single-task window exactly.  ``k`` is ``spark.sql.shuffle.partitions`` (1,000 at most) unless given.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import ROW_HASH, OrderSpec, range_count, same, sort_columns, spread, with_range_numbers


def _unpivoted(base: DataFrame, orders: Sequence[OrderSpec], k: int) -> DataFrame:
    """A narrow row per row of ``base`` and order: its number ``_j``, the range ``_b``, and the columns of all orders."""
    used = list(dict.fromkeys(c for order in orders for c, _ in order))
    names = [f"_b{j}" for j in range(len(orders))]
    numbered = with_range_numbers(base, orders, k, names)
    return numbered.select(ROW_HASH, *used, F.posexplode(F.array(*names)).alias("_j", "_b"))


def _in_ranges(rows: DataFrame, partition: Sequence[str], orders: Sequence[OrderSpec]) -> tuple[DataFrame, Column]:
    """Ranks inside (order, range, partition): ``_d`` dense, ``_r`` with gaps, ``_g`` the row's place; ``_i`` its place in the range.
    And the order's own values as one column."""
    slots = [(F.when(F.col("_j") == j, F.col(c)), asc) for j, order in enumerate(orders) for c, asc in order if c not in partition]
    by = [s.asc_nulls_first() if asc else s.desc_nulls_last() for s, asc in slots]
    group = Window.partitionBy("_j", "_b", *partition).orderBy(*by)
    whole = Window.partitionBy("_j", "_b").orderBy(*sort_columns([(p, True) for p in partition]), *by)
    ranked = rows.select("*", F.dense_rank().over(group).alias("_d"), F.rank().over(group).alias("_r"),
                         F.row_number().over(group).alias("_g"), F.row_number().over(whole).alias("_i"))
    return ranked, F.struct(*[s for s, _ in slots]) if slots else F.lit(0)


def _carried(ranked: DataFrame, partition: Sequence[str], values: Column) -> DataFrame:
    """What the first partition of each range goes on from: ``_od`` and ``_or`` (dense ranks and rows of it in earlier ranges), ``_os`` (the
    rank of its first value, if that began in one), and ``_n``, all rows of the order."""
    p = F.struct(*partition) if partition else F.lit(0)
    ends = ranked.groupBy("_j", "_b").agg(
        F.min_by(F.struct(p.alias("p"), values.alias("v")), "_i").alias("f"),
        F.max_by(F.struct(p.alias("p"), values.alias("v"), "_d", "_r", "_g"), "_i").alias("l"), F.count("*").alias("n"))
    order = Window.partitionBy("_j").orderBy("_b")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    col = F.col
    ends = ends.select("*", F.lag("l").over(order).alias("pl"))
    ends = ends.withColumn("go_on", F.coalesce(col("f.p") == col("pl.p"), F.lit(False)))
    ends = ends.withColumn("tie", col("go_on") & F.coalesce(col("f.v") == col("pl.v"), F.lit(False)))
    # the partition at the range's end is the one carried in only if the range holds no other
    ends = ends.withColumn("through", col("go_on") & (col("f.p") == col("l.p")))
    ends = ends.withColumn("seg", F.sum(F.when(col("through"), 0).otherwise(1)).over(so_far))
    segment = Window.partitionBy("_j", "seg").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.select("*", F.sum(col("l._d") - F.when(col("through") & col("tie"), 1).otherwise(0)).over(segment).alias("dense"),
                       F.sum(col("l._g")).over(segment).alias("rows"))
    ends = ends.select("*", F.lag("dense").over(order).alias("pd"), F.lag("rows").over(order).alias("pr"))
    began = F.when(col("through") & col("tie") & (col("l._r") == 1), None).otherwise(col("l._r") + F.when(col("through"), col("pr")).otherwise(0))
    ends = ends.withColumn("began", F.last(began, ignorenulls=True).over(so_far))
    return ends.select(
        "_j", "_b", F.when(col("go_on"), col("pd") - col("tie").cast("int")).otherwise(0).alias("_od"),
        F.when(col("go_on"), col("pr")).otherwise(0).alias("_or"), F.when(col("tie"), F.lag("began").over(order)).alias("_os"),
        F.sum("n").over(Window.partitionBy("_j")).alias("_n"))


def _with_ranks(df: DataFrame, partition: Sequence[str], ranks: Mapping[str, tuple[str, OrderSpec]], buckets: int | None) -> DataFrame:
    lead = [(p, True) for p in partition]
    orders = [[*lead, *[(c, asc) for c, asc in order if c not in partition]] for _, order in ranks.values()]
    base = spread(df)
    ranked, values = _in_ranges(_unpivoted(base, orders, range_count(df, buckets)), partition, orders)
    # k + 1 rows an order at most
    ranked = ranked.join(F.broadcast(_carried(ranked, partition, values)), ["_j", "_b"])
    first = F.col("_i") == F.col("_g")  # the row is in its range's first partition
    dense = F.col("_d") + F.when(first, F.col("_od")).otherwise(0)
    rank = F.when(first & (F.col("_r") == 1) & F.col("_os").isNotNull(), F.col("_os")).otherwise(F.col("_r") + F.when(first, F.col("_or")).otherwise(0))
    percent = F.when(F.col("_n") > 1, (rank - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0)).cast("double")
    of_kind = {"dense": dense.cast("int"), "rank": rank.cast("int"), "percent": percent}
    used = list(dict.fromkeys(c for order in orders for c, _ in order))
    # a rank depends on the partition and order columns only: rows equal in them and in the hash are one here
    kinds = {kind for kind, _ in ranks.values()}
    ranked = ranked.select(ROW_HASH, *used, "_j", *[of_kind[kind].alias(f"_{kind}") for kind in sorted(kinds)]).repartition(ROW_HASH)
    found = ranked.groupBy(ROW_HASH, *used).agg(*[F.max(F.when(F.col("_j") == j, F.col(f"_{kind}"))).alias(name)
                                                  for j, (name, (kind, _)) in enumerate(ranks.items())])
    names = {c: f"__k_{c}" for c in used}
    found = found.select(F.col(ROW_HASH).alias("__h"), *[F.col(c).alias(n) for c, n in names.items()], *ranks)
    on = F.col(ROW_HASH) == F.col("__h")
    for c, n in names.items():
        on = on & same(F.col(c), F.col(n))
    return base.join(found, on).select(*df.columns, *ranks)


def global_ranks(df: DataFrame, ranks: Mapping[str, tuple[str, OrderSpec]], buckets: int | None = None) -> DataFrame:
    """Several whole-result ranks; ``ranks`` maps an output name to ``("dense" | "rank" | "percent", order)``."""
    return _with_ranks(df, [], ranks, buckets)


def global_dense_ranks(df: DataFrame, ranks: Mapping[str, OrderSpec], buckets: int | None = None) -> DataFrame:
    """``global_ranks`` with DENSE_RANK for every entry."""
    return global_ranks(df, {n: ("dense", o) for n, o in ranks.items()}, buckets)


def global_dense_rank(df: DataFrame, order: OrderSpec, name: str, buckets: int | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY order)``."""
    return global_ranks(df, {name: ("dense", order)}, buckets)


def global_rank(df: DataFrame, order: OrderSpec, name: str, buckets: int | None = None) -> DataFrame:
    """``RANK() OVER (ORDER BY order)`` (gaps after ties)."""
    return global_ranks(df, {name: ("rank", order)}, buckets)


def global_percent_rank(df: DataFrame, order: OrderSpec, name: str, buckets: int | None = None) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY order)`` = (rank - 1) / (rows - 1), 0 for a single row."""
    return global_ranks(df, {name: ("percent", order)}, buckets)


def dense_ranks_within(df: DataFrame, partition: Sequence[str], ranks: Mapping[str, OrderSpec], buckets: int | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY partition ORDER BY ...)`` for several orders, safe for hot partitions:
    ranges cut the order over all partitions, of which a hot one spans many."""
    return _with_ranks(df, list(partition), {n: ("dense", o) for n, o in ranks.items()}, buckets)


def top_n(df: DataFrame, order: OrderSpec, n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, in that order; end ``order`` with a key to break ties.

    Plans to one TakeOrderedAndProject: every task keeps its own first ``n``."""
    return df.orderBy(*sort_columns(order)).limit(n)
