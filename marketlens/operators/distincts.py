"""Distinct counts that can be added up later: bitmaps of dense ids, exact over any union of their groups.

A daily count of distinct contacts cannot be summed over days. The state kept here can be merged: per group and block of
32,768 consecutive ids one bitmap of 4 KB. Building it is an aggregation with partial bitmaps before the shuffle; a count
over any set of groups is a bitwise OR per block and a sum of bit counts.

Ids are longs and should be dense (surrogate keys): a block that holds a single id takes 4 KB too. NULL ids are not counted.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "id_bits"


def distinct_state(rows: DataFrame, by: Sequence[str], member: str) -> DataFrame:
    """(by..., id_block, id_bits) of the members that occur in each group."""
    found = rows.where(F.col(member).isNotNull())
    return found.groupBy(*by, F.bitmap_bucket_number(member).alias(BLOCK)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(BITS))


def merge_state(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """The state of coarser groups, or of several states stacked."""
    return state.groupBy(*by, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_count(state: DataFrame, by: Sequence[str], name: str, where: Column | None = None) -> DataFrame:
    """COUNT(DISTINCT member) per ``by`` over the groups that ``where`` leaves."""
    chosen = state if where is None else state.where(where)
    return merge_state(chosen, by).groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("long").alias(name))
