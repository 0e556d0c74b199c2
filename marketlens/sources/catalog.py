"""Table access.

A ``Tables`` object maps logical source names (table names without their schema, e.g.
``campaign_stats``; social tables carry an ``fb_`` prefix) to DataFrames.  Plans only ever
ask a ``Tables`` for a name, so the same plan runs over real synced tables
(``read_tables``), over the driver's role adapters (``DriverTables``) or over hand-built
unit-test frames.
"""
from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import OPTIONAL, SCHEMAS


class Tables:
    def __init__(self, spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]] | None = None,
                 frames: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self._builders = dict(builders or {})
        self._frames: dict[str, DataFrame] = dict(frames or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._builders:
                raise KeyError(f"unknown source table {name!r}")
            self._frames[name] = self._builders[name]()
        return self._frames[name]

    def has(self, name: str) -> bool:
        return name in self._frames or name in self._builders


def slice_rows(df: DataFrame, slicers: Mapping[str, object]) -> DataFrame:
    """Report slicers on a result: ``{column: value | list of values | (low, high)}``; a bound may be None.

    Slicers on columns that ``df`` lacks are an error here (see ``Sliced`` for whole reports)."""
    for name, want in slicers.items():
        col = F.col(name)
        if isinstance(want, tuple):
            low, high = want
            df = df.where(col >= F.lit(low)) if low is not None else df
            df = df.where(col <= F.lit(high)) if high is not None else df
        elif isinstance(want, (list, set, frozenset)):
            df = df.where(col.isin(list(want)))
        else:
            df = df.where(col == F.lit(want))
    return df


class Sliced(Tables):
    """``base`` with slicers applied to every source table that has their columns: plain predicates on
    the scan, so a date or account slicer prunes before anything is joined or aggregated."""

    def __init__(self, base: Tables, slicers: Mapping[str, object]):
        super().__init__(base.spark)
        self._base, self._slicers = base, dict(slicers)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._base[name]
        return slice_rows(df, {c: v for c, v in self._slicers.items() if c in df.columns})

    def has(self, name: str) -> bool:
        return self._base.has(name)


def conform(df: DataFrame, schema: T.StructType, optional: frozenset[str] = frozenset(), name: str = "table") -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add absent ``optional`` ones as NULL.

    Any other absent column is an error: a silent NULL would turn into wrong totals."""
    lacking = [f.name for f in schema.fields if f.name not in df.columns and f.name not in optional]
    if lacking:
        raise ValueError(f"{name}: required columns are missing: {', '.join(lacking)}")
    current = {f.name: f.dataType for f in df.schema.fields}
    wanted = [(f.name, f.dataType) for f in schema.fields]
    if list(current.items()) == wanted:
        return df
    if all(current.get(n) == t for n, t in wanted):  # only order / extra helper columns differ
        return df.select(*[n for n, _ in wanted])
    present = set(current)
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet", options: Mapping[str, str] | None = None) -> Tables:
    """Read ``{root}/{name}`` for every known source table (Parquet by default, partitioned by
    ``date`` for the daily stats tables so period predicates prune directories).  Optional
    columns missing from a file are added as NULL (the social breakdown columns); a missing
    required column is an error."""
    def builder(name: str):
        def build() -> DataFrame:
            path = os.path.join(root, name)
            reader = spark.read.format(fmt).options(**(options or {}))
            return conform(reader.load(path), SCHEMAS[name], OPTIONAL.get(name, frozenset()), name)
        return build
    return Tables(spark, {name: builder(name) for name in SCHEMAS})


def recent(df: DataFrame, date_col: str, days: int, as_of) -> DataFrame:
    """Date-bounded import (the model's "last N days" source filter): a plain predicate on the
    date column, so it reaches the scan (partition pruning / Parquet row-group skipping / JDBC
    WHERE clause)."""
    from ..functions.dates import in_last_days
    return df.filter(in_last_days(date_col, as_of, days))


def read_jdbc_tables(spark: SparkSession, url: str, properties: Mapping[str, str],
                     table_names: Mapping[str, str], partitioning: Mapping[str, tuple[str, int, int, int]] | None = None
                     ) -> Tables:
    """Source tables straight from the synced relational database.

    ``table_names`` maps a logical name (``campaign_stats``) to the database table
    (schema-qualified names are passed through as given);
    ``partitioning`` gives ``(column, lower, upper, partitions)`` for the large tables, so that
    the read is split into parallel range queries instead of one connection.  Filters and
    projections of the plans are pushed into the generated SQL by the JDBC source.
    """
    def builder(name: str, table: str):
        def build() -> DataFrame:
            reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
            if partitioning and name in partitioning:
                col, lo, hi, n = partitioning[name]
                reader = (reader.option("partitionColumn", col).option("lowerBound", str(lo))
                          .option("upperBound", str(hi)).option("numPartitions", str(n)))
            return conform(reader.load(), SCHEMAS[name], OPTIONAL.get(name, frozenset()), name)
        return build
    return Tables(spark, {name: builder(name, table) for name, table in table_names.items() if name in SCHEMAS})
