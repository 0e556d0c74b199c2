"""Publishing marts (the role of CREATE VIEW / pre-aggregated summary tables)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
            dynamic_overwrite: bool = True) -> None:
    """Write a mart; with ``partition_by`` (e.g. ``date``) and dynamic overwrite only the
    partitions present in ``df`` are replaced, so daily re-publishing is idempotent."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic_overwrite:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def publish_view(df: DataFrame, name: str) -> None:
    """Register a mart as a session view so SQL users can query it by name."""
    df.createOrReplaceTempView(name)
