"""Incremental (daily-sync) refresh of a daily base mart with Structured Streaming.

The sources are synced in daily batches; stats rows are keyed (entity, date) and a re-sync
may re-deliver a date.  ``refresh_daily_mart`` watches the stats folder as a streaming file
source; every micro-batch only says *which dates changed*.  Those dates are recomputed from
the full source (all rows of those dates, so re-delivered rows replace old ones) through the
ordinary batch plan and written with dynamic partition overwrite - replaying a batch after a
failure rewrites the same partitions, so the refresh is idempotent.  Progress lives in the
checkpoint location (by default under the session's shared ``spark.checkpoint.dir``, one per
stats table and sink, so two marts over one table each see every delivery).

A file source only reports files that arrive.  A date whose rows all vanish from the source, and
changed history (name) rows, arrive as no stats file: ``rebuild_daily_mart`` rewrites the
whole sink for these, which also removes dates that have become empty.
"""
from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by_key
from ..session import ensure_checkpoint_dir
from ..sources.catalog import Tables
from ..sources.schemas import SCHEMAS


class OverlayTables(Tables):
    """A ``Tables`` that answers some names from explicit frames and the rest from a base."""

    def __init__(self, base: Tables, overrides: dict[str, DataFrame]):
        super().__init__(base.spark)
        self._base = base
        self._overrides = overrides

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        return self._base[name]

    def has(self, name: str) -> bool:
        return name in self._overrides or self._base.has(name)


def refresh_daily_mart(spark: SparkSession, tables: Tables, stats_table: str, stats_path: str, sink_path: str,
                       build: Callable[[Tables], DataFrame], keys: Sequence[str], checkpoint_location: str | None = None,
                       date_col: str = "date", available_now: bool = True) -> StreamingQuery:
    """Keep ``sink_path`` (Parquet, partitioned by ``date_col``) equal to ``build(tables)``.

    ``stats_path`` holds the synced ``stats_table`` files; ``build`` is any daily base-mart
    plan (e.g. ``search_ads.campaign_performance``) and receives ``tables`` with
    ``stats_table`` narrowed to the changed dates.  ``keys`` is the table key without the date
    (e.g. ``["campaign_id"]``): a re-delivered (key, date) replaces the earlier row - the
    latest ``_fivetran_synced`` wins, as an upsert into the synced table would.
    """
    schema = SCHEMAS[stats_table]
    if checkpoint_location is None:
        root = ensure_checkpoint_dir(spark)
        sink = hashlib.sha256(sink_path.rstrip("/").encode()).hexdigest()[:16]
        checkpoint_location = os.path.join(root, "refresh", f"{stats_table}-{sink}")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # dates touched by this sync: few for a daily one, many for a first load; the planner sees which
        dates = batch.select(date_col).distinct()
        current = spark.read.schema(schema).parquet(stats_path).join(dates, date_col, "left_semi")
        current = latest_by_key(current, [*keys, date_col])
        out = build(OverlayTables(tables, {stats_table: current}))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(date_col).parquet(sink_path))

    stream = spark.readStream.schema(schema).parquet(stats_path)
    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()


def rebuild_daily_mart(tables: Tables, sink_path: str, build: Callable[[Tables], DataFrame], date_col: str = "date") -> None:
    """Rewrite ``sink_path`` from the full sources: dates without rows disappear, history changes show."""
    (build(tables).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(date_col).parquet(sink_path))
