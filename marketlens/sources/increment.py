"""High-watermark import: each row of a synced table is read once, the latest version of each key is kept.

``pull`` reads only rows synced after the stored cursor (a plain predicate on the sync time, which reaches the scan), writes them as one
delta and stores the new cursor with it in one manifest commit: a pull that dies leaves the cursor where it was, and is simply repeated.
``rows`` merges versions on read; ``compact`` folds the deltas into one folder. A sync stamps its rows later than any sync before it.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_by_key
from .store import Store

SYNCED = "_fivetran_synced"


class Import:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], synced: str = SYNCED):
        self.store, self.keys, self.synced = Store(spark, path), list(keys), synced

    def cursor(self) -> str | None:
        """Sync time up to which everything is imported, as text."""
        return self.store.manifest()[1].get("cursor")

    def pull(self, source: DataFrame) -> int:
        """Import what ``source`` holds beyond the cursor; the number of rows read."""
        number, content = self.store.manifest()
        kind = source.schema[self.synced].dataType
        new = source.where(F.col(self.synced).isNotNull())
        if content.get("cursor") is not None:
            new = new.where(F.col(self.synced) > F.lit(content["cursor"]).cast(kind))
        name = self.store.write(new, "delta")
        written = self.store.read([name])
        count, last = written.agg(F.count("*"), F.max(self.synced).cast("string")).first()
        if count:
            self.store.commit(number, {"cursor": last, "deltas": content.get("deltas", []) + [name]})
        return count

    def rows(self) -> DataFrame | None:
        """The latest version of every key."""
        deltas = self.store.read(self.store.manifest()[1].get("deltas", []))
        return None if deltas is None else latest_by_key(deltas, self.keys)

    def compact(self) -> None:
        number, content = self.store.manifest()
        rows = self.rows()
        if rows is not None:
            self.store.commit(number, {**content, "deltas": [self.store.write(rows, "delta")]})
