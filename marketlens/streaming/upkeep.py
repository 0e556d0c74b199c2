"""A mart kept up by signed row changes: corrections, late rows and changed names move only the groups they touch.

The mart sums measures of stats rows (one per key) by attributes, some of them looked up from a dimension. A delivery brings new versions of
stats rows, of dimension rows, or of both. The rows it touches (its own keys, and all rows of a dimension member that
changed) are summed twice: as they stood, with sign -1 and the old attributes, and as they stand now, with sign +1 and the new ones.
The result is a delta of the mart; the mart is the sum of its deltas. Rows, dimension and delta become visible
in one manifest commit, so a delivery that is replayed, or retried after a failure, counts once.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_by_key
from ..sources.store import Store


ORDER = "_version"


class MaintainedMart:
    """``keys`` identify a stats row, ``member`` (one of them) its dimension row; the mart has a row per combination of ``by`` (stats columns)
    and ``attributes`` (dimension columns) that holds stats rows, with ``row_count`` and the sums of ``measures``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], member: str, by: Sequence[str], attributes: Sequence[str], measures: Sequence[str]):
        self.store = Store(spark, path)
        self.keys, self.member, self.by, self.attributes, self.measures = list(keys), member, list(by), list(attributes), list(measures)

    def _versioned(self, rows: DataFrame, columns: Sequence[str], number: int) -> DataFrame:
        """``columns`` and the order of versions: sync time, delivery, and the row itself, so that any two are told apart for good."""
        columns = list(dict.fromkeys(columns))
        return rows.select(*columns, F.struct("_fivetran_synced", F.lit(number), F.xxhash64(*columns)).alias(ORDER))

    def _stack(self, old: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
        return new if old is None else old if new is None else old.unionByName(new)

    def _sums(self, rows: DataFrame, dimension: DataFrame | None, sign: int) -> DataFrame:
        if dimension is None:
            found = rows.withColumns({a: F.lit(None).cast("string") for a in self.attributes})
        else:
            found = rows.join(dimension.select(self.member, *self.attributes), self.member, "left")
        return found.select(*self.by, *self.attributes, F.lit(sign).alias("sign"), *self.measures)

    def apply(self, batch_id: str, stats: DataFrame | None = None, dimension: DataFrame | None = None) -> bool:
        """Count a delivery in; False if it already is. A batch id names one content for good."""
        number, content = self.store.manifest()
        if batch_id in content.get("applied", []):
            return False
        names = {kind: list(content.get(kind, [])) for kind in ("rows", "dimension", "deltas")}
        old_rows, old_dim = self.store.read(names["rows"]), self.store.read(names["dimension"])
        # stored first: what the delta is computed from is what the manifest will name
        if stats is not None:
            names["rows"].append(self.store.write(self._versioned(stats, [*self.keys, *self.by, *self.measures], number), "rows"))
        if dimension is not None:
            names["dimension"].append(self.store.write(self._versioned(dimension, [self.member, *self.attributes], number), "dimension"))
        new_rows, new_dim = self.store.read(names["rows"]), self.store.read(names["dimension"])
        if new_rows is not None:
            touched = self._touched(new_rows, names, stats is not None, dimension is not None)
            parts = []
            for rows, dim, sign in ((old_rows, old_dim, -1), (new_rows, new_dim, 1)):
                if rows is not None:
                    # the touched keys first: versions are compared only among their rows
                    current = latest_by_key(rows.join(touched, self.keys, "left_semi"), self.keys, ORDER)
                    parts.append(self._sums(current, None if dim is None else latest_by_key(dim, self.member, ORDER), sign))
            signed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            delta = signed.groupBy(*self.by, *self.attributes).agg(F.sum("sign").alias("row_count"), *[
                F.sum(F.col(m) * F.col("sign")).cast(new_rows.schema[m].dataType if new_rows.schema[m].dataType.typeName() != "decimal" else "decimal(38,6)").alias(m)
                for m in self.measures])
            names["deltas"].append(self.store.write(delta, "deltas"))
        self.store.commit(number, {"applied": content.get("applied", []) + [batch_id], **names})
        return True

    def _touched(self, rows: DataFrame, names: dict[str, list[str]], has_stats: bool, has_dimension: bool) -> DataFrame:
        found = self.store.read(names["rows"][-1:]).select(*self.keys) if has_stats else None
        if has_dimension:
            members = self.store.read(names["dimension"][-1:]).select(self.member).distinct()
            found = self._stack(found, rows.join(members, self.member, "left_semi").select(*self.keys))
        return found.distinct()

    def mart(self) -> DataFrame | None:
        deltas = self.store.read(self.store.manifest()[1].get("deltas", []))
        if deltas is None:
            return None
        return deltas.groupBy(*self.by, *self.attributes).agg(F.sum("row_count").alias("row_count"), *[F.sum(m).alias(m) for m in self.measures]).where("row_count <> 0")

    def compact(self) -> None:
        """Fold deltas and superseded versions into one folder of each kind."""
        number, content = self.store.manifest()
        names = {}
        for kind, keys in (("rows", self.keys), ("dimension", self.member)):
            held = self.store.read(content.get(kind, []))
            names[kind] = [] if held is None else [self.store.write(latest_by_key(held, keys, ORDER), kind)]
        deltas = self.mart()
        names["deltas"] = [] if deltas is None else [self.store.write(deltas.select(*self.by, *self.attributes, "row_count", *[
            F.col(f.name).cast(f.dataType) for f in self.store.read(content["deltas"]).schema.fields if f.name in self.measures]), "deltas")]
        self.store.commit(number, {**content, **names})
