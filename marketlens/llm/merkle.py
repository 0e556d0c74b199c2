"""Merkle manifest of a data set: a tree per source and one over the sources, kept as checkpoints every few levels.

A leaf is the hash of a row's fields; three consecutive nodes hash to one of the next level. Only levels 0,
``STEP``, 2 * ``STEP``, ... are written. The nodes between them are recomputed where a proof needs them: the
stored nodes of one aligned subtree (at most 3 ** STEP) come together in one row, its missing levels are folded by
higher-order functions, every stored node gets its siblings of these levels, and the folded nodes are dropped. Proofs are
put together from the root down, one join of aligned subtrees per stored level, so a source of any size is never in one task.

Defined results: a null field is "-" (an empty one "0:"); null ids come first, and are never tampered; rows that repeat
an id are leaves of their own, ascending by leaf; a null source is a source of its own, the first; very long texts are whole;
an empty table gives no rows; further columns of any name are ignored.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Nodes that hash to one (fixed by the contract), and levels from one written level to the next.
FAN, STEP = 3, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(col: Column) -> Column:
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The leaf of a row, with ``text`` in place of its own."""
    return digest(*[field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS])


def tampered(text: Column, doc_id: str = "doc_id") -> Column:
    """What the tampering makes of ``text``: rows of an even id checksum lose their line feeds."""
    hit = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _height(n: Column) -> Column:
    """Levels above ``n`` nodes: the smallest h with 3 ** h >= n."""
    return F.size(F.filter(F.array(*[F.lit(FAN ** i).cast("long") for i in range(40)]), lambda x: x < n))


def number(spark: SparkSession, nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (stored; columns key, and those of ``order``) with ``pos`` (place within its key) and ``n`` (nodes of the key).

    Rows are dealt by ranges of (key, order, own number), so that neither a large key nor equal rows meet in
    one task; a key's places go on from one range to the next."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = nodes.withColumn("tag", F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(parts, "key", *order, "tag").sortWithinPartitions("key", *order, "tag")
    rows = common.materialize(spark, ranged.drop("tag").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    runs = rows.groupBy("key", "part").agg(F.min("at").alias("start"), F.count("*").alias("size"))
    of_key = Window.partitionBy("key")  # a row a range: as many as partitions at most
    runs = runs.select("key", "part", "start", F.sum("size").over(of_key).alias("n"), (F.sum("size").over(
        of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).alias("before"))
    runs = common.materialize(spark, runs)
    placed = rows.join(runs, ["key", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("start"))
    return placed.drop("part", "at", "start", "before")


def subtrees(nodes: DataFrame) -> DataFrame:
    """Aligned subtrees of a stored level: (key, n, sub, nodes), ``nodes`` the at most 3 ** STEP structs in order."""
    rest = [c for c in nodes.columns if c not in ("key", "n", "pos")]
    sub = F.floor(F.col("pos") / F.lit(FAN ** STEP)).cast("long").alias("sub")
    return nodes.groupBy("key", sub).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("nodes"))


def _folded(below: Column) -> Column:
    """The next level of an array of hex digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * FAN + 1, FAN), ""), 256))


def _levels(group: DataFrame, low: int) -> tuple[DataFrame, Column]:
    """``group`` with arrays _0 ... _STEP: the stored level ``low`` and those recomputed above it; and how many of these exist."""
    out = group.withColumn("_0", F.transform("nodes", lambda x: x["digest"]))
    for i in range(STEP):
        out = out.withColumn(f"_{i + 1}", _folded(F.col(f"_{i}")))
    return out, F.least(F.lit(STEP), F.greatest(F.lit(0), _height(F.col("n")) - F.lit(low)))


def fold(group: DataFrame, low: int) -> DataFrame:
    """Nodes (key, n, pos, digest) of the next stored level; trees that already ended keep their last node."""
    levels, grown = _levels(group, low)
    top = F.array(*[F.get(F.col(f"_{i}"), 0) for i in range(STEP + 1)])
    return levels.select("key", "n", F.col("sub").alias("pos"), F.get(top, grown).alias("digest"))


def extract(group: DataFrame, above: DataFrame, low: int) -> DataFrame:
    """A row per stored node of ``group``: its fields, and ``path`` = its siblings (l, r: hex of those before and after it in
    their run) of the levels that are recomputed here, then the path of its subtree's top node in ``above`` (key, sub, path, ...)."""
    levels, grown = _levels(group.join(above, ["key", "sub"]), low)

    def siblings(place: Column) -> Column:
        def of(i: int) -> Column:
            level, at = F.col(f"_{i}"), F.floor(place / F.lit(FAN ** i)).cast("int")
            first = at - at % FAN
            return F.struct(F.array_join(F.slice(level, first + 1, at - first), "").alias("l"),
                            F.array_join(F.slice(level, at + 2, first + (FAN - 1) - at), "").alias("r"))
        return F.slice(F.array(*[of(i) for i in range(STEP)]), F.lit(1), grown)

    base = F.col("sub") * FAN ** STEP
    own = F.transform("nodes", lambda x: F.struct(x.alias("node"), siblings((x["pos"] - base).cast("int")).alias("own")))
    rest = [c for c in above.columns if c not in ("key", "sub", "path")]
    out = levels.select("key", "path", *rest, F.explode(own).alias("e"))
    return out.select("key", "e.node.*", F.concat("e.own", "path").alias("path"), *rest)


class Tree:
    """A forest of trees, one a ``key``, over ``nodes`` (key, digest, and further columns), ascending by ``order``.

    ``path`` is where the stored levels are written, as path/level=0, 3, 6, ...; a tree opened
    again on the same path reads them back."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, nodes: DataFrame, order: list[str]) -> "Tree":
        level, low = number(self.spark, common.materialize(self.spark, nodes), order), 0
        while True:
            subtrees(level).write.mode("overwrite").parquet(f"{self.path}/level={low}")
            stored = self.subtrees(low)
            # the largest tree decides how many levels there are
            largest = stored.agg(F.max("n")).first()[0] or 0
            level, low = fold(stored, low), low + STEP
            if largest <= FAN ** low:
                self.height = low
                level.write.mode("overwrite").parquet(f"{self.path}/level={low}")
                return self

    def subtrees(self, low: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/level={low}")

    def roots(self) -> DataFrame:
        """(key, n, digest): the top node of every tree."""
        return self.subtrees(self.height).select("key", "n", "digest")

    def proofs(self, above: DataFrame) -> DataFrame:
        """Every leaf's fields with its ``path`` up to its root and on through that of ``above`` (key, path, and columns to hand down)."""
        found = above.withColumn("sub", F.lit(0).cast("long"))
        for low in range(self.height - STEP, -1, -STEP):
            found = extract(self.subtrees(low), found, low)
            if low:
                found = found.drop("digest").withColumnRenamed("pos", "sub")
        return found


def folded_root(start: Column, path: Column) -> Column:
    return F.aggregate(path, start, lambda node, s: digest(s["l"], node, s["r"]))


NO_PATH = "cast(array() as array<struct<l: string, r: string>>)"


def manifest(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """Builds the manifest of ``docs`` under ``path`` (a fresh folder in the shared one unless given) and returns a row per
    document: doc_id, leaf, subroot, root, path, altered (the leaf after ``tampered``)."""
    path = path or f"{common.shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/manifest-{uuid.uuid4().hex}"
    # "0" sorts before "1" and any source: null first, the rest bytewise
    key = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    leaves = docs.select(key.alias("key"), "doc_id", leaf().alias("digest"), leaf(tampered(F.col("text"))).alias("altered"))
    sources = Tree(spark, f"{path}/sources").build(leaves, ["doc_id", "digest"])
    tops = sources.roots().select(F.lit("").alias("key"), F.col("key").alias("source_key"), "digest")
    whole = Tree(spark, f"{path}/root").build(tops, ["source_key"])
    start = whole.roots().select("key", F.expr(NO_PATH).alias("path"), F.col("digest").alias("root"))
    subroots = whole.proofs(start).select(F.col("source_key").alias("key"), "path", "root", F.col("digest").alias("subroot"))
    subroots = common.materialize(spark, subroots)
    return sources.proofs(subroots).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "altered")


def verify(proofs: DataFrame) -> DataFrame:
    """The digest columns of ``manifest``'s rows: the proof's hash, the root that the altered leaf folds to, whether it is the root."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    out = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        folded_root(F.col("altered"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
