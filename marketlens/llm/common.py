"""Helpers shared by the operators: reading, naming, materialising, connected components."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII white space, the word separator of every operator here (fixed by the contracts).
ASCII_SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows in one Arrow batch: bounds what a Python worker holds of long texts at a time.
ARROW_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raises it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def fresh(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that no column of ``df`` has."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def id_crc32(col: str = "doc_id") -> Column:
    """crc32 of the id written as text (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a scratch one only in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote in this application; results that still read it become unreadable."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def rows_to_frame(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (columns a, b of one orderable type): rows (node, label).

    ``label`` is the smallest node of the component. Alternates large-star and small-star rounds,
    so a chain of n nodes needs O(log n) rounds; every round is one written table. Self loops
    give single-node components; null ends are ignored; an empty input gives no rows.
    """
    both = edges.where("a is not null and b is not null")
    cur = materialize(spark, both.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    mark = None
    for _ in range(max_rounds):
        # large-star: every node's larger neighbours point to its smallest neighbour (or itself)
        sym = cur.select(F.col("v").alias("x"), F.col("u").alias("y")).union(cur.select(F.col("u").alias("x"), F.col("v").alias("y")))
        low = sym.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = sym.where("y > x").join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        # small-star: every node's smaller neighbours, and the node, point to the smallest of them
        small_low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(small_low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
                 .union(small_low.select("v", F.col("m").alias("u"))))
        cur = materialize(spark, small.distinct())
        stat = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")).alias("s")).first()
        if (stat["n"], stat["s"]) == mark:
            break
        mark = (stat["n"], stat["s"])
    else:
        raise RuntimeError("components: not settled; raise max_rounds")
    roots = both.select(F.col("a").alias("v")).union(both.select("b")).distinct()
    return roots.join(cur, "v", "left").select(F.col("v").alias("node"), F.coalesce("u", "v").alias("label"))
