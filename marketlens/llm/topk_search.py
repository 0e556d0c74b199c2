"""Exact top-k by Hamming distance: incremental multi-index hashing of binary codes.

A vector's code holds the signs of its components, cut into segments; every segment is an index.
Queries probe all values within a radius of their own segment values and verify the full
distance of what they find. After radius s, every code closer than segments * (s + 1) has been
found (it must be within s of the query in some segment), so a query is done once its k-th
verified distance is below that; all others go on with the next radius. The largest radius
is the segment width, where everything is found: the search is exact and needs no cap.

Equal codes are indexed once, with their k smallest ids, which are all that a top-k can name of them
(ties go to the smaller id). Neither copies nor a value that many codes share are gathered in
one task: probes meet the index in joins that Spark can split, and each query keeps its k best.

Defined results: null vectors and null ids are neither indexed nor asked; null or missing components
count as 0 (bit unset), zeros count as positive (bit set); repeated rows are rows of
their own; with fewer than k rows all are returned; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

K = 10
QUERY_EVERY = 100
MIN_SEGMENT, MAX_SEGMENT = 8, 16


def code_segments(vector: Column, width: Column | int, dims: int) -> Column:
    """Array of segment values: bit j of segment i is set where component i * width + j is 0 or more."""
    bit = lambda i, j: F.when(F.coalesce(F.get(vector, i * width + j), F.lit(-1.0)) >= 0, F.lit(1 << j)).otherwise(0)
    parts = []
    for i in range(-(-dims // width)):
        value = F.lit(0)
        for j in range(min(width, dims - i * width)):
            value = value.bitwiseOR(bit(i, j))
        parts.append(value)
    return F.array(*parts)


def segment_width(rows: int) -> int:
    """About log2 of the number of rows, so that a segment value is shared by few codes."""
    return max(MIN_SEGMENT, min(MAX_SEGMENT, max(1, rows).bit_length()))


def _distance(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, d: s + d)


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for c in combinations(range(width), radius)]


#: DuckDB SQL of the registered query: every row whose id is divisible by QUERY_EVERY against all rows.
SQL = f"""
WITH d AS (
  SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id,
    CAST(list_sum([CASE WHEN (coalesce(q.embedding[i], -1) >= 0) <> (coalesce(e.embedding[i], -1) >= 0) THEN 1 ELSE 0 END FOR i IN range(1, 65)]) AS INTEGER) AS distance
  FROM embeddings q, embeddings e WHERE q.vec_id % {QUERY_EVERY} = 0
)
SELECT query_id, neighbor_id, distance, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d) WHERE rank <= {K}
"""


def search(spark: SparkSession, rows: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows query_id, neighbor_id, distance, rank: the k nearest rows of each query row, by (distance, id)."""
    base = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    asked = queries.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    facts = base.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims, width = max(1, facts["dims"] or 1), segment_width(facts["n"])
    segments = -(-dims // width)
    # the k smallest ids of each code, by partial top-k per part of the ids and then over the parts
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    coded = base.select("id", code_segments(F.col("v"), width, dims).alias("code"), part.alias("part"))
    ranked = coded.withColumn("r", F.row_number().over(W.partitionBy("code", "part").orderBy("id"))).where(F.col("r") <= k)
    codes = ranked.groupBy("code").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k).alias("ids"))
    codes = common.materialize(spark, codes.select(F.monotonically_increasing_id().alias("code_id"), "code", "ids"))
    index = codes.select("code_id", F.posexplode("code").alias("segment", "value"))
    # one search per distinct asked code
    wanted = common.materialize(spark, asked.select("id", code_segments(F.col("v"), width, dims).alias("code")))
    active = wanted.groupBy("code").agg(F.min("id").alias("query")).select("query", F.col("code").alias("q"))
    found, done = None, None
    for radius in range(width + 1):
        active = common.materialize(spark, active)
        flips = spark.createDataFrame([(f,) for f in _flips(width, radius)], "flip int")  # at most C(16, 8) rows
        probes = active.select("query", F.posexplode("q").alias("segment", "own")).join(F.broadcast(flips)).select(
            "query", "segment", F.col("own").bitwiseXOR(F.col("flip")).alias("value"))
        met = probes.join(index, ["segment", "value"]).select("query", "code_id").distinct()
        new = met.join(codes, "code_id").join(active, "query").select("query", "code_id", "ids", _distance("code", "q").alias("distance"))
        if found is not None:
            new = new.unionByName(found).dropDuplicates(["query", "code_id"])
        # of codes in the order of their first row, only the first k can name one of the k nearest rows
        found = new.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy("distance", F.col("ids")[0]))).where(F.col("r") <= k).drop("r")
        found = common.materialize(spark, found)
        covered = segments * (radius + 1) - 1
        near = found.where(F.col("distance") <= covered).groupBy("query").agg(F.sum(F.size("ids")).alias("rows")).where(F.col("rows") >= k)
        finished = found.join(near, "query", "left_semi") if radius < width else found
        done = finished if done is None else done.unionByName(finished)
        if radius < width:
            left = active.join(near, "query", "left_anti")
            found = found.join(near, "query", "left_anti")
            active = left
            if not left.limit(1).count():
                break
    answers = done.select("query", "distance", F.explode("ids").alias("neighbor_id"))
    answers = answers.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy("distance", "neighbor_id"))).where(F.col("rank") <= k)
    same = wanted.join(wanted.groupBy("code").agg(F.min("id").alias("query")), "code").select(F.col("id").alias("query_id"), "query")
    return same.join(answers, "query").select("query_id", "neighbor_id", "distance", "rank")
