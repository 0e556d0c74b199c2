"""Quality rules: robust multivariate outliers by minimum covariance determinant, in DataFrame functions only.

Each text gives a vector of transformed statistics. Per (lang, source) the minimum-covariance-determinant
estimate is found by concentration steps: from a coordinate-wise median and quartile start, keep
the closest SUBSET share of the group's documents, take their mean and covariance, measure every
document's Mahalanobis distance to these, and repeat. The covariance gets a floor on its diagonal
(statistics that hardly vary would make it singular) and the usual factor for its truncation. A
document whose squared distance passes the chi-square quantile CUT is rejected. Documents that fail the base
rules (few words, mostly repeated windows) are rejected and take no part in the estimates.

Everything is a grouped aggregate over all rows with map-side partial sums (quantiles are taken
from counts on a fixed grid), so a group holding a third of all rows is never gathered.
The same estimate is made of every language and of the whole table. A language's is drawn toward the
table's, and a group's toward its language's, by its number n of documents: the centre keeps the weight
n / (n + CENTRE_PRIOR), the covariance n / (n + SPREAD_PRIOR). So no group size switches the estimate: large groups
are judged by their own, small ones by their own centre and mostly their language's spread.

Defined results: null text has no words and fails the base rules; null lang or source form groups of their own;
repeated rows are judged alike; an empty table gives no rows; further columns do not matter.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common
from .line_dedup import let, worded_lines

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 3
MIN_WORDS = 50
SUBSET, STEPS, CUT = 0.75, 4, 1 - 1e-7
#: Documents that the language's (the table's) centre and covariance count as in a group's (a language's) estimate.
CENTRE_PRIOR, SPREAD_PRIOR = 1, 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistic -> floor of its standard deviation within a group.
FLOORS = {"z_word_length": 0.06, "z_symbols": 0.2, "z_upper": 0.3, "z_marks": 0.3, "z_dup_lines": 0.3, "z_repeats": 0.3}
#: Steps per unit of the grids on which quantiles are counted.
GRID, DISTANCE_GRID = 64, 16
#: Rows of a table of groups that go to one file.
GROUPS_A_FILE = 10_000


def _repeat_words(words: Column) -> Column:
    """Words in windows of REPEAT_WINDOW words found twice or more in the text, first included.

    Window hashes keep their upper bits and carry their position in the lower ones (as many as
    positions need), so one primitive sort brings equal windows together.
    """
    bits = F.length(F.bin(F.size(words)))
    state = F.struct(words.alias("w"), (F.expr("bigint(1)") * F.pow(F.lit(2.0), bits).cast("long") - 1).alias("m"))

    def window(s: Column, i: Column) -> Column:
        h = F.xxhash64(*(F.get(s["w"], i + k) for k in range(REPEAT_WINDOW)))
        return h.bitwiseAND(F.bitwise_not(s["m"])).bitwiseOR(i.cast("long"))

    def covered(s: Column, h: Column) -> Column:
        alike = lambda x, y: x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(s["m"])) == 0
        twice = F.filter(h, lambda x, i: alike(x, F.get(h, i - 1)) | alike(x, F.get(h, i + 1)))
        zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(s["m"]))), zero,
                           lambda a, p: F.struct((p + REPEAT_WINDOW).alias("end"), (a["n"] + REPEAT_WINDOW - F.greatest(a["end"] - p, F.lit(0).cast("long"))).alias("n")),
                           lambda a: a["n"])

    def body(s: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(s["w"]) - REPEAT_WINDOW), lambda i: window(s, i))
        return F.when(F.size(s["w"]) >= REPEAT_WINDOW, let(F.sort_array(hashes), lambda h: covered(s, h))).otherwise(F.lit(0).cast("long"))
    return let(state, body)


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the base statistics, base_failed, and the transformed vector of every row."""
    text = common.text_or_empty()
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")

    def measures(s: Column) -> Column:
        return F.struct(F.size(s["w"]).cast("long").alias("n_words"),
                        F.length(s["bare"]).cast("long").alias("word_chars"),
                        (F.length(s["bare"]) - F.length(F.translate(s["bare"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
                        (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("long").alias("n_dup_lines"),
                        F.size(s["l"]).cast("long").alias("n_lines"),
                        (F.length(s["bare"]) - F.length(F.regexp_replace(s["bare"], "\\p{Lu}+", ""))).cast("long").alias("n_upper"),
                        F.length(F.regexp_replace(s["bare"], "[\\p{L}\\p{N}\\p{M}]+", "")).cast("long").alias("n_marks"),
                        _repeat_words(s["w"]).alias("n_repeat_words"))

    words = F.filter(F.split(text, f"[{common.ASCII_SPACE}]+", -1), lambda w: w != "")
    made = let(F.struct(words.alias("w"), bare.alias("bare"), worded_lines(text).alias("l")), measures)
    m = common.fresh(docs, "measures")
    rows = docs.withColumn(m, made)
    at = lambda name: F.col(m)[name]
    per = lambda n, d, unit: F.log1p(n / (F.greatest(d, F.lit(1)) * F.lit(unit)))
    failed = (at("n_words") < MIN_WORDS) | (100 * at("n_repeat_words") > 50 * at("n_words"))
    return rows.select(*keep, *[at(c).alias(c) for c in BASE], failed.alias("base_failed"),
                       F.log(F.greatest(at("word_chars"), F.lit(1)) / F.greatest(at("n_words"), F.lit(1))).alias("z_word_length"),
                       per(at("n_symbols"), at("word_chars"), 0.02).alias("z_symbols"),
                       per(at("n_upper"), at("word_chars"), 0.05).alias("z_upper"),
                       per(at("n_marks"), at("word_chars"), 0.05).alias("z_marks"),
                       per(at("n_dup_lines"), at("n_lines"), 0.2).alias("z_dup_lines"),
                       per(at("n_repeat_words"), at("n_words"), 0.2).alias("z_repeats"))


def chi2_cdf(x: float, df: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    a, t = df / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= t / n
        total += term
    return min(1.0, total * math.exp(-t + a * math.log(t) - math.lgamma(a)))


def chi2_quantile(p: float, df: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, df) < p else (low, mid)
    return (low + high) / 2


def truncation_factor(subset: float, df: int) -> float:
    """Makes the covariance of the closest ``subset`` share of normal data that of all of it."""
    return subset / chi2_cdf(chi2_quantile(subset, df), df + 2)


def _at_share(counts: DataFrame, keys: list[str], bin_col: str, shares: dict[str, float]) -> DataFrame:
    """Per ``keys``: the first bin whose cumulated count reaches each share."""
    before = W.partitionBy(*keys).orderBy(bin_col)
    cum = counts.withColumn("__cum", F.sum("n").over(before)).withColumn("__all", F.sum("n").over(W.partitionBy(*keys)))
    return cum.groupBy(*keys).agg(*[F.min(F.when(F.col("__cum") >= F.col("__all") * s, F.col(bin_col))).alias(a) for a, s in shares.items()])


def _lower_inverse(cov: DataFrame, names: list[str]) -> DataFrame:
    """Adds columns l_i_j: the inverse of the Cholesky factor of the covariance in columns c_i_j, row by row."""
    p = len(names)
    for j in range(p):
        d = F.col(f"c_{j}_{j}")
        for k in range(j):
            d = d - F.col(f"f_{j}_{k}") * F.col(f"f_{j}_{k}")
        cov = cov.withColumn(f"f_{j}_{j}", F.sqrt(F.greatest(d, F.lit(1e-12))))
        below = {}
        for i in range(j + 1, p):
            s = F.col(f"c_{j}_{i}")
            for k in range(j):
                s = s - F.col(f"f_{i}_{k}") * F.col(f"f_{j}_{k}")
            below[f"f_{i}_{j}"] = s / F.col(f"f_{j}_{j}")
        cov = cov.withColumns(below) if below else cov
    for i in range(p):
        row = {}
        for j in range(i):
            s = F.lit(0.0)
            for k in range(j, i):
                s = s - F.col(f"f_{i}_{k}") * F.col(f"l_{k}_{j}")
            row[f"l_{i}_{j}"] = s / F.col(f"f_{i}_{i}")
        row[f"l_{i}_{i}"] = 1 / F.col(f"f_{i}_{i}")
        cov = cov.withColumns(row)
    return cov


def _distance(names: list[str]) -> Column:
    total = F.lit(0.0)
    for i in range(len(names)):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"l_{i}_{j}") * (F.col(names[j]) - F.col(f"mu_{j}"))
        total = total + y * y
    return total


def _stat_columns(p: int) -> list[str]:
    return [f"mu_{i}" for i in range(p)] + [f"l_{i}_{j}" for i in range(p) for j in range(i + 1)]


def _moment_columns(p: int) -> list[str]:
    return [f"mu_{i}" for i in range(p)] + [f"c_{i}_{j}" for i in range(p) for j in range(i, p)]


def _compact(spark: SparkSession, groups: DataFrame, files: int = 1) -> DataFrame:
    """``groups`` (a row per group) stored in few files: few groups are then seen to be small, and broadcast, so that the rows of a large
    group stay where they are; many are not, and the join with them can be split by Spark where a group is large."""
    return common.materialize(spark, groups.repartition(files))


def estimates(spark: SparkSession, rows: DataFrame, floors: dict[str, float], steps: int = STEPS, subset: float = SUBSET) -> DataFrame:
    """Per group (column ``grp``): mean mu_i and inverse Cholesky factor l_i_j of the robust covariance, its upper half c_i_j,
    and n, the documents closest to the centre that they rest on."""
    names, p = list(floors), len(floors)
    # start: medians and quartile widths, from counts on a grid
    cells = rows.select("grp", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.round(F.col(n) * GRID).cast("long").alias("bin")) for i, n in enumerate(names)])).alias("c"))
    cells = cells.groupBy("grp", "c.i", "c.bin").agg(F.count("*").alias("n"))
    start = _at_share(cells, ["grp", "i"], "bin", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    floor = F.array(*[F.lit(float(x)) for x in floors.values()])
    start = start.select("grp", "i", (F.col("q2") / GRID).alias("mu"),
                         F.sqrt(F.pow((F.col("q3") - F.col("q1")) / (GRID * 1.349), F.lit(2.0)) + F.pow(F.get(floor, F.col("i")), F.lit(2.0))).alias("sd"))
    stats = start.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col("mu"))).alias(f"mu_{i}") for i in range(p)],
                                     *[F.max(F.when(F.col("i") == i, 1 / F.col("sd"))).alias(f"l_{i}_{i}") for i in range(p)])
    stats = stats.withColumns({f"l_{i}_{j}": F.lit(0.0) for i in range(p) for j in range(i)})
    stats = common.materialize(spark, stats.select("grp", *_stat_columns(p)))
    files = -(-max(1, stats.count()) // GROUPS_A_FILE)
    stats = _compact(spark, stats, files)
    factor = truncation_factor(subset, p)
    for _ in range(steps):
        measured = rows.join(stats, "grp").select("grp", *names, F.round(F.log1p(_distance(names)) * DISTANCE_GRID).cast("long").alias("bin"))
        limit = _at_share(measured.groupBy("grp", "bin").agg(F.count("*").alias("n")), ["grp"], "bin", {"most": subset})
        close = measured.join(_compact(spark, limit, files), "grp").where("bin <= most")
        moments = close.groupBy("grp").agg(F.count("*").alias("n"), *[F.avg(n).alias(f"mu_{i}") for i, n in enumerate(names)],
                                           *[F.covar_pop(names[i], names[j]).alias(f"c_{i}_{j}") for i in range(p) for j in range(i, p)])
        moments = moments.withColumns({f"c_{i}_{i}": F.col(f"c_{i}_{i}") + float(floors[n]) ** 2 / factor for i, n in enumerate(names)})
        moments = moments.withColumns({f"c_{i}_{j}": F.col(f"c_{i}_{j}") * factor for i in range(p) for j in range(i, p)})
        made = _compact(spark, _lower_inverse(moments, names).select("grp", *_stat_columns(p), "n", *[f"c_{i}_{j}" for i in range(p) for j in range(i, p)]), files)
        stats = made.select("grp", *_stat_columns(p))
    return made


def drawn(own: DataFrame, wider: DataFrame, on: str, p: int) -> DataFrame:
    """Moments ``own`` drawn toward those of the wider group that column ``on`` of both names."""
    wide = wider.select(on, *[F.col(c).alias(f"wide_{c}") for c in _moment_columns(p)])
    prior = lambda c: F.lit(float(CENTRE_PRIOR if c.startswith("mu") else SPREAD_PRIOR))
    return own.join(wide, on).withColumns({c: (F.col("n") * F.col(c) + prior(c) * F.col(f"wide_{c}")) / (F.col("n") + prior(c)) for c in _moment_columns(p)}).select(*own.columns)


def _keys() -> list[Column]:
    """Group names from the narrowest to the whole table."""
    return [F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))), F.concat(F.lit("1"), F.to_json(F.struct("lang"))), F.lit("0")]


def group_estimates(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows name, mu_i, l_i_j: the drawn estimate of every (lang, source) name with documents that pass the base rules."""
    names, p = list(FLOORS), len(FLOORS)
    base = rows.where(~F.col("base_failed"))
    made = estimates(spark, common.materialize(spark, base.select(F.explode(F.array(*_keys())).alias("grp"), *names)), FLOORS)
    own, lang, table = _keys()
    levels = common.materialize(spark, base.select(own.alias("name"), lang.alias("lang_name"), table.alias("table_name")).distinct())
    moments = lambda key: made.select(F.col("grp").alias(key), "n", *_moment_columns(p))
    langs = moments("lang_name").join(levels.select("lang_name", "table_name").distinct(), "lang_name")
    langs = common.materialize(spark, drawn(langs, moments("table_name"), "table_name", p))
    groups = drawn(moments("name").join(levels, "name"), langs, "lang_name", p)
    return _lower_inverse(groups, names).select("name", *_stat_columns(p))


def judged(spark: SparkSession, rows: DataFrame, out: list[str]) -> DataFrame:
    """``out`` columns of stored ``rows`` (statistics with lang and source), and ``kept``."""
    names = list(FLOORS)
    cut = chi2_quantile(CUT, len(names))
    kept = ~F.col("base_failed") & (F.coalesce(_distance(names), F.lit(0.0)) <= cut)
    # stored, so that its size is known: a small table is broadcast and the rows, texts included, stay where they are
    found = common.materialize(spark, group_estimates(spark, rows))
    by_name = _compact(spark, found, -(-max(1, found.count()) // GROUPS_A_FILE))
    name = common.fresh(rows, "name")
    return rows.withColumn(name, _keys()[0]).join(by_name.withColumnRenamed("name", name), name, "left").select(*out, kept.alias("kept"))


def quality(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows doc_id, the base statistics, base_failed, kept: one per row of ``docs``."""
    rows = common.materialize(spark, statistics(docs, ["doc_id", "lang", "source"]))
    return judged(spark, rows, ["doc_id", *BASE, "base_failed"])


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were."""
    plain = docs.select(F.struct(*docs.columns).alias("row"), "text", "lang", "source")
    rows = common.materialize(spark, statistics(plain, ["row", "lang", "source"]))
    return judged(spark, rows, ["row"]).where("kept").select("row.*")
