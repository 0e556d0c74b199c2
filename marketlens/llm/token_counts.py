"""Token counts kept as delta-maintained rollups.

A store holds additive totals by source, language and tokenizer version as one folder of signed
deltas per batch. Every text is counted once by every version, in the task that reads it; from then on only counts move.
A batch of changes (inserts, deletes and revisions of documents) is summed to one signed row per
group: an insert adds its counts, a delete takes them away, a revision takes the old text's counts away and
adds the new one's. A commit writes its rows to a folder of its own, and then switches it on by creating an empty
marker that names it: before that nobody reads the folder, after that the batch id is taken, so a batch that is replayed, or retried after
a failure at any point, counts once. Totals are the sum of all switched-on deltas; compaction folds them into one base folder
that remembers the batch ids it holds, switched on the same way.

Versions are column expressions (``TOKENIZERS``) or supplied vocabularies (a tokenizer file by version name).
Sums are partial before the shuffle, so a source with a third of all rows makes one small row per task.

Defined results: null text counts as empty (no tokens, one document); null source and lang are groups
of their own; repeated rows count as often as they occur; groups whose documents and tokens sum to zero
leave the totals; an empty batch is committed and changes nothing; further columns of any name are ignored; very long texts are whole.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, packing

GROUP = ["source", "lang", "tokenizer_version"]
CLASS_RUNS = "\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+"
#: Tokenizer version -> tokens of a text column.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: F.regexp_count(text, F.lit(f"[^{common.ASCII_SPACE}]+")),
    "classes-1": lambda text: F.regexp_count(text, F.lit(CLASS_RUNS)),
}


def count_tokens(rows: DataFrame, texts: Mapping[str, str], tokenizers: Mapping[str, Callable[[Column], Column]] = TOKENIZERS,
                 vocabularies: Mapping[str, str] | None = None) -> DataFrame:
    """``rows`` with each text column of ``texts`` (name -> name of its counts) replaced by an array of counts, one per version.

    ``vocabularies`` are files of byte-level tokenizers by version name; these are counted without special tokens added."""
    files = list((vocabularies or {}).values())
    kept = [c for c in rows.columns if c not in texts]
    native = {name: F.array(*[fn(common.text_or_empty(c)).cast("long") for fn in tokenizers.values()]).cast("array<long>") for c, name in texts.items()}
    if not files:
        return rows.select(*kept, *[n.alias(name) for name, n in native.items()])
    both = rows.select(*kept, *[n.alias(name) for name, n in native.items()], *[common.text_or_empty(c).alias(f"__text{i}") for i, c in enumerate(texts)])
    n_kept, n_texts = len(kept), len(native)
    schema = T.StructType(both.schema.fields[:n_kept + n_texts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [packing.encoder(f) for f in files]
        for batch in batches:
            columns = [batch.column(i) for i in range(n_kept)]
            for i in range(n_texts):
                held = batch.column(n_kept + i).to_pylist()
                texts_of = batch.column(n_kept + n_texts + i).to_pylist()
                for e in encoders:
                    for counts, ids in zip(held, e.encode(texts_of)):
                        counts.append(len(ids) // 4)
                columns.append(pa.array(held, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return both.mapInArrow(run, schema)


def signed(changes: DataFrame, versions: list[str]) -> DataFrame:
    """Signed rollup of a batch: rows source, lang, tokenizer_version, n_docs, n_tokens.

    ``changes`` has op ('insert', 'delete' or 'revise'), source, lang, and tokens (counts, one per version), and for revisions
    old_source, old_lang and old_tokens. Inserts and the new side of revisions count +1, deletes and the old side -1."""
    def side(sign: int, prefix: str) -> Column:
        return F.struct(F.lit(sign).alias("sign"), F.col(prefix + "source").alias("source"), F.col(prefix + "lang").alias("lang"), F.col(prefix + "tokens").alias("tokens"))

    sides = F.when(F.col("op") == "insert", F.array(side(1, ""))).when(F.col("op") == "delete", F.array(side(-1, "")))
    if "old_tokens" in changes.columns:
        sides = sides.when(F.col("op") == "revise", F.array(side(1, ""), side(-1, "old_")))
    parts = changes.select(F.explode(sides).alias("x")).select("x.*")
    sums = parts.groupBy("source", "lang").agg(F.sum("sign").alias("n_docs"), *[F.sum(F.col("sign") * F.get("tokens", F.lit(i))).alias(f"n{i}") for i in range(len(versions))])
    each = F.array(*[F.struct(F.lit(v).alias("tokenizer_version"), F.col(f"n{i}").alias("n_tokens")) for i, v in enumerate(versions)])
    return sums.select("source", "lang", "n_docs", F.explode(each).alias("x")).select("source", "lang", "x.tokenizer_version", "n_docs", "x.n_tokens")


class Rollup:
    """A store of signed deltas under ``path`` (a folder all executors share), counted by fixed versions."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: Mapping[str, Callable[[Column], Column]] = TOKENIZERS,
                 vocabularies: Mapping[str, str] | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.tokenizers, self.vocabularies = dict(tokenizers), dict(vocabularies or {})
        self.versions = [*self.tokenizers, *self.vocabularies]
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _markers(self, kind: str) -> dict[str, str]:
        """Batch id (or base number) -> the folder that is switched on for it: the first by name if two commits raced."""
        root = self._path(f"{self.path}/{kind}")
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(root)) if self._fs.exists(root) else []
        on: dict[str, str] = {}
        for name in names:
            on.setdefault(unquote(name.split("@")[0]), name)
        return on

    def _switch_on(self, kind: str, name: str) -> None:
        self._fs.create(self._path(f"{self.path}/{kind}/{name}"), False).close()

    def _base(self) -> str | None:
        bases = self._markers("bases")
        return bases[max(bases, key=int)] if bases else None

    def _held(self) -> set[str]:
        base = self._base()
        return {r["batch"] for r in self.spark.read.parquet(f"{self.path}/folders/{base}/held").collect()} if base else set()

    def batches(self) -> set[str]:
        """Ids of the batches that the totals hold."""
        return self._held() | set(self._markers("commits"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Count a batch in; False if it already is. A batch id names one content for good.

        ``changes`` as in ``signed``, with texts (text, and old_text for revisions) or ready counts (tokens, old_tokens)."""
        if batch_id in self.batches():
            return False
        if "tokens" not in changes.columns:
            texts = {c: c.replace("text", "tokens") for c in ("text", "old_text") if c in changes.columns}
            sides = [p + c for p in ("", "old_") for c in ("source", "lang") if p + c in changes.columns]
            changes = count_tokens(changes.select("op", *sides, *texts), texts, self.tokenizers, self.vocabularies)
        name = f"{quote(batch_id, safe='')}@{uuid.uuid4().hex}"
        signed(changes, self.versions).write.parquet(f"{self.path}/folders/{name}")
        self._switch_on("commits", name)
        return True

    def _deltas(self) -> DataFrame | None:
        base, held, out = self._base(), self._held(), None
        names = ([f"{base}/totals"] if base else []) + [n for b, n in sorted(self._markers("commits").items()) if b not in held]
        for name in names:
            rows = self.spark.read.parquet(f"{self.path}/folders/{name}").select(*GROUP, "n_docs", "n_tokens")
            out = rows if out is None else out.unionByName(rows)
        return out

    def totals(self) -> DataFrame:
        """Rows source, lang, tokenizer_version, n_docs, n_tokens."""
        deltas = self._deltas()
        if deltas is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer_version string, n_docs long, n_tokens long")
        return deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base; its marker is created last, and what it replaces goes after that."""
        if self._deltas() is None:
            return
        commits, bases, held = self._markers("commits"), self._markers("bases"), sorted(self.batches())
        name = f"{max(map(int, bases), default=-1) + 1}@{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{self.path}/folders/{name}/totals")
        self.spark.createDataFrame([(b,) for b in held], "batch string").coalesce(1).write.parquet(f"{self.path}/folders/{name}/held")
        self._switch_on("bases", name)
        for kind, names in (("commits", commits.values()), ("bases", bases.values())):
            for n in names:
                self._fs.delete(self._path(f"{self.path}/{kind}/{n}"), True)
                self._fs.delete(self._path(f"{self.path}/folders/{n}"), True)
