"""Token-count rollups maintained by signed deltas.

Totals per (source, lang, tokenizer version) are additive, so a batch of
changes is reduced to one row of signed sums per group and only that is
stored: an insert adds a document and its tokens, a delete subtracts both, a
revised count adds the difference. Totals are the sum over batches.

Batch commits are idempotent. A batch is written to its own folder, and it
counts once that folder has Spark's ``_SUCCESS`` mark: a batch that died
half-way is written again, a committed batch id is never applied twice.
``compact`` folds committed batches into a snapshot that lists them.

Edge cases: null source, lang or tokenizer form groups of their own; null
counts add nothing; rows with an unknown operation are an error (a silent
skip would make totals wrong); repeated rows count each; an empty batch
commits no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm.binslack import VOCABULARY, encoder
from paylens.llm.common import materialise, scratch_path

GROUP = ("source", "lang", "tokenizer")
CHANGES = "op string, source string, lang string, tokenizer string, tokens long, old_tokens long, times long"
TOTALS = "source string, lang string, tokenizer string, documents long, tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Changes (op insert / delete / revise, group, tokens, old_tokens, times) as
    signed sums per group; ``times`` is the number of equal rows a row stands for."""
    sign = (F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0)
            .otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce("op", F.lit("null"))))))
    old = F.when(F.col("op") == "revise", F.coalesce("old_tokens", F.lit(0))).otherwise(0)
    new = F.coalesce("tokens", F.lit(0)) * F.when(F.col("op") == "delete", -1).otherwise(1)
    return changes.groupBy(*GROUP).agg(F.sum(sign * F.col("times")).cast("long").alias("documents"),
                                       F.sum((new - old) * F.col("times")).cast("long").alias("tokens"))


class RollupStore:
    """Committed batches and snapshots under one shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _list(self, pattern: str) -> list[str]:
        """Committed folders (those with a _SUCCESS mark) whose name fits."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return [n for n in names if re.fullmatch(pattern, n) and fs.exists(hadoop.Path(f"{self.path}/{n}/_SUCCESS"))]

    def committed(self) -> set[str]:
        done = {n[6:] for n in self._list(r"batch-.+")}
        snapshot = self._snapshot()
        return done | (self._folded(snapshot) if snapshot else set())

    def _snapshot(self) -> str | None:
        return max(self._list(r"snapshot-\d+"), default=None, key=lambda n: int(n[9:]))

    def _folded(self, snapshot: str) -> set[str]:
        return {r["batch"] for r in self.spark.read.schema("batch string").parquet(
            f"{self.path}/folded-{snapshot[9:]}").collect()}

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch once; false if it had been committed before."""
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits, dot, dash and underscore only")
        if batch_id in self.committed():
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self.path}/batch-{batch_id}")
        return True

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """One look at the folder: newest snapshot, the batches in it, committed batches beyond it."""
        snapshot = self._snapshot()
        folded = self._folded(snapshot) if snapshot else set()
        return snapshot, folded, sorted(n[6:] for n in self._list(r"batch-.+") if n[6:] not in folded)

    def _sum(self, snapshot: str | None, batches: list[str]) -> DataFrame:
        names = [f"batch-{b}" for b in batches] + ([snapshot] if snapshot else [])
        if not names:
            return self.spark.createDataFrame([], TOTALS)
        parts = self.spark.read.schema(TOTALS).parquet(*[f"{self.path}/{n}" for n in names])
        return parts.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        snapshot, _, batches = self._state()
        return self._sum(snapshot, batches)

    def compact(self) -> None:
        """Fold committed batches into the next snapshot. The list of its batches is
        written first and exactly those are summed: a batch that is committed
        meanwhile is in neither and counts beside the snapshot."""
        snapshot, folded, batches = self._state()
        number = int(snapshot[9:]) + 1 if snapshot else 1
        self.spark.createDataFrame([(b,) for b in sorted({*folded, *batches})], "batch string").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/folded-{number}")
        self._sum(snapshot, batches).write.mode("overwrite").parquet(f"{self.path}/snapshot-{number}")


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, lang, text_key, estimate (a token per four bytes) and tokens of every whole text."""
    def run(batches):
        encode = encoder(vocabulary)
        for b in batches:
            n = pa.array([len(encode(t)) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names if c != "text"], n],
                                             [*[c for c in b.schema.names if c != "text"], "tokens"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.sha2(text.cast("binary"), 256).alias("text_key"),
                       F.ceil(F.octet_length(text) / 4).cast("long").alias("estimate"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, source string, lang string, text_key string, estimate long, tokens long")


def copies(counted: DataFrame) -> DataFrame:
    """All rows but one of each text (the smallest id stays), as rows with ``times``."""
    same = counted.groupBy("text_key", "doc_id", "source", "lang").agg(F.count("*").alias("c"), F.max("tokens").alias("tokens"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("source"), F.col("lang"))
    first = same.groupBy("text_key").agg(F.min(order).alias("first"), F.sum("c").alias("n")).filter("n > 1")
    rows = same.join(first.select("text_key", "first"), "text_key")
    return (rows.withColumn("times", F.col("c") - F.when(order.eqNullSafe(F.col("first")), 1).otherwise(0))
            .filter("times > 0").select("source", "lang", "tokens", "times"))


def corpus_rollup(docs: DataFrame, vocabulary: str = VOCABULARY, version: str = "1", path: str | None = None) -> DataFrame:
    """Totals per source, lang and tokenizer version after three batches over
    ``docs``: every document enters with an estimated count, all counts are
    revised to the tokenizer's (``documents``, ``tokens``: the whole corpus),
    and exact copies are deleted (``distinct_documents``, ``distinct_tokens``).
    The revision is committed twice, as after a lost answer, and applied once."""
    spark = docs.sparkSession
    counted = materialise(token_counts(docs, vocabulary), "rollup-counts")
    label = F.lit(f"{vocabulary}@{version}").alias("tokenizer")

    def change(rows, op, tokens, old=None, times=None):
        return rows.select(F.lit(op).alias("op"), "source", "lang", label, F.col(tokens).alias("tokens"),
                           (F.col(old) if old else F.lit(None).cast("long")).alias("old_tokens"),
                           (F.col(times) if times else F.lit(1).cast("long")).alias("times"))
    store = RollupStore(spark, path or scratch_path(spark, "rollup"))
    store.commit("load", change(counted, "insert", "estimate"))
    for _ in range(2):
        store.commit("recount", change(counted, "revise", "tokens", old="estimate"))
    whole = store.totals()                  # of the batches committed up to here
    store.commit("dedup", change(copies(counted), "delete", "tokens", times="times"))
    left = store.totals().select(*[F.col(c).alias(f"_{c}") for c in GROUP], F.col("documents").alias("distinct_documents"),
                                 F.col("tokens").alias("distinct_tokens"))
    same = F.lit(True)
    for c in GROUP:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return whole.join(left, same, "left").drop(*[f"_{c}" for c in GROUP])
