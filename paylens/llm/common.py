"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return os.path.join(ensure_checkpoint_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, so a lost executor costs a re-read, and the planner knows the
    table's size (it broadcasts a side only below the session's threshold)."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**({"compression": codec} if codec else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, df: DataFrame) -> None:
    """Delete a materialised intermediate that no later plan reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if os.path.basename(folder).startswith("llm-"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nobody holds any more: Spark deletes
    them when the driver's JVM collects the plans, by itself only every half hour."""
    gc.collect()
    spark._jvm.java.lang.System.gc()


def give_back() -> None:
    """Return freed memory of a Python worker to the system: an idle worker keeps what its
    largest task took, beside the JVM and the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):          # another C library: nothing to trim
        pass


def tidy(run):
    """A task function over batches that gives its memory back at its end."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def one_text(docs: DataFrame, picked: DataFrame, label: str) -> DataFrame:
    """(``label``, text) of the documents in ``picked`` (doc_id, ``label``; few
    rows): one text per id, of a repeated id the one with the smallest hash."""
    return (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id", label).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
            .select(label, F.col("t.text").alias("text")))


def free_name(columns: list[str], base: str) -> str:
    """A column name close to ``base`` that no existing column has."""
    taken, name = {c.lower() for c in columns}, base
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text (unsigned); a null id counts as ''."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def held_out(modulus: int, fold: int = 2, doc_id: str = "doc_id") -> Column:
    """The fixed held-out fold: crc32(doc_id as text) mod ``modulus`` = ``fold``."""
    return crc_of_id(doc_id) % F.lit(modulus) == F.lit(fold)
