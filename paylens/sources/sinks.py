"""Materialisation and serialisation.

Only the store (one row per player) is written in parallel; the insights
document and model report are aggregates of a few hundred bytes and are one
file each. The personal-data gate runs inside the write (``publish``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.operators.quality import gated
from paylens.sources import files


def write_store(store: DataFrame, path: str, partition_by: str | None = None) -> None:
    """The store (with its score) as a new Parquet version; no in-place update."""
    w = store.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def replace_tenants(store: DataFrame, path: str, tenant: str) -> None:
    """S3 by tenant: rewrite the folders of the tenants in ``store``, leave the others as they are."""
    store.write.mode("overwrite").partitionBy(tenant).option("partitionOverwriteMode", "dynamic").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """S3/S4 as a table bucketed and sorted by ``key``, one file a bucket; returned as read back.

    Tables with the same buckets join and group on the key without an
    exchange, however often they are used. ``buckets``: as many as shuffle
    partitions unless given (a table of T bytes wants about T / 128 MB)."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def export_csv(matrix: DataFrame, path: str) -> None:
    """Feature matrix with header (booleans already 0/1)."""
    matrix.write.mode("overwrite").option("header", True).csv(path)


def write_document(doc: DataFrame, path: str) -> None:
    """One small JSON document as one file."""
    publish({path: doc})


def publish(documents: dict[str, DataFrame]) -> None:
    """Write documents and publish all of them, or none.

    Each is written once, to a staging folder beside the published one, and the write
    itself counts the values shaped like personal data. Only if none of the
    documents holds any are they renamed into place: a one-column text
    document becomes a file of that name, other rows a folder of JSON lines.
    """
    staged, checks = {}, []
    try:
        for path, doc in documents.items():
            staged[path] = f"{os.path.dirname(path)}.staging-{uuid.uuid4().hex}"
            rows, check = gated(doc.coalesce(1), os.path.basename(path))
            checks.append(check)
            w = rows.write.mode("overwrite")
            w.text(staged[path]) if _is_text(doc) else w.json(staged[path])
        for check in checks:
            check()
        for path, doc in documents.items():
            spark, at = doc.sparkSession, staged[path]
            part = next((n for n in files.children(spark, at) if n.startswith("part-")), None)
            if _is_text(doc) and part:
                files.move(spark, f"{at}/{part}", path)
            else:
                files.move(spark, at, path)
    finally:
        for path, at in staged.items():
            files.delete(documents[path].sparkSession, at)


def _is_text(doc: DataFrame) -> bool:
    return len(doc.columns) == 1 and isinstance(doc.schema[0].dataType, T.StringType)


def model_report_document(evaluation: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Evaluation row + ordered coefficients as one JSON object."""
    ordered = coefficients.withColumn("_pos", F.monotonically_increasing_id())
    key = F.struct(F.col("_pos").alias("k"))
    row = F.struct("feature", "coef", "odds_per_sd")
    arr = ordered.agg(F.transform(F.sort_array(F.collect_list(F.struct(key.alias("o"), row.alias("r")))),
                                       lambda x: x["r"]).alias("c"))
    c_json = arr.select(F.to_json("c")).scalar()
    return evaluation.select(F.concat(F.expr("substring(to_json(struct(*)), 1, length(to_json(struct(*))) - 1)"),
                                      F.lit(',"coefficients_by_importance":'), c_json, F.lit("}")).alias("value"))
