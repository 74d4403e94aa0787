"""Sharding along a Hilbert curve over quantised metadata.

Each dimension is quantised into at most 2^bits cells of equal depth (the
cell starts are exact quantiles of the value counts, computed distributed;
only the cell starts, at most 2^bits values, reach the driver). Rows are
sorted by the Hilbert index of their cells, ties by id, checksum and size,
and the order is cut into ``shards`` runs of near-equal bytes, so a shard
(and a file inside it) covers a compact box of every dimension and min/max
statistics prune it by any of them.

Law ``bytes``: the size of a row is its UTF-8 text bytes (null: none) plus
8; a row goes to the shard its middle byte falls in, so every shard is
within one row of total / shards at either end.

Edge cases: a null metadata value shares the first cell; ties of the index
(a source may hold a third of all rows) are split by the id; repeated rows
each get a slot of their own; an empty table gives no rows; extra columns
are ignored by ``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import free_name, materialise
from paylens.session import ensure_checkpoint_dir

SHARDS, BITS, DIMENSIONS = 24, 6, ("source", "lang", "size")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cells (n x dimensions,
    0 <= cell < 2^bits); the transform of Skilling (2004), on whole columns."""
    x = [c.astype(np.int64) for c in np.asarray(cells).T]
    for b in range(bits - 1, 0, -1):             # undo the excess work of Gray code, plane by plane
        plane, low = 1 << b, (1 << b) - 1
        for i in range(len(x)):
            up = (x[i] & plane) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where(x[-1] & (1 << b), turn ^ ((1 << b) - 1), turn)
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | (((c ^ turn) >> b) & 1)
    return out


def running(df: DataFrame, order: list[str], weight: str) -> tuple[DataFrame, int]:
    """Add ``before`` (the weights of all earlier rows) and ``position`` in the
    global order; also return the total weight.

    Rows are range-partitioned and checkpointed, since range bounds are
    sampled and both passes must see the same partitions. Only one sum and
    one count per partition reach the driver.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    parts = ranged.groupBy(F.spark_partition_id().alias("p")).agg(
        F.sum(weight).alias("w"), F.count("*").alias("n")).orderBy("p").collect()
    starts, total, rows = {}, 0, 0
    for p in parts:
        starts[p["p"]] = (total, rows)
        total, rows = total + p["w"], rows + p["n"]

    def run(batches):
        at, row = starts.get(TaskContext.get().partitionId(), (0, 0))
        for batch in batches:
            w = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = at + np.cumsum(w)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums - w), pa.array(row + np.arange(len(w)))],
                                             [*batch.schema.names, "before", "position"])
            at, row = int(sums[-1]) if len(w) else at, row + len(w)
    schema = T.StructType([*ranged.schema, T.StructField("before", T.LongType()), T.StructField("position", T.LongType())])
    return ranged.mapInArrow(run, schema), total


def cell_starts(values: DataFrame, column: str, bits: int) -> list:
    """The smallest value of each equal-depth cell (at most 2^bits values)."""
    counts = values.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed, total = running(counts, ["v"], "n")
    if not total:
        return []
    cell = F.floor(F.col("before") * F.lit(1 << bits) / F.lit(total))
    return sorted(r["v"] for r in placed.groupBy(cell).agg(F.min("v").alias("v")).collect())


def _cell(value, starts: list):
    """Number of the last cell that starts at or below a value (null: 0)."""
    if not starts:
        return F.lit(0)
    below = F.array_size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= value))
    return F.coalesce(F.greatest(below - 1, F.lit(0)), F.lit(0))


def _ordered(docs: DataFrame, dimensions, shards: int, bits: int, with_rows: bool) -> tuple[DataFrame, DataFrame]:
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(body) + 8).cast("long")
    base = docs.select(
        F.col("doc_id").alias("id"), size.alias("size"), F.crc32(body).alias("crc"),
        *[(size if d == "size" else F.col(f"`{d}`")).alias(f"d{i}") for i, d in enumerate(dimensions)],
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_rows else []))
    base = materialise(base, "hilbert-base")
    cells = []
    for i in range(len(dimensions)):
        starts = cell_starts(base, f"d{i}", bits)
        cells.append(_cell(F.col(f"d{i}"), starts))
    keep = [c for c in base.columns if not (c.startswith("d") and c[1:].isdigit())]
    placed = base.select(*keep, F.array(*cells).alias("cells"))

    def curve(batches):
        for batch in batches:
            cells = batch.column("cells").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(dimensions))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hilbert_index(cells, bits))],
                                             [*keep, "curve"])
    schema = T.StructType([*base.select(keep).schema, T.StructField("curve", T.LongType())])
    ranked, total = running(placed.mapInArrow(curve, schema), ["curve", "id", "crc", "size"], "size")
    cut = F.least(F.lit(shards - 1), F.expr(f"(2 * before + size) * {shards} div {2 * max(total, 1)}")).cast("int")
    ranked = ranked.withColumn("shard", cut)
    firsts = ranked.groupBy("shard").agg(F.min("position").alias("first"))  # one row per shard
    return ranked, firsts


def assign(docs: DataFrame, dimensions=DIMENSIONS, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve."""
    ranked, firsts = _ordered(docs, dimensions, shards, bits, False)
    return ranked.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, dimensions=DIMENSIONS, shards: int = SHARDS, bits: int = BITS) -> None:
    """Write whole rows as Parquet under ``path/shard=N`` (``_shard`` if ``docs`` has a shard column); each file is one run of the curve."""
    ranked, _ = _ordered(docs, dimensions, shards, bits, True)
    name = free_name(docs.columns, "shard")
    (ranked.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("shard").alias(name))
     .write.partitionBy(name).parquet(path))
