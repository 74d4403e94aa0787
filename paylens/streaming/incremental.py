"""Incremental per-player activity features on Structured Streaming.

The file source hands over new event files in micro-batches
(``maxBytesPerTrigger`` bounds each one). ``foreachBatch`` then

1. drops repeated event ids inside the batch and, by an anti-join, those of
   earlier batches: a ledger of (event id, day) is kept on disk, and only
   the days that occur in the batch are read back (a redelivered event keeps
   its own time);
2. writes the batch's new ids and its per-player aggregate, each into its
   own ``batch_id=`` folder (overwritten when a batch is replayed).

Count, sum, min and max are mergeable, so the current table is one
partially aggregated group-by over the deltas. No watermark decides what
counts: events in any order and any delay are all counted once, and no
state grows in memory. Every ``compact_every`` batches, all batches before
the running one (they are committed) are folded into a base, so neither
table grows in files or in rows beyond its distinct keys. A batch may run
again at any point, also in the middle of its folds: a fold that is complete
is not repeated, and a folder that readers use is never written.

Events without an id cannot be recognised as repeats; each of them counts.
Features that a retraction can lower (modal game, latest survey, refunded
purchases) are kept by :mod:`paylens.streaming.profile`.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.exact import MONEY
from paylens.session import ensure_checkpoint_dir
from paylens.sources import files

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")
ACTIVITY_SCHEMA = ("user_id bigint, events bigint, purchases bigint, purchase_usd decimal(38,2), "
                   "first_purchase timestamp_ntz, last_purchase timestamp_ntz, wagers bigint, wagered decimal(38,2)")
LEDGER_SCHEMA = "event_id bigint, day date"


@dataclass(frozen=True)
class StreamSettings:
    purchase_type: str = "purchase"
    min_purchase_value: float = 150.0
    max_bytes_per_trigger: int = 16 << 30
    compact_every: int = 50


def unique_events(events: DataFrame) -> DataFrame:
    """One row per event id; rows without an id stay."""
    known = events.filter(F.col("event_id").isNotNull()).dropDuplicates(["event_id"])
    return known.unionByName(events.filter(F.col("event_id").isNull()))


def activity(events: DataFrame, s: StreamSettings = StreamSettings()) -> DataFrame:
    """Per-player aggregate of (unique) events."""
    is_purchase = F.col("event_type") == s.purchase_type
    bought = is_purchase & (F.col("value") >= s.min_purchase_value)
    amount = F.col("value").cast("decimal(18,2)")
    return events.groupBy("user_id").agg(
        F.count("*").alias("events"),
        F.count(F.when(bought, 1)).alias("purchases"),
        F.sum(F.when(bought, amount)).cast(MONEY).alias("purchase_usd"),
        F.min(F.when(bought, F.col("ts"))).alias("first_purchase"),
        F.max(F.when(bought, F.col("ts"))).alias("last_purchase"),
        F.count(F.when(~is_purchase, 1)).alias("wagers"),
        F.sum(F.when(~is_purchase, amount)).cast(MONEY).alias("wagered"))


def merge(deltas: DataFrame) -> DataFrame:
    """Per-player rows of several deltas as one."""
    total = lambda c: F.sum(c).alias(c)
    money = lambda c: F.sum(c).cast(MONEY).alias(c)
    return deltas.groupBy("user_id").agg(
        total("events"), total("purchases"), money("purchase_usd"), F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"), total("wagers"), money("wagered"))


class BatchTable:
    """Rows by micro-batch under one folder, with a base of folded batches.

    ``base/upto=N`` holds all batches up to N; readers take the newest base
    that was written completely and the batches after it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _complete(self, folder: str, prefix: str) -> list[int]:
        at = os.path.join(self.path, folder)
        return sorted(int(n[len(prefix):]) for n in files.children(self.spark, at) if n.startswith(prefix)
                      and files.exists(self.spark, os.path.join(at, n, "_SUCCESS")))

    def _upto(self) -> int:
        return max(self._complete("base", "upto="), default=-1)

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, or those of batches before ``before``."""
        upto = self._upto()
        paths = [os.path.join(self.path, "base", f"upto={upto}")] if upto >= 0 else []
        paths += [os.path.join(self.path, "batches", f"batch_id={n}") for n in self._complete("batches", "batch_id=")
                  if n > upto and (before is None or n < before)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        out = self.spark.read.schema(self.schema).parquet(paths[0])
        for p in paths[1:]:
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(p))
        return out

    def write(self, rows: DataFrame, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(
            os.path.join(self.path, "batches", f"batch_id={batch_id}"))

    def holds(self, batch_id: int) -> bool:
        """Whether the batch is already part of the base."""
        return self._upto() >= batch_id

    def fold(self, upto: int, merged: Callable[[DataFrame], DataFrame] = lambda rows: rows,
             partition_by: tuple[str, ...] = ()) -> None:
        """Make ``merged`` of all batches up to ``upto`` the base, then drop what it
        replaces. Run again after a crash, it goes on where it stopped."""
        if not self.holds(upto):  # an incomplete upto= folder is read by nobody and overwritten
            merged(self.read(before=upto + 1)).write.mode("overwrite").partitionBy(*partition_by).parquet(
                os.path.join(self.path, "base", f"upto={upto}"))
        for folder, prefix, last in (("batches", "batch_id=", upto), ("base", "upto=", upto - 1)):
            at = os.path.join(self.path, folder)
            for n in files.children(self.spark, at):
                if n.startswith(prefix) and int(n[len(prefix):]) <= last:
                    files.delete(self.spark, os.path.join(at, n))


def ledger_of(spark: SparkSession, sink: str) -> BatchTable:
    """(event id, day) of every row that counted."""
    return BatchTable(spark, os.path.join(sink, "ledger"), LEDGER_SCHEMA)


def _tables(spark: SparkSession, sink: str) -> tuple[BatchTable, BatchTable]:
    return (ledger_of(spark, sink),
            BatchTable(spark, os.path.join(sink, "activity"), ACTIVITY_SCHEMA))


def _batch_writer(sink: str, s: StreamSettings):
    def write(batch: DataFrame, batch_id: int) -> None:
        ledger, deltas = _tables(batch.sparkSession, sink)
        if ledger.holds(batch_id):
            return
        if batch_id and batch_id % s.compact_every == 0:  # earlier batches are committed
            deltas.fold(batch_id - 1, merge)
            ledger.fold(batch_id - 1, partition_by=("day",))
        new = new_rows(batch.withColumn("day", F.to_date("ts")), ledger, batch_id).persist()
        deltas.write(activity(new, s), batch_id)
        ledger.write(new.filter("event_id IS NOT NULL").select("event_id", "day"), batch_id, ("day",))
        new.unpersist()
    return write


def new_rows(batch: DataFrame, ledger: BatchTable, batch_id: int) -> DataFrame:
    """The batch's rows (event_id, day, ...) that neither it nor an earlier batch had before."""
    rows = unique_events(batch)
    days = [r["day"] for r in batch.select("day").distinct().collect()]  # calendar days in the batch
    on_day = F.col("day").isNull() | F.col("day").isin([d for d in days if d is not None])
    return rows.join(ledger.read(before=batch_id).filter(on_day).select("event_id"), "event_id", "left_anti")


def event_stream(spark: SparkSession, source: str, schema: str, s: StreamSettings, max_files: int | None = None) -> DataFrame:
    """Files of ``source`` (a folder that receives files, or one file) as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", s.max_bytes_per_trigger)
    if not files.is_folder(spark, source):
        folder, name = os.path.split(source.rstrip("/"))
        reader, source = reader.option("pathGlobFilter", name), folder
    return reader.parquet(source)


def start(spark: SparkSession, source: str, sink: str, checkpoint: str,
          s: StreamSettings = StreamSettings(), available_now: bool = True, max_files: int | None = None):
    """``source``: a folder that receives event files, or one event file."""
    w = (event_stream(spark, source, EVENT_SCHEMA, s, max_files).writeStream.foreachBatch(_batch_writer(sink, s))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def available_now(spark: SparkSession, source: str, schema: str, write, checkpoint: str, s: StreamSettings = StreamSettings(),
                  max_files: int | None = None) -> None:
    """Hand everything under ``source`` to ``write`` in micro-batches and wait for the end."""
    q = (event_stream(spark, source, schema, s, max_files).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def current_table(spark: SparkSession, sink: str) -> DataFrame:
    """One row per player over all written micro-batches."""
    return merge(_tables(spark, sink)[1].read())


def run_to_completion(spark: SparkSession, source: str, s: StreamSettings = StreamSettings(),
                      root: str | None = None, max_files: int | None = None) -> DataFrame:
    """Process everything available under ``source`` and return the current table."""
    base = root or os.path.join(ensure_checkpoint_dir(spark), f"paylens-stream-{uuid.uuid4().hex}")
    sink = os.path.join(base, "sink")
    available_now(spark, source, EVENT_SCHEMA, _batch_writer(sink, s), os.path.join(base, "state"), s, max_files)
    return current_table(spark, sink)
