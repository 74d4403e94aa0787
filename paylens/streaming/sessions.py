"""X3, event time: play sessions of a stream, with late rows kept and merged.

A play session is a run of a player's events with gaps of at most
``gap_minutes`` (Spark's ``session_window``). Each micro-batch is cut by the
watermark, the newest event time of all earlier batches less
``delay_minutes``:

* rows at or after it become session pieces, one ``session_window``
  aggregate per (player, day), so a player who owns a third of all events is
  split by day and aggregated before the pieces meet;
* rows behind it are written to a late table, not dropped: sessions that end
  before the watermark are already handed out as closed.

``on_time_sessions`` is what a consumer sees at once (``closed`` marks those
that no on-time row can change); ``sessions`` merges the late rows in and
says how many each session got, so the result equals the batch over all
events, whatever their order, delay, repeats and replays. Pieces of a
player that touch or overlap merge in a window over pieces, of which a day
holds at most its length over the gap.

Rows without a time or a player belong to no session. Every
``compact_every`` batches the pieces are folded into merged sessions.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.functions.exact import MONEY
from paylens.session import ensure_checkpoint_dir
from paylens.streaming.incremental import EVENT_SCHEMA, BatchTable, StreamSettings, available_now, ledger_of, new_rows

PIECE_SCHEMA = ("player_id bigint, session_start timestamp_ntz, session_end timestamp_ntz, events bigint, "
                "amount decimal(38,2), late_events bigint")
LATE_SCHEMA = "event_id bigint, user_id bigint, ts timestamp_ntz, value double"


@dataclass(frozen=True)
class SessionSettings(StreamSettings):
    gap_minutes: int = 30
    delay_minutes: int = 60


def pieces(events: DataFrame, s: SessionSettings, late: bool = False) -> DataFrame:
    """Session pieces of (unique) events: one aggregate per player, day and session window."""
    timed = events.filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
    windowed = timed.groupBy(F.col("user_id").alias("player_id"), F.to_date("ts").alias("day"),
                             F.session_window("ts", f"{s.gap_minutes} minutes").alias("w"))
    made = windowed.agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).cast(MONEY).alias("amount"))
    return made.select("player_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events", "amount",
                       (F.col("events") if late else F.lit(0)).cast("bigint").alias("late_events"))


def merged(parts: DataFrame) -> DataFrame:
    """Pieces of a player that touch or overlap as one session."""
    in_order = Window.partitionBy("player_id").orderBy("session_start", "session_end")
    reach = F.max("session_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col("session_start") > reach)).cast("int")
    number = F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (parts.withColumn("fresh", fresh).withColumn("number", number).groupBy("player_id", "number")
            .agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
                 F.sum("events").alias("events"), F.sum("amount").cast(MONEY).alias("amount"),
                 F.sum("late_events").alias("late_events")).drop("number"))


@dataclass
class SessionTables:
    pieces: BatchTable
    late: BatchTable
    marks: BatchTable

    @classmethod
    def at(cls, spark: SparkSession, sink: str) -> "SessionTables":
        return cls(BatchTable(spark, os.path.join(sink, "pieces"), PIECE_SCHEMA),
                   BatchTable(spark, os.path.join(sink, "late"), LATE_SCHEMA),
                   BatchTable(spark, os.path.join(sink, "marks"), "newest timestamp_ntz"))


def newest(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("newest").alias("newest"))


def _watermark(marks: DataFrame, s: SessionSettings):
    """The newest event time less the delay (one value), null before the first batch."""
    return newest(marks).select(F.col("newest") - F.expr(f"INTERVAL {s.delay_minutes} MINUTES")).scalar()


def batch_writer(sink: str, s: SessionSettings = SessionSettings()):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger, t = ledger_of(spark, sink), SessionTables.at(spark, sink)
        if ledger.holds(batch_id):
            return
        if batch_id and batch_id % s.compact_every == 0:
            t.pieces.fold(batch_id - 1, merged)
            t.late.fold(batch_id - 1)
            t.marks.fold(batch_id - 1, newest)
            ledger.fold(batch_id - 1, partition_by=("day",))
        new = new_rows(batch.withColumn("day", F.to_date("ts")), ledger, batch_id).persist()
        behind = F.coalesce(F.col("ts") < _watermark(t.marks.read(before=batch_id), s), F.lit(False))
        t.pieces.write(pieces(new.filter(~behind), s), batch_id)
        t.late.write(new.filter(behind).select("event_id", "user_id", "ts", "value"), batch_id)
        t.marks.write(batch.agg(F.max("ts").alias("newest")), batch_id)
        ledger.write(new.filter("event_id IS NOT NULL").select("event_id", "day"), batch_id, ("day",))
        new.unpersist()
    return write


def on_time_sessions(spark: SparkSession, sink: str, s: SessionSettings = SessionSettings()) -> DataFrame:
    """Sessions of the rows that were on time; ``closed``: they end before the watermark."""
    t = SessionTables.at(spark, sink)
    closed = F.coalesce(F.col("session_end") < _watermark(t.marks.read(), s), F.lit(False))
    return merged(t.pieces.read()).drop("late_events").withColumn("closed", closed)


def sessions(spark: SparkSession, sink: str, s: SessionSettings = SessionSettings()) -> DataFrame:
    """All sessions with the late rows merged in, and how many of their events were late."""
    t = SessionTables.at(spark, sink)
    return merged(t.pieces.read().unionByName(pieces(t.late.read(), s, late=True)))


def run_to_completion(spark: SparkSession, source: str, s: SessionSettings = SessionSettings(), root: str | None = None,
                      max_files: int | None = None) -> DataFrame:
    """Stream every event under ``source`` and return its play sessions."""
    base = root or os.path.join(ensure_checkpoint_dir(spark), f"paylens-sessions-{uuid.uuid4().hex}")
    sink = os.path.join(base, "sink")
    available_now(spark, source, EVENT_SCHEMA, batch_writer(sink, s), os.path.join(base, "state"), s, max_files)
    return sessions(spark, sink, s)
