"""X3, features that a retraction can lower: signed multisets of a change feed.

The input is a feed of changes: ``insert`` adds a row, ``retract`` takes one
back (its whole image travels with the change, as change feeds deliver it).
A latest survey (F2), a modal game (F5) and completed purchases with their
first day (F9) are not sums: when the newest survey is taken back the one
before it counts again, a refund may move the first purchase later.

So the state is not the feature but the multiset below it, one signed count
per (player, value):

* games: (player, game type) -> sessions, staked;
* surveys: (player, time, id, answer) -> times;
* buys: (player, time, price) -> times.

Signed counts add up in any order, so each micro-batch writes only its own
sums, a replayed batch overwrites itself, and folds add batches. A
retraction that comes before its row stands as a count of -1 until the row
arrives; values that cancel leave the tables at the next fold. Repeated
deliveries are recognised by ``change_id`` in a ledger by day, as in
:mod:`paylens.streaming.incremental`.

``current_profile`` reads the features off the multisets: partial aggregates
over values with a positive count, so a player with a third of all changes
costs one row per value and map task.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.exact import MONEY
from paylens.session import ensure_checkpoint_dir
from paylens.sources import files
from paylens.sources.tables import Tables
from paylens.streaming.incremental import BatchTable, StreamSettings, available_now, ledger_of, new_rows

CHANGE_SCHEMA = ("change_id bigint, op string, day date, kind string, player_id bigint, at timestamp_ntz, value_id bigint, "
                 "value string, amount decimal(18,2)")
GAME, SURVEY, BUY = "game", "survey", "buy"
KEYS = {GAME: ("player_id", "value"), SURVEY: ("player_id", "at", "value_id", "value"), BUY: ("player_id", "at", "amount")}
SCHEMAS = {GAME: "player_id bigint, value string, n bigint, staked decimal(38,2)",
           SURVEY: "player_id bigint, at timestamp_ntz, value_id bigint, value string, n bigint",
           BUY: "player_id bigint, at timestamp_ntz, amount decimal(18,2), n bigint"}


def _measures(kind: str) -> list[str]:
    return ["n", "staked"] if kind == GAME else ["n"]


def added(deltas: DataFrame, kind: str) -> DataFrame:
    """Deltas of one multiset added up; values that cancel are gone."""
    total = deltas.groupBy(*KEYS[kind]).agg(F.sum("n").alias("n"), *[F.sum(c).cast(MONEY).alias(c) for c in _measures(kind)[1:]])
    live = F.col("n") != 0
    for c in _measures(kind)[1:]:
        live = live | (F.col(c) != 0)
    return total.filter(live)


def signed(changes: DataFrame, kind: str) -> DataFrame:
    """One batch's changes as deltas of one multiset."""
    sign = (F.when(F.col("op") == "insert", 1).when(F.col("op") == "retract", -1)
            .otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce("op", F.lit("null"))))))
    rows = changes.filter(F.col("kind") == kind).withColumn("n", sign.cast("bigint"))
    if kind == GAME:
        rows = rows.withColumn("staked", (F.coalesce("amount", F.lit(0)) * F.col("n")).cast(MONEY))
    return added(rows, kind).select(*KEYS[kind], *_measures(kind))


def _tables(spark: SparkSession, sink: str) -> dict[str, BatchTable]:
    return {kind: BatchTable(spark, os.path.join(sink, kind), schema) for kind, schema in SCHEMAS.items()}


def batch_writer(sink: str, s: StreamSettings = StreamSettings()):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger, tables = ledger_of(spark, sink), _tables(spark, sink)
        if ledger.holds(batch_id):
            return
        if batch_id and batch_id % s.compact_every == 0:
            for kind, table in tables.items():
                table.fold(batch_id - 1, lambda rows, kind=kind: added(rows, kind))
            ledger.fold(batch_id - 1, partition_by=("day",))
        new = new_rows(batch.withColumnRenamed("change_id", "event_id"), ledger, batch_id).persist()
        for kind, table in tables.items():
            table.write(signed(new, kind), batch_id)
        ledger.write(new.filter("event_id IS NOT NULL").select("event_id", "day"), batch_id, ("day",))
        new.unpersist()
    return write


def current_profile(spark: SparkSession, sink: str) -> DataFrame:
    """One row per player with a live value: hosted sessions, stakes, modal game,
    latest survey, purchases, their total and the first one's time."""
    live = {kind: added(t.read(), kind).filter("n > 0") for kind, t in _tables(spark, sink).items()}
    ranked = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("value").alias("g")))
    games = live[GAME].groupBy("player_id").agg(
        F.sum("n").alias("n_games_hosted"), F.sum("staked").cast(MONEY).alias("pcoins_wagered"), F.min(ranked)["g"].alias("fav_game"))
    newest = F.struct(F.col("at").isNull(), F.col("at"), F.col("value_id"))
    surveys = live[SURVEY].groupBy("player_id").agg(F.max_by(F.struct("value_id", "value"), newest).alias("s")).select(
        "player_id", F.col("s.value_id").alias("survey_id"), F.col("s.value").alias("responses"))
    buys = live[BUY].groupBy("player_id").agg(
        F.sum("n").alias("n_purchases"), F.sum(F.col("amount") * F.col("n")).cast(MONEY).alias("pcoin_usd"),
        F.min("at").alias("first_buy"))
    return games.join(surveys, "player_id", "full").join(buys, "player_id", "full")


def change_feed(t: Tables, min_value: float = 150.0) -> DataFrame:
    """The test tables as a change feed: every event is a hosted session, a view
    also a survey answer, a purchase over ``min_value`` also a purchase; an
    ``error`` event takes back all that the event before it (by id) inserted."""
    ev = t("events").select("event_id", "user_id", "event_type", "ts", "props", F.col("value").cast("decimal(18,2)").alias("amount"))
    undone = ev.filter(F.col("event_type") == "error").select((F.col("event_id") - 1).alias("event_id"), F.lit(True).alias("undone"))
    rows = ev.join(undone, "event_id", "left")
    ops = F.explode(F.when(F.col("undone"), F.array(F.lit("insert"), F.lit("retract"))).otherwise(F.array(F.lit("insert"))))
    kinds = F.filter(F.array(F.lit(GAME), F.when(F.col("event_type") == "view", F.lit(SURVEY)),
                             F.when((F.col("event_type") == "purchase") & (F.col("amount") >= min_value), F.lit(BUY))),
                     lambda k: k.isNotNull())
    rows = rows.withColumn("op", ops).withColumn("kind", F.explode(kinds))
    number = F.col("event_id") * 8 + F.when(F.col("kind") == GAME, 0).when(F.col("kind") == SURVEY, 1).otherwise(2) \
        + F.when(F.col("op") == "retract", 4).otherwise(0)
    return rows.select(number.alias("change_id"), "op", F.to_date("ts").alias("day"), "kind", F.col("user_id").alias("player_id"),
                       F.col("ts").alias("at"), F.col("event_id").alias("value_id"),
                       F.when(F.col("kind") == GAME, F.col("event_type")).when(F.col("kind") == SURVEY, F.col("props")).alias("value"),
                       "amount")


def run_to_completion(spark: SparkSession, source: str, s: StreamSettings = StreamSettings(), root: str | None = None,
                      max_files: int | None = None) -> DataFrame:
    """Stream every file of changes under ``source`` and return the profiles."""
    base = root or os.path.join(ensure_checkpoint_dir(spark), f"paylens-profile-{uuid.uuid4().hex}")
    sink = os.path.join(base, "sink")
    available_now(spark, source, CHANGE_SCHEMA, batch_writer(sink, s), os.path.join(base, "state"), s, max_files)
    return current_profile(spark, sink)


def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of the test tables, written as files and streamed."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"paylens-profile-{uuid.uuid4().hex}")
    feed = os.path.join(base, "feed")
    change_feed(Tables(spark, sf_dir)).write.parquet(feed)
    out = run_to_completion(spark, feed, root=base)
    files.delete(spark, feed)
    return out
