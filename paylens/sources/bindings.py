"""Role bindings: the driver's tables playing the monetization source roles.

The production source has ``player``, ``survey_response``, ``player_room``,
``room``, ``game_session``, ``pet_feeding``, ``arcade_score``,
``pcoin_transaction`` and ``prime_subscription_event``. The test tables are
a TPC-H-like star plus an event stream, so each role is derived from them
by a deterministic, SQL-expressible rule (the oracle repeats each rule in
DuckDB). Rules are listed in FIXTURES.md section 3. Every rule reads whole
tables; no row is dropped to make anything cheaper. The modulo rules below
synthesise attributes the test data lacks (a soft-delete flag, an inviter,
a room manager), they do not select rows for speed.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.sources.tables import Tables

ROLES = ("player", "survey_response", "player_room", "room", "game_session",
         "pet_feeding", "arcade_score", "pcoin_transaction", "prime_subscription_event")

# Fixed values of the binding rules (FIXTURES.md section 3).
DELETED_MOD, DELETED_REM = 50, 49
INVITER_MOD, INVITER_DIV = 3, 10
PURCHASE_MIN_PRICE = 400000
AGE_ANSWERS = ("13-17", "18-24", "23-27", "28-35", "35-44", "46+", "")  # k % 8 = 0..6; 7 = absent


KEY_COLUMNS = ("player_id", "invited_by", "manager_id", "host_player_id")


@dataclass
class RoleTables:
    player: DataFrame
    survey_response: DataFrame
    player_room: DataFrame
    room: DataFrame
    game_session: DataFrame
    pet_feeding: DataFrame
    arcade_score: DataFrame
    pcoin_transaction: DataFrame
    prime_subscription_event: DataFrame

    def __post_init__(self):
        """Text ids are compared in lower case: normalise every player key once, here."""
        for name, df in self.as_dict().items():
            lowered = {c: F.lower(F.col(c)) for c in KEY_COLUMNS if c in df.columns
                       and isinstance(df.schema[c].dataType, T.StringType)}
            if lowered:
                setattr(self, name, df.withColumns(lowered))

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def _k(props):
    return F.get_json_object(props, "$.k").cast("int")


def bind_player(t: Tables) -> DataFrame:
    span = (t("orders").groupBy(F.col("o_custkey").alias("player_id"))
            .agg(F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("last_seen")))
    # distinct (player, day) first: the set-building aggregate then sees one
    # row per active day instead of one per event
    logins = (t("events").select(F.col("user_id").alias("player_id"), F.to_date("ts").alias("d"))
              .distinct().groupBy("player_id").agg(F.collect_list("d").alias("login_dates")))
    key = F.col("c_custkey")
    cust = (t("customer")
            .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(key.alias("player_id"),
                    F.col("n_name").alias("country_code"),
                    F.lit(None).cast("string").alias("gender"),
                    F.lit(None).cast("string").alias("language"),
                    F.col("c_mktsegment").alias("acquisition_source"),
                    F.when((key % INVITER_MOD == 0) & (key > 0),
                           F.call_function("div", key, F.lit(INVITER_DIV))).alias("invited_by"),
                    (key % DELETED_MOD == DELETED_REM).alias("is_deleted"),
                    F.col("c_acctbal").alias("pcoins"),
                    F.lit(0.0).alias("coins")))
    return (cust.join(span, "player_id", "left").join(logins, "player_id", "left")
            .select("player_id", "created_at", "last_seen", "country_code", "gender", "language",
                    "acquisition_source", "invited_by", "is_deleted", "pcoins", "coins",
                    "login_dates"))


def bind_survey_response(t: Tables) -> DataFrame:
    # k is parsed once in its own projection (an expensive expression used
    # many times is not collapsed into its consumers)
    ev = t("events").filter(F.col("event_type") == "view").withColumn("_k", _k(F.col("props")))
    k = F.col("_k")
    age = F.when(k % 8 < 7, F.element_at(F.array(*[F.lit(a) for a in AGE_ANSWERS]), (k % 8 + 1).cast("int")))
    bought_window = (k >= 80) & (k < 90)
    would = (F.when(k < 40, F.array(F.lit("nothing")))
             .when(k < 60, F.array().cast("array<string>"))
             .when(k < 80, F.array(F.lit("hat"))))
    responses = F.to_json(F.struct(
        age.alias("ageRange"),
        F.when(k >= 90, F.lit("fair")).alias("priceFeeling"),
        would.alias("wouldPayFor"),
        F.when(bought_window, F.lit("")).alias("boughtPcoins"),
        F.when(bought_window, F.lit("considering")).alias("paymentStatus"),
        F.when(k % 10 == 0, F.lit("maybe")).alias("halfOffWouldTry"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("r"), (k % 7).cast("string")))
        .alias("neverBoughtReason")))
    return ev.select(F.col("event_id").alias("survey_id"), F.col("user_id").alias("player_id"),
                     F.col("ts").alias("created_at"), responses.alias("responses"))


def bind_player_room(t: Tables) -> DataFrame:
    """One room per active user; streak = longest run of consecutive event days.

    The per-player window runs over distinct (player, day) pairs, so its
    size is bounded by the calendar span, not by how many events a (hot)
    player produces.
    """
    days = t("events").select(F.col("user_id").alias("player_id"), F.to_date("ts").alias("d")).distinct()
    run_key = F.unix_date("d") - F.row_number().over(Window.partitionBy("player_id").orderBy("d"))
    runs = (days.withColumn("run", run_key).groupBy("player_id", "run").agg(F.count("*").alias("len")))
    return runs.groupBy("player_id").agg(F.max("len").cast("int").alias("current_streak"))


def bind_room(t: Tables) -> DataFrame:
    n_players = t("customer").select(F.count("*")).scalar()
    docs = t("documents")
    return docs.select(
        (F.col("doc_id") % n_players).alias("manager_id"),
        F.split(F.col("text"), "\n").alias("furniture_objects"),
        F.when(F.col("lang") == "en", F.create_map(F.lit("outfit"), F.col("source"))).alias("wardrobe_items"))


def bind_game_session(t: Tables) -> DataFrame:
    ev = t("events").withColumn("_k", _k(F.col("props")))
    k = F.col("_k")
    host = F.col("user_id")
    guest = host + k + 1
    bet = F.col("value").cast("decimal(18,2)")
    return ev.select(
        F.col("event_id").alias("session_id"),
        host.alias("host_player_id"),
        F.col("event_type").alias("game_type"),
        bet.alias("bet_amount"),
        (bet * 2).cast("decimal(18,2)").alias("total_pot"),
        F.array(host, guest).alias("participants"),
        F.when(k % 2 == 0, F.array(host)).otherwise(F.array(guest)).alias("winner_ids"),
        F.col("ts").alias("created_at"))


def _events_of(t: Tables, kind: str) -> DataFrame:
    return (t("events").filter(F.col("event_type") == kind)
            .select(F.col("user_id").alias("player_id"), F.col("ts").alias("created_at")))


def bind_pcoin_transaction(t: Tables) -> DataFrame:
    o = t("orders")
    completed = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= PURCHASE_MIN_PRICE)
    return o.select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_custkey").alias("player_id"),
        F.col("o_orderpriority").alias("product_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.when(completed, F.lit("completed")).otherwise(F.lit("other")).alias("status"),
        F.col("o_orderdate").alias("created_at"))


def bind_prime_subscription_event(t: Tables) -> DataFrame:
    o = t("orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
                           & (F.col("o_totalprice") >= PURCHASE_MIN_PRICE))
    return o.select(F.col("o_custkey").alias("player_id"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
                    F.lit("RENEWAL").alias("event_type"),
                    F.col("o_orderdate").alias("created_at"))


def bind_fixture_tables(t: Tables) -> RoleTables:
    return RoleTables(
        player=bind_player(t),
        survey_response=bind_survey_response(t),
        player_room=bind_player_room(t),
        room=bind_room(t),
        game_session=bind_game_session(t),
        pet_feeding=_events_of(t, "click"),
        arcade_score=_events_of(t, "error"),
        pcoin_transaction=bind_pcoin_transaction(t),
        prime_subscription_event=bind_prime_subscription_event(t),
    )


def bind_event_purchases(t: Tables, min_value: float = 150.0) -> DataFrame:
    """Purchases taken from the event stream (same time range as wagers).

    Used by the wager-before-purchase check (X1) and the streaming job (X3):
    event_type='purchase', price=value, completed when value >= ``min_value``.
    """
    ev = t("events").filter(F.col("event_type") == "purchase")
    return ev.select(
        F.col("event_id").alias("tx_id"), F.col("user_id").alias("player_id"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        F.when(F.col("value") >= min_value, F.lit("completed")).otherwise(F.lit("other")).alias("status"),
        F.col("ts").alias("created_at"))
