"""The per-player feature store.

Every source is collapsed to one row per player with a partially
aggregated ``groupBy`` before it meets the player base, so a player who
owns a third of all events costs one row per map task, not one third of
the rows in one reducer. All inputs of the final join are keyed by
``player_id``; the sort-merge joins then reuse one hash partitioning
(AQE broadcasts the sides whose measured size is small). The workspace
gathers the sides in one more aggregate before a single join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.exact import MONEY, round_ratio
from paylens.functions.json import array_len, key_count, object_fields
from paylens.functions.survey import (RESPONSE_FIELDS, age_bucket, blank_to_null,
                                      stated_intent)
from paylens.sources.bindings import RoleTables

DAY_US = 86_400_000_000


def _days_between(start, end):
    return F.timestamp_diff("MICROSECOND", start, end)


def player_base(player: DataFrame) -> DataFrame:
    """live players with demographics, balances, login days, active days."""
    us = _days_between(F.col("created_at"), F.col("last_seen"))
    active = F.greatest(us.cast("double") / F.lit(float(DAY_US)), F.lit(0.0))
    return (player.filter(~F.col("is_deleted"))
            .select("player_id", "created_at", "last_seen", "country_code", "gender", "language",
                    "acquisition_source", F.col("invited_by").alias("invited_by_player_id"),
                    F.coalesce(F.col("pcoins"), F.lit(0)).alias("pcoins_balance"),
                    F.coalesce(F.col("coins"), F.lit(0)).alias("coins_balance"),
                    array_len(F.col("login_dates"), player.schema["login_dates"].dataType)
                    .alias("login_days"),
                    F.coalesce(active, F.lit(0.0)).alias("active_days")))


def _survey_order(survey: DataFrame):
    # Newest first with NULL time first (descending order puts NULL first),
    # then a deterministic tie-break.
    tie = F.col("survey_id") if "survey_id" in survey.columns else F.col("responses")
    return F.struct(F.col("created_at").isNull(), F.col("created_at"), tie)


def latest_survey(survey: DataFrame) -> DataFrame:
    """most recent response per player, parsed once (winners only).

    ``max_by`` keeps one (value, order) pair per group in its partial
    aggregate: a player with a third of all responses costs one row per map
    task, and no group is windowed or collected.
    """
    latest = (survey.groupBy("player_id")
              .agg(F.max_by("responses", _survey_order(survey)).alias("responses")))
    r = object_fields(F.col("responses"), survey.schema["responses"].dataType, RESPONSE_FIELDS)
    parsed = latest.select("player_id", r.alias("r"))
    return parsed.select(
        "player_id",
        F.coalesce(F.col("r.ageRange"), F.col("r.age")).alias("age_raw"),
        blank_to_null(F.col("r.priceFeeling")).alias("price_feeling"),
        F.col("r.wouldPayFor").alias("would_pay_for"),
        F.coalesce(blank_to_null(F.col("r.boughtPcoins")),
                   blank_to_null(F.col("r.paymentStatus"))).alias("pay_state"),
        blank_to_null(F.col("r.halfOffWouldTry")).alias("half_off"))


def room_streak(player_room: DataFrame) -> DataFrame:
    """F3."""
    return player_room.groupBy("player_id").agg(
        F.max("current_streak").alias("max_streak"), F.count("*").alias("n_rooms"))


def owned_items(room: DataFrame) -> DataFrame:
    """items in rooms a player manages (JSON text or typed columns)."""
    fdt = room.schema["furniture_objects"].dataType
    wdt = room.schema["wardrobe_items"].dataType
    return (room.filter(F.col("manager_id").isNotNull())
            .groupBy(F.col("manager_id").alias("player_id"))
            .agg(F.sum(array_len(F.col("furniture_objects"), fdt)).cast("bigint").alias("furniture_cnt"),
                 F.sum(key_count(F.col("wardrobe_items"), wdt)).cast("bigint").alias("wardrobe_cnt")))


def wager_profile(game_session: DataFrame) -> DataFrame:
    """hosted sessions, stakes, modal game (ties -> smallest name).

    Sessions first collapse to (host, game type) counts and stake sums in a
    code-generated hash aggregate (a hot host spreads over its game types);
    the per-host pass then sees a handful of rows per host and picks the
    mode as min(-count, game type). NULL game types count as sessions but
    never as the mode.
    """
    per_type = (game_session.filter(F.col("host_player_id").isNotNull())
                .groupBy(F.col("host_player_id").alias("player_id"), "game_type")
                .agg(F.count("*").alias("n"),
                     F.sum(F.coalesce(F.col("bet_amount"), F.lit(0))).alias("s")))
    ranked = F.when(F.col("game_type").isNotNull(),
                    F.struct((-F.col("n")).alias("neg_n"), F.col("game_type").alias("g")))
    return (per_type.groupBy("player_id")
            .agg(F.sum("n").alias("n_games_hosted"),
                 F.sum("s").cast(MONEY).alias("pcoins_wagered"),
                 F.min(ranked)["g"].alias("fav_game")))


def event_count(events: DataFrame, name: str) -> DataFrame:
    """Events per player."""
    return events.groupBy("player_id").agg(F.count("*").alias(name))


def invite_count(player: DataFrame) -> DataFrame:
    """F8: invitees per inviter (deleted invitees count too)."""
    return (player.filter(F.col("invited_by").isNotNull())
            .groupBy(F.col("invited_by").alias("player_id"))
            .agg(F.count("*").alias("n_invited")))


def purchases(pcoin_transaction: DataFrame) -> DataFrame:
    """completed purchases."""
    return (pcoin_transaction.filter(F.col("status").cast("string") == "completed")
            .groupBy("player_id")
            .agg(F.count("*").alias("n_purchases"),
                 F.sum("price").cast(MONEY).alias("pcoin_total"),
                 F.min("created_at").alias("first_buy")))


# Subscription event types that carry revenue.
PRIME_EVENTS = ("INITIAL_PURCHASE", "RENEWAL")


def prime_revenue(prime_subscription_event: DataFrame) -> DataFrame:
    """F10."""
    return (prime_subscription_event.filter(F.col("event_type").isin(*PRIME_EVENTS))
            .groupBy("player_id").agg(F.sum("price").cast(MONEY).alias("prime_total")))


STORE_COLUMNS = (
    "player_id", "created_at", "last_seen", "active_days", "login_days", "country_code", "gender",
    "language", "acquisition_source", "was_invited", "age_bucket", "surveyed", "price_feeling",
    "pay_state", "half_off", "stated_intent", "max_streak", "n_rooms", "furniture_cnt",
    "wardrobe_cnt", "n_games_hosted", "pcoins_wagered", "fav_game", "n_feedings", "n_arcade",
    "n_invited", "pcoins_balance", "coins_balance", "n_purchases", "pcoin_usd", "prime_usd",
    "lifetime_usd", "is_payer", "is_prime_real", "first_buy_lag_days")


ECONOMY_COLUMNS = ("in_pgs", "pgs_games", "pgs_wagered", "pgs_wins", "pgs_won")


def side_by_side(sides: list[DataFrame]) -> DataFrame:
    """One row per non-null player_id of any side, with the columns of all of them (null where
    a side has no row). Every side has at most one row per player."""
    names = [f"_side{i}" for i in range(len(sides))]
    types = [side.select(F.struct(*[c for c in side.columns if c != "player_id"]).alias("s")).schema["s"].dataType for side in sides]
    rows = [side.filter(F.col("player_id").isNotNull()).select("player_id", *[
        (F.struct(*[c for c in side.columns if c != "player_id"]) if j == i else F.lit(None).cast(types[j])).alias(names[j])
        for j in range(len(sides))]) for i, side in enumerate(sides)]
    met = reduce(DataFrame.unionByName, rows).groupBy("player_id").agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])
    return met.select("player_id", *[F.col(f"{n}.{f.name}") for n, t in zip(names, types) for f in t])


def feature_store(roles: RoleTables, economy: DataFrame | None = None, gathered: bool = False) -> DataFrame:
    """Left-join the per-player aggregates onto the live players.

    The per-player game economy (D0) rides along as a tenth side on the
    same key (``pgs_*`` columns, ``in_pgs`` = the player took part in a
    session), so the payer-DNA cross-tabs are single passes over the store
    instead of a store x economy join each.

    ``gathered``: the sides are first laid side by side in one aggregate and
    then joined at once, so that a task works on one side at a time and its
    memory does not add up over ten sorts and hash tables. A side whose key
    has another type than the players' is joined on its own.
    """
    base = player_base(roles.player)
    if economy is None:
        from paylens.operators.economy import player_game_economy
        economy = player_game_economy(roles.game_session, roles.player.schema["player_id"].dataType)
    econ = economy.select("player_id", F.lit(True).alias("in_pgs"),
                          *[F.col(c).alias(f"pgs_{c}") for c in ("games", "wagered", "wins", "won")])
    sv = latest_survey(roles.survey_response).withColumn("_sv", F.lit(True))
    buys = purchases(roles.pcoin_transaction).withColumn("_bu", F.lit(True))
    prime = prime_revenue(roles.prime_subscription_event).withColumn("_pr", F.lit(True))
    sides = [sv, room_streak(roles.player_room), owned_items(roles.room),
             wager_profile(roles.game_session), event_count(roles.pet_feeding, "n_feedings"),
             event_count(roles.arcade_score, "n_arcade"), invite_count(roles.player), buys, prime, econ]
    key = base.schema["player_id"].dataType
    alike = [side for side in sides if gathered and side.schema["player_id"].dataType == key]
    joined = base.join(side_by_side(alike), "player_id", "left") if alike else base
    for side in sides:
        if not gathered or side.schema["player_id"].dataType != key:
            joined = joined.join(side, "player_id", "left")

    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    zm = lambda c: F.coalesce(F.col(c), F.lit(0).cast(MONEY))
    lag_us = _days_between(F.col("created_at"), F.col("first_buy"))
    out = joined.select(
        "player_id", "created_at", "last_seen", "active_days", "login_days",
        "country_code", "gender", "language", "acquisition_source",
        F.col("invited_by_player_id").isNotNull().alias("was_invited"),
        age_bucket(F.col("age_raw")).alias("age_bucket"),
        F.col("_sv").isNotNull().alias("surveyed"),
        "price_feeling", "pay_state", "half_off",
        stated_intent(F.col("price_feeling"), F.col("pay_state"), F.col("would_pay_for"),
                      F.col("half_off")).alias("stated_intent"),
        z("max_streak").cast("int").alias("max_streak"), z("n_rooms").alias("n_rooms"),
        z("furniture_cnt").alias("furniture_cnt"), z("wardrobe_cnt").alias("wardrobe_cnt"),
        z("n_games_hosted").alias("n_games_hosted"), zm("pcoins_wagered").alias("pcoins_wagered"),
        "fav_game",
        z("n_feedings").alias("n_feedings"), z("n_arcade").alias("n_arcade"),
        z("n_invited").alias("n_invited"),
        "pcoins_balance", "coins_balance",
        z("n_purchases").alias("n_purchases"),
        zm("pcoin_total").alias("pcoin_usd"),
        zm("prime_total").alias("prime_usd"),
        (zm("pcoin_total") + zm("prime_total")).cast(MONEY).alias("lifetime_usd"),
        (F.col("_bu").isNotNull() | F.col("_pr").isNotNull()).alias("is_payer"),
        F.col("_pr").isNotNull().alias("is_prime_real"),
        F.when(F.col("first_buy").isNotNull(),
               round_ratio(lag_us, F.lit(DAY_US), 2)).alias("first_buy_lag_days"),
        F.coalesce(F.col("in_pgs"), F.lit(False)).alias("in_pgs"),
        "pgs_games", "pgs_wagered", "pgs_wins", "pgs_won")
    return out
