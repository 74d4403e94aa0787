"""Gambling-mechanics cross-tabs against paying."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.buckets import band_ord, band_ord_ratio, label_of
from paylens.functions.exact import avg_exact, rate_pct, round_ratio, round_ratio_scaled
from paylens.functions.json import object_fields
from paylens.functions.survey import RESPONSE_FIELDS
from paylens.operators.breakdown import Breakdown


def _payer_rate(name: str, key, where, band=None) -> Breakdown:
    finish = (lambda g, by: g) if band is None else (
        lambda g, by: g.select(*by, name, label_of(F.col(name), band).alias("bucket"), "players", "payer_pct"))
    return Breakdown(name, key, {"players": F.count("*"), "payer_pct": rate_pct(F.col("is_payer"))}, where, finish)


def by_net_outcome(cfg: Config) -> Breakdown:
    net = F.col("pgs_won") - F.col("pgs_wagered")
    return _payer_rate("ord", band_ord(net, cfg.net_band), F.col("in_pgs"), cfg.net_band)


def by_stake(cfg: Config) -> Breakdown:
    return _payer_rate("ord", band_ord_ratio(F.col("pgs_wagered"), F.col("pgs_games"), cfg.stake_band),
                       F.col("in_pgs") & (F.col("pgs_games") > 0), cfg.stake_band)


def by_game_type() -> Breakdown:
    return _payer_rate("fav_game", F.col("fav_game"), F.col("fav_game").isNotNull())


def by_spender(cfg: Config) -> Breakdown:
    games, wins = F.col("pgs_games"), F.col("pgs_wins")
    win_rate = F.when(games != 0, round_ratio_scaled(wins * 100, games, 6))
    net = F.col("pgs_won") - F.col("pgs_wagered")
    return Breakdown(
        "grp", F.when(F.col("lifetime_usd") >= F.lit(cfg.whale_usd), F.lit(cfg.whale_label)).otherwise(F.lit("regular_payer")),
        where=F.col("is_payer") & (F.col("lifetime_usd") > 0) & F.col("in_pgs"), aggregates={
            "players": F.count("*"), "avg_games": avg_exact(games, None, 0),
            "win_rate": round_ratio(F.sum(win_rate), F.count(win_rate) * 1_000_000, 1, wide=True),
            "avg_wagered": avg_exact(F.col("pgs_wagered"), None, 0, money=True),
            "avg_net_pcoins": avg_exact(net, None, 0, money=True)})


def loss_chasing(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Net outcome (won - wagered) bands over live players who played;
    NULL net falls to the last band. One pass over the store (the economy
    columns were joined in when the store was built)."""
    return by_net_outcome(cfg).alone(store, by)


def bet_size_lift(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Average stake (wagered / games) bands, compared without dividing."""
    return by_stake(cfg).alone(store, by)


def game_type_pay(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """D3: payer rate by modal game."""
    return by_game_type().alone(store, by)


def payer_psychology(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Whales vs regular payers (spend > 0) who played, on game behaviour.
    Per-player win rates enter the average as whole millionths of a percent,
    so it does not depend on the order of the rows."""
    return by_spender(cfg).alone(store, by)


def why_never_bought(survey: DataFrame, store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Non-payers' stated barrier over all their responses.

    Responses are first collapsed to (player, reason) counts, so a player
    with a third of all responses joins as a handful of rows. Blank reasons
    are dropped by a conditional count over the parsed column rather than a
    row filter, which the optimizer would push below the parse and so
    parse every document twice.
    """
    reason = object_fields(F.col("responses"), survey.schema["responses"].dataType, RESPONSE_FIELDS)["neverBoughtReason"]
    named = F.col("reason").isNotNull() & (F.col("reason") != "")
    per_player = (survey.select("player_id", reason.alias("reason"))
                  .groupBy("player_id", "reason").agg(F.count_if(named).alias("n")))
    nonpayers = store.filter(~F.col("is_payer")).select("player_id", *by)
    return (per_player.join(nonpayers, "player_id").groupBy(*by, "reason")
            .agg(F.sum("n").alias("n")).filter(F.col("n") > 0))
