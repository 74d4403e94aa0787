"""Product mix, wagering by game, cosmetics gap, payer archetypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.exact import avg_exact, count_if, money_sum, pct
from paylens.operators.breakdown import Breakdown


def _distinct(col: str, rsd: float | None):
    """Exact distinct count, or HyperLogLog++ with relative error ``rsd``."""
    return F.approx_count_distinct(col, rsd) if rsd else F.countDistinct(col)


def product_mix(pcoin_transaction: DataFrame, approx_rsd: float | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Completed transactions by product (deleted players included)."""
    return (pcoin_transaction.filter(F.col("status").cast("string") == "completed")
            .groupBy(*by, "product_id")
            .agg(F.count("*").alias("tx"), _distinct("player_id", approx_rsd).alias("ppl"),
                 money_sum(F.col("price")).alias("usd")))


def wagering_by_game(game_session: DataFrame, approx_rsd: float | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Sessions, distinct hosts, total stake per game type."""
    return (game_session.groupBy(*by, "game_type")
            .agg(F.count("*").alias("sessions"), _distinct("host_player_id", approx_rsd).alias("hosts"),
                 money_sum(F.col("bet_amount")).alias("pcoins_wagered")))


def cosmetics_metrics() -> dict:
    owns = (F.col("furniture_cnt") > 0) | (F.col("wardrobe_cnt") > 0)
    return {"players_with_furniture_or_wardrobe": count_if(owns), "total_players": F.count("*"),
            "pct": pct(count_if(owns), F.count("*"), 1)}


def cosmetics_gap(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """W3 (``by``: optional tenant/group keys, X4)."""
    from paylens.operators.headline import aggregate
    return aggregate(store, cosmetics_metrics(), by)


def archetype(cfg: Config):
    """Precedence: prime > whale > repeat > one-time."""
    return (F.when(F.col("is_prime_real"), F.lit("prime"))
            .when(F.col("lifetime_usd") >= F.lit(cfg.whale_usd), F.lit(cfg.whale_label))
            .when(F.col("n_purchases") >= cfg.repeat_min, F.lit("repeat"))
            .otherwise(F.lit("one_time")))


def by_archetype(cfg: Config) -> Breakdown:
    return Breakdown("archetype", archetype(cfg), where=F.col("is_payer"), aggregates={
        "players": F.count("*"), "usd": money_sum(F.col("lifetime_usd")),
        "avg_wagered": avg_exact(F.col("pcoins_wagered"), None, 0, money=True),
        "avg_streak": avg_exact(F.col("max_streak"), None, 1)})


def payer_archetypes(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """W4."""
    return by_archetype(cfg).alone(store, by)
