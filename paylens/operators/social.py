"""Virality, retention and geography lenses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.buckets import band_ord, label_of
from paylens.functions.exact import money_sum, rate_pct
from paylens.operators.breakdown import Breakdown
from paylens.operators.ranking import top_rows


def social_metrics() -> dict:
    payer = F.col("is_payer")
    return {"invited_in_payer_pct": rate_pct(payer, F.col("was_invited")),
            "organic_payer_pct": rate_pct(payer, ~F.col("was_invited")),
            "inviter_payer_pct": rate_pct(payer, F.col("n_invited") > 0),
            "noninviter_payer_pct": rate_pct(payer, F.col("n_invited") == 0)}


def social_rates(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """G1: four payer rates in one pass (the reference runs four subqueries)."""
    from paylens.operators.headline import aggregate
    return aggregate(store, social_metrics(), by)


def by_active_days(cfg: Config) -> Breakdown:
    return Breakdown(
        "_b", band_ord(F.col("active_days"), cfg.active_band),
        {"ord": F.min("active_days"), "players": F.count("*"), "payer_pct": rate_pct(F.col("is_payer"))},
        finish=lambda g, by: g.select(*by, label_of(F.col("_b"), cfg.active_band).alias("bucket"), "ord", "players", "payer_pct"))


def retention_x_pay(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Active-day buckets; ``ord`` is the bucket's smallest active_days."""
    return by_active_days(cfg).alone(store, by)


def by_country(cfg: Config) -> Breakdown:
    return Breakdown(
        "country_code", F.col("country_code"), where=F.col("country_code").isNotNull(), aggregates={
            "players": F.count("*"), "payer_pct": rate_pct(F.col("is_payer")),
            "usd": F.round(money_sum(F.col("lifetime_usd")), 0).cast("decimal(38,0)")},
        finish=lambda g, by: top_rows(g, [F.col("players").desc(), F.col("country_code")], cfg.top_countries_geo, by))


def geo(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Top countries by players (ties by code)."""
    return by_country(cfg).alone(store, by)
