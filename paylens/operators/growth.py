"""C1-C4 (convert more) and E1-E5 (expand more)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.buckets import band_ord, label_of
from paylens.functions.exact import avg_days, avg_exact, cents, count_if, money_sum, pct
from paylens.operators.breakdown import Breakdown
from paylens.operators.headline import aggregate
from paylens.operators.ranking import percentiles_cont, top_rows


def _target(cfg: Config):
    return ~F.col("is_payer") & (F.col("propensity") >= F.lit(float(cfg.target_score)))


def target_pool_metrics(cfg: Config) -> dict:
    t = _target(cfg)
    return {"high_propensity_nonpayers": count_if(t), "total_nonpayers": count_if(~F.col("is_payer")),
            "avg_wagered": avg_exact(F.col("pcoins_wagered"), t, 0, money=True),
            "avg_streak": avg_exact(F.col("max_streak"), t, 1)}


def target_pool(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """C1."""
    return aggregate(store, target_pool_metrics(cfg), by)


def targets_by_country(cfg: Config) -> Breakdown:
    return Breakdown("country_code", F.col("country_code"), {"targets": F.count("*")},
                     where=_target(cfg) & F.col("country_code").isNotNull(),
                     finish=lambda g, by: top_rows(g, [F.col("targets").desc(), F.col("country_code")], cfg.top_countries_target, by))


def target_by_country(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Top countries of the target pool (ties by country code)."""
    return targets_by_country(cfg).alone(store, by)


def conversion_moment(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Share buying within 1 / 7 days of signup, exact median lag."""
    buyers = store.filter(F.col("is_payer") & F.col("first_buy_lag_days").isNotNull())
    lag = F.col("first_buy_lag_days")
    hundredths = F.round(lag * 100).cast("bigint")
    out = percentiles_cont(
        buyers, hundredths, F.col("player_id"), [(1, 2)], 100, 1, keep=("first_buy_lag_days",),
        extra=(pct(count_if(lag < 1), F.count("*"), 1).alias("same_day_pct"),
               pct(count_if(lag < 7), F.count("*"), 1).alias("within_7d_pct")), by=by)
    return out.select(*by, "same_day_pct", "within_7d_pct", F.col("p0").alias("median_lag_days"))


def wagered_share_metrics() -> dict:
    payer = F.col("is_payer")
    return {"wagered_before_paying_pct": pct(count_if(payer & (F.col("pcoins_wagered") > 0)), count_if(payer), 1)}


def wagered_share_of_payers(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """C4: share of payers with any wager (no time condition, as published)."""
    return aggregate(store, wagered_share_metrics(), by)


def by_frequency(cfg: Config) -> Breakdown:
    return Breakdown(
        "_b", band_ord(F.col("n_purchases"), cfg.freq_band), where=F.col("n_purchases") >= 1,
        aggregates={"ord": F.min("n_purchases"), "payers": F.count("*"), "usd": money_sum(F.col("pcoin_usd"))},
        finish=lambda g, by: g.select(*by, label_of(F.col("_b"), cfg.freq_band).alias("bucket"), "ord", "payers", "usd"))


def purchase_freq(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """E1."""
    return by_frequency(cfg).alone(store, by)


def by_repeat(cfg: Config) -> Breakdown:
    return Breakdown(
        "grp", F.when(F.col("n_purchases") >= cfg.repeat_min, F.lit("repeat")).otherwise(F.lit("one_time")),
        where=F.col("n_purchases") >= 1, aggregates={
            "players": F.count("*"), "avg_wagered": avg_exact(F.col("pcoins_wagered"), None, 0, money=True),
            "avg_streak": avg_exact(F.col("max_streak"), None, 1), "avg_active_days": avg_days(F.col("active_days"), 1)})


def one_time_vs_repeat(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """E2."""
    return by_repeat(cfg).alone(store, by)


def whale_concentration(store: DataFrame, approx_accuracy: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Payers, exact p50/p90/p99 and max of lifetime spend.

    ``approx_accuracy`` switches to ``percentile_approx`` (one pass, no
    ranking, values taken from the data rather than interpolated).
    """
    payers = store.filter(F.col("is_payer"))
    if approx_accuracy:
        q = F.percentile_approx(F.col("lifetime_usd").cast("double"), [0.5, 0.9, 0.99], approx_accuracy)
        return payers.groupBy(*by).agg(F.count("*").alias("payers"), q.alias("q"), F.max("lifetime_usd").alias("max_usd")) \
            .select(*by, "payers", F.round(F.col("q")[0], 2).alias("median_usd"), F.round(F.col("q")[1], 2).alias("p90_usd"),
                    F.round(F.col("q")[2], 2).alias("p99_usd"), "max_usd")
    q = percentiles_cont(payers, cents(F.col("lifetime_usd")), F.col("player_id"),
                         [(1, 2), (9, 10), (99, 100)], 100, 2, keep=("lifetime_usd",),
                         extra=(F.max("lifetime_usd").alias("max_usd"),), by=by)
    return q.select(
        *by, F.col("n").alias("payers"), F.col("p0").alias("median_usd"), F.col("p1").alias("p90_usd"),
        F.col("p2").alias("p99_usd"), "max_usd")


def prime_cross_sell_metrics() -> dict:
    cand = (F.col("n_purchases") >= 1) & ~F.col("is_prime_real")
    return {"pcoin_buyers_not_prime": count_if(cand),
            "their_lifetime_usd": money_sum(F.when(cand, F.col("lifetime_usd")))}


def prime_cross_sell(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """E4."""
    return aggregate(store, prime_cross_sell_metrics(), by)


def one_time_share(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """E5: one-time buyers as a truncated % of all payers."""
    one = count_if(F.col("n_purchases") == 1)
    payers = count_if(F.col("is_payer"))
    return store.groupBy(*by).agg(one.alias("one_time_buyers"), payers.alias("payers"),
                     F.when(payers > 0, F.call_function("div", one * 100, payers)).alias("one_time_pct"))
