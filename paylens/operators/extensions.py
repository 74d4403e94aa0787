"""Analyses the published write-up describes but the
SQL never computes (time-ordered wager check, guarded targeting, tenants,
cohort conversion, monthly purchases / ARPU)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.exact import cents, cents_to_money, count_if, money_sum, pct, round_ratio


def wagered_before_first_buy(game_session: DataFrame, purchases: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of payers whose first hosted wager precedes their first purchase
    (``by``: columns of ``purchases``, read at the first purchase)."""
    first_buy = (purchases.filter(F.col("status").cast("string") == "completed")
                 .groupBy("player_id").agg(F.min("created_at").alias("first_buy"),
                                           *[F.min_by(c, "created_at").alias(c) for c in by]))
    first_wager = (game_session.filter(F.col("host_player_id").isNotNull())
                   .groupBy(F.col("host_player_id").alias("player_id"))
                   .agg(F.min("created_at").alias("first_wager")))
    j = first_buy.join(first_wager, "player_id", "left")
    before = F.col("first_wager") < F.col("first_buy")
    return j.groupBy(*by).agg(F.count("*").alias("payers"), count_if(before).alias("wagered_before"),
                 pct(count_if(before), F.count("*"), 1).alias("wagered_before_pct"))


def guarded_target_pool(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """The convert pool without minors, flagging heavy net losers."""
    j = store.withColumn("net", F.col("pgs_won") - F.col("pgs_wagered"))
    target = ~F.col("is_payer") & (F.col("propensity") >= F.lit(float(cfg.target_score)))
    minor = F.col("age_bucket") == "under_18"
    eligible = target & ~minor
    return j.groupBy(*by).agg(count_if(target).alias("targets"),
                 count_if(target & minor).alias("minors_excluded"),
                 count_if(eligible).alias("guarded_targets"),
                 count_if(eligible & (F.col("net") < F.lit(cfg.loss_flag_net))).alias("heavy_loss_flagged"))


def cohort_conversion_7d(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """By signup month, new players, first purchases within 7 days,
    rate; ``rollup`` adds the blended total (``is_total``)."""
    conv = count_if(F.col("first_buy_lag_days") < 7)
    month = store.withColumn("period_start", F.trunc("created_at", "month"))
    keys = [F.col(c) for c in (*by, "period_start")]
    # per group: its months and its total (with no group, a plain rollup)
    return (month.groupingSets([keys, keys[:-1]], *keys)
            .agg((F.grouping("period_start") == 1).alias("is_total"),
                 F.count("*").alias("new_customers"), conv.alias("conversions_7d"),
                 pct(conv, F.count("*")).alias("rate_pct")))


def monthly_purchases(pcoin_transaction: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Completed purchases and spend per calendar month."""
    return (pcoin_transaction.filter(F.col("status").cast("string") == "completed")
            .groupBy(*by, F.trunc("created_at", "month").alias("period_start"))
            .agg(F.count("*").alias("purchases"), money_sum(F.col("price")).alias("usd")))


def arpu(store: DataFrame, pcoin_transaction: DataFrame, window_days: int = 28) -> DataFrame:
    """Revenue per player, lifetime and over the last ``window_days``.

    The window ends at the newest purchase; its revenue is the completed
    purchases inside it and its audience the players last seen inside it.
    """
    c = F.sum(cents(F.col("lifetime_usd")))
    done = pcoin_transaction.filter(F.col("status").cast("string") == "completed")
    end = pcoin_transaction.select(F.max("created_at")).scalar()
    start = end - F.expr(f"INTERVAL {window_days} DAYS")
    recent_cents = done.filter(F.col("created_at") > start).select(F.sum(cents(F.col("price")))).scalar()
    active = count_if(F.col("last_seen") > start)
    return store.agg(F.count("*").alias("players"), money_sum(F.col("lifetime_usd")).alias("total_usd"),
                     round_ratio(c, F.count("*") * 100, 3, wide=True).alias("arpu_lifetime_usd"),
                     active.alias("active_users_28d")) \
        .select("players", "total_usd", "arpu_lifetime_usd", "active_users_28d",
                cents_to_money(F.coalesce(recent_cents, F.lit(0))).alias("revenue_28d_usd"),
                round_ratio(F.coalesce(recent_cents, F.lit(0)), F.col("active_users_28d") * 100, 3, wide=True)
                .alias("arpu_28d_usd"))
