"""E3, C3, W1, W2, X6 from mergeable sketches, for audiences too large to rank or to keep apart.

A sketch table holds one small binary per cell (tenant and month, product
and month), built in one partially aggregated pass. Any union of cells is
answered by merging their sketches, so another month, tenant or pair of
months costs no scan of the players or transactions.

* KLL quantile sketches (``kll_sketch_agg_bigint``): spend in cents and the
  lag of the first purchase. A quantile's rank is within ``rank_bound(k)`` of
  the asked one (99 % confidence); up to ``k`` values it is exact.
* Theta sketches (``theta_sketch_agg``): distinct buyers and hosts, with
  intersections (who bought in both months). Up to 2^lg values the count is
  exact; beyond, its relative error is about 2 / sqrt(2^lg) (95 %).

The exact operators (``growth.whale_concentration``, ``why_pay``) stay the
reference; tests hold the sketches against them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.exact import cents, cents_to_money

KLL_K, THETA_LG = 1000, 14
DAY_US = 86_400_000_000
FRACTIONS = ((0.5, "median"), (0.9, "p90"), (0.99, "p99"))


def rank_bound(k: int = KLL_K) -> float:
    """Largest normalised rank error of a KLL sketch at 99 % confidence (its published fit)."""
    return 2.296 / k ** 0.9021


def spend_sketches(store: DataFrame, by: tuple[str, ...] = (), k: int = KLL_K) -> DataFrame:
    """Per ``by`` cell and sign-up month: payers, the largest spend, sketches of spend (cents) and first-buy lag (microseconds)."""
    lag = F.round(F.col("first_buy_lag_days") * F.lit(float(DAY_US))).cast("bigint")
    return (store.filter("is_payer").groupBy(*by, F.trunc("created_at", "month").alias("period_start"))
            .agg(F.count("*").alias("payers"), F.max("lifetime_usd").alias("max_usd"),
                 F.kll_sketch_agg_bigint(cents(F.col("lifetime_usd")), k).alias("spend"),
                 F.kll_sketch_agg_bigint(lag, k).alias("lag"), F.count(lag).alias("timed")))


def _quantiles(sketch: str, count: str):
    """The asked quantiles of a merged sketch; null where nothing went into it."""
    return F.when(F.col(count) > 0, F.kll_sketch_get_quantile_bigint(F.col(sketch), F.array(*[F.lit(f) for f, _ in FRACTIONS])))


def spend_quantiles(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """E3 and C3 from a sketch table, over all of its other dimensions: payers, quantiles of
    spend and of the first purchase's lag in days (values that occur, not interpolated), largest spend."""
    merged = sketches.groupBy(*by).agg(
        F.sum("payers").alias("payers"), F.max("max_usd").alias("max_usd"), F.sum("timed").alias("timed"),
        F.kll_merge_agg_bigint("spend").alias("spend"), F.kll_merge_agg_bigint("lag").alias("lag"))
    q = merged.withColumn("s", _quantiles("spend", "payers")).withColumn("l", _quantiles("lag", "timed"))
    usd = [cents_to_money(F.col("s")[i]).alias(f"{name}_usd") for i, (_, name) in enumerate(FRACTIONS)]
    lag = [(F.col("l")[i] / F.lit(float(DAY_US))).alias(f"{name}_lag_days") for i, (_, name) in enumerate(FRACTIONS)]
    return q.select(*by, "payers", *usd, "max_usd", *lag)


def spend_quantile_check(store: DataFrame, sketches: DataFrame, by: tuple[str, ...] = (), k: int = KLL_K) -> DataFrame:
    """Whether each sketched spend quantile lies within ``rank_bound`` of its rank among the exact spends.

    A value stands for the ranks from (number below it) to (number up to it);
    one pass counts both for every quantile."""
    found = spend_quantiles(sketches, by).withColumn("_all", F.lit(0))
    joined = store.filter("is_payer").select(*by, "lifetime_usd", F.lit(0).alias("_all")).join(found, ["_all", *by])
    value, n = F.col("lifetime_usd"), F.count("*")
    inside = []
    for f, name in FRACTIONS:
        below, upto = F.count(F.when(value < F.col(f"{name}_usd"), 1)), F.count(F.when(value <= F.col(f"{name}_usd"), 1))
        slack = n * F.lit(rank_bound(k)) + 1
        inside.append(((below <= n * F.lit(f) + slack) & (upto >= n * F.lit(f) - slack)).alias(f"{name}_within"))
    return joined.groupBy(*by).agg(F.max("payers").alias("payers"), F.max("max_usd").alias("max_usd"), *inside)


def audience_sketches(rows: DataFrame, person: str, by: tuple[str, ...], at: str = "created_at", lg: int = THETA_LG) -> DataFrame:
    """Per ``by`` cell and month: rows and a sketch of the distinct ``person`` values."""
    return (rows.filter(F.col(person).isNotNull()).groupBy(*by, F.trunc(at, "month").alias("period_start"))
            .agg(F.count("*").alias("n"), F.theta_sketch_agg(person, lg).alias("people")))


def distinct_people(sketches: DataFrame, by: tuple[str, ...] = (), lg: int = THETA_LG) -> DataFrame:
    """Rows and distinct people per ``by``, over all other dimensions of the sketch table."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.theta_sketch_estimate(F.theta_union_agg("people", lg)).alias("people"))


def month_overlap(sketches: DataFrame, months: int = 1, lg: int = THETA_LG) -> DataFrame:
    """Per month: distinct people, how many of them also came ``months`` before, and how many did not."""
    by_month = sketches.groupBy("period_start").agg(F.theta_union_agg("people", lg).alias("people"))
    before = by_month.select(F.add_months("period_start", months).alias("period_start"), F.col("people").alias("earlier"))
    both = by_month.join(before, "period_start", "left")
    here = F.theta_sketch_estimate("people")
    again = F.when(F.col("earlier").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("people", "earlier"))).otherwise(0)
    new = F.when(F.col("earlier").isNotNull(), F.theta_sketch_estimate(F.theta_difference("people", "earlier"))).otherwise(here)
    return both.select("period_start", here.alias("buyers"), again.cast("bigint").alias("returning"), new.cast("bigint").alias("others"))
