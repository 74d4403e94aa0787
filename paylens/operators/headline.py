"""H1 headline and H2 stated-vs-revealed ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.exact import avg_exact, count_if, money_sum, pct, rate_pct, round_ratio


def headline_metrics() -> dict[str, Column]:
    """H1 as named aggregate expressions (mergeable with other one-row metrics)."""
    payer = F.col("is_payer")
    return {
        "players": F.count("*"),
        "payers": count_if(payer),
        "payer_pct": pct(count_if(payer), F.count("*")),
        "total_usd": money_sum(F.col("lifetime_usd")),
        "arppu_usd": avg_exact(F.col("lifetime_usd"), payer, 2, money=True),
        "surveyed": count_if(F.col("surveyed")),
        "stated_yes_payer_pct": rate_pct(payer, F.col("stated_intent")),
        "stated_no_payer_pct": rate_pct(payer, F.col("surveyed") & ~F.col("stated_intent")),
    }


def aggregate(store: DataFrame, metrics: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    return store.groupBy(*by).agg(*[c.alias(n) for n, c in metrics.items()])


def headline(store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """H1: one row (or one per ``by`` group, e.g. a tenant key), one pass."""
    return aggregate(store, headline_metrics(), by)


def stated_vs_revealed(head: DataFrame) -> DataFrame:
    """H2: said-yes payer rate over said-no rate, 1 dp; NULL (n/a) when no is 0."""
    yes = F.coalesce(F.col("stated_yes_payer_pct"), F.lit(0.0))
    no = F.coalesce(F.col("stated_no_payer_pct"), F.lit(0.0))
    # pcts carry two decimals: compare them as integer hundredths.
    ratio = round_ratio(F.round(yes * 100).cast("bigint"), F.round(no * 100).cast("bigint"), 1)
    return head.select("stated_yes_payer_pct", "stated_no_payer_pct", ratio.alias("yes_no_ratio"))
