"""L1-L3: size and rank the monetization levers.

Upsides are exact rationals of integer counts and cent sums (rates as
fractions), rounded once, so the ranking never depends on float error.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.exact import cents, count_if, round_ratio


def lever_input_metrics(cfg: Config) -> dict:
    """L1: pools, plus spend sums and counts behind the average LTVs."""
    payer = F.col("is_payer")
    hp = ~payer & (F.col("propensity") >= F.lit(float(cfg.target_score)))
    one = F.col("n_purchases") == 1
    rep = F.col("n_purchases") >= cfg.repeat_min
    c = cents(F.col("lifetime_usd"))
    return {
        "hp_nonpayers": count_if(hp),
        "one_timers": count_if(one),
        "prime_candidates": count_if((F.col("n_purchases") >= 1) & ~F.col("is_prime_real")),
        "payers": count_if(payer), "payer_cents": F.sum(F.when(payer, c)),
        "repeaters": count_if(rep), "repeat_cents": F.sum(F.when(rep, c)),
        "onetimers_n": count_if(one), "onetime_cents": F.sum(F.when(one, c)),
    }


def lever_inputs(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """L1."""
    from paylens.operators.headline import aggregate
    return aggregate(store, lever_input_metrics(cfg), by)


def _frac(x: float) -> Fraction:
    return Fraction(str(x))


def lever_texts(cfg: Config) -> list[tuple[str, str]]:
    """(lever, assumption) labels, in lever order (the lever names are fixed values)."""
    return [
        ("Convert high-propensity non-payers", f"{cfg.convert_rate * 100:g}% convert × avg payer LTV"),
        ("Turn one-time buyers into repeat",
         f"{cfg.repeat_rate * 100:g}% make a 2nd purchase × (repeat − one-time LTV)"),
        ("Cross-sell PRIME to pcoin buyers", f"{cfg.prime_rate * 100:g}% subscribe × ${cfg.prime_price:g}/yr"),
    ]


def levers(inputs: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """L2: three levers, one row each, in one pass over the L1 row(s)."""
    conv, rep, prime = _frac(cfg.convert_rate), _frac(cfg.repeat_rate), _frac(cfg.prime_rate) * _frac(cfg.prime_price)
    w = lambda c: F.col(c).cast("decimal(38,0)")
    # pool * rate * (payer_cents / payers) / 100
    conv_num = w("hp_nonpayers") * conv.numerator * w("payer_cents")
    conv_den = w("payers") * (conv.denominator * 100)
    # pool * rate * max(repeat_avg - onetime_avg, 0); difference as one fraction
    diff_num = w("repeat_cents") * w("onetimers_n") - w("onetime_cents") * w("repeaters")
    rep_num = F.when((F.col("repeaters") > 0) & (F.col("onetimers_n") > 0),
                     w("one_timers") * rep.numerator * F.greatest(diff_num, F.lit(0).cast("decimal(38,0)"))
                     ).otherwise(F.lit(0).cast("decimal(38,0)"))
    rep_den = F.when((F.col("repeaters") > 0) & (F.col("onetimers_n") > 0),
                     w("repeaters") * w("onetimers_n") * (rep.denominator * 100)).otherwise(F.lit(1).cast("decimal(38,0)"))
    prime_num = w("prime_candidates") * prime.numerator
    sized = [("hp_nonpayers", round_ratio(conv_num, conv_den, 0, wide=True)),
             ("one_timers", round_ratio(rep_num, rep_den, 0, wide=True)),
             ("prime_candidates", round_ratio(prime_num, F.lit(prime.denominator), 0, wide=True))]
    rows = F.array(*[
        F.struct(F.lit(name).alias("lever"), F.col(pool).alias("pool"),
                 F.lit(assumption).alias("assumption"), est.alias("est_upside_usd"))
        for (name, assumption), (pool, est) in zip(lever_texts(cfg), sized)])
    return inputs.select(*by, F.inline(rows))


def pct_of_max(df: DataFrame, col: str, name: str = "pct_of_max", by: tuple[str, ...] = ()) -> DataFrame:
    """L3: value as a percentage of the column maximum (bar widths), per ``by`` group.

    ``df`` is an analysis result of a few rows (bands, games, levers per
    group), so the maximum is a window over it: one pass, input computed once.
    """
    value = F.col(col).cast("double")
    return df.withColumn(name, F.lit(100.0) * value / F.max(value).over(Window.partitionBy(*by)))
