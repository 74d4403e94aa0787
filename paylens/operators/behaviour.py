"""B1: payer-rate lift per behaviour signal, in one pass over the store.

The reference scans the store once per signal and unions the results; here
one conditional aggregation yields all high/low rates and ``stack``
turns them into one row per signal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.exact import round_ratio, round_ratio_scaled
from paylens.operators.headline import aggregate


def lift_metrics(cfg: Config) -> dict:
    """Payers and players on either side of every signal, as named aggregates."""
    payer, out = F.col("is_payer").cast("int"), {}
    for i, sig in enumerate(cfg.lifts):
        for side, cond in (("h", sig.high), ("l", sig.low)):
            v = F.when(F.expr(cond), payer)
            out[f"{side}n{i}"], out[f"{side}d{i}"] = F.sum(v), F.count(v)
    return out


def predictor_lift(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    return lift_rows(aggregate(store, lift_metrics(cfg), by), cfg, by)


def lift_rows(one: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per signal from ``lift_metrics``."""
    rows = [F.struct(F.lit(sig.name).alias("feature"), *[F.col(f"{c}{i}").alias(c) for c in ("hn", "hd", "ln", "ld")])
            for i, sig in enumerate(cfg.lifts)]
    long = one.select(*by, F.inline(F.array(*rows)))
    # pcts are rounded to hundredths first; the lift is the ratio of the rounded pcts
    high_h = round_ratio_scaled(F.col("hn") * 100, F.col("hd"), 2)
    low_h = round_ratio_scaled(F.col("ln") * 100, F.col("ld"), 2)
    return long.select(*by, "feature",
                       (high_h.cast("double") / 100.0).alias("high_pct"),
                       (low_h.cast("double") / 100.0).alias("low_pct"),
                       round_ratio(high_h, low_h, 1).alias("lift"))
