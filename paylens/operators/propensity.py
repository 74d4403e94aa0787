"""Additive propensity score, hash holdout, distributed deciles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.config import Config
from paylens.functions.exact import count_if, pct, rate_pct
from paylens.functions.hashing import holdout_flag


def score_expr(cfg: Config):
    """Sum of weight * least(x / cap, 1) plus a flat weight for intent."""
    total = None
    for t in cfg.score_terms:
        term = F.least(F.col(t.feature).cast("double") / F.lit(float(t.cap)), F.lit(1.0)) * F.lit(float(t.weight))
        total = term if total is None else total + term
    intent = F.when(F.col("stated_intent"), F.lit(float(cfg.intent_weight))).otherwise(F.lit(0.0))
    return total + intent


def with_propensity(store: DataFrame, cfg: Config) -> DataFrame:
    """Add (or replace) the ``propensity`` and ``is_holdout`` columns."""
    return (store.withColumn("propensity", score_expr(cfg))
            .withColumn("is_holdout", holdout_flag(F.col("player_id"), cfg.holdout_buckets)))


def score_weights(spark: SparkSession, cfg: Config) -> DataFrame:
    """The weights as data (same config that builds the score)."""
    rows = [(t.feature, float(t.cap), float(t.weight)) for t in cfg.score_terms]
    rows.append(("stated_intent", 1.0, float(cfg.intent_weight)))
    return spark.createDataFrame(rows, "feature string, cap double, weight double")


def holdout_deciles(store: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """Ntile over the holdout by score (ties by player id), distributed."""
    from paylens.operators.ranking import ntile
    hold = store.filter(F.col("is_holdout")).select(*by, "player_id", "propensity", "is_payer")
    return ntile(hold, [F.col("propensity"), F.col("player_id")], cfg.n_tiles, "decile", by)


def decile_payer_rate(deciles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """P4."""
    return deciles.groupBy(*by, "decile").agg(
        F.count("*").alias("players"), rate_pct(F.col("is_payer")).alias("payer_pct"))


def holdout_summary(deciles: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """P5: size, base rate, top-tile rate and the unrounded-ratio lift."""
    top = F.col("decile") == cfg.n_tiles
    payer = F.col("is_payer")
    n, p = F.count("*"), count_if(payer)
    tn, tp = count_if(top), count_if(top & payer)
    # lift = (tp/tn) / (p/n) = tp*n / (tn*p), rounded once.
    from paylens.functions.exact import round_ratio
    return deciles.groupBy(*by).agg(
        n.alias("holdout_size"),
        pct(p, n).alias("holdout_base_payer_pct"),
        pct(tp, tn).alias("top_decile_payer_pct"),
        round_ratio(tp.cast("decimal(38,0)") * n, tn.cast("decimal(38,0)") * p, 1, wide=True)
        .alias("top_decile_lift"))
