"""M1-M8: logistic-regression propensity model.

Distributed end to end: moments are one aggregate, class balance is a
global-rank stride, the fit is a handful of Newton steps, each one aggregate
(``newton_fit``; ``fit`` is MLlib's L-BFGS on the same objective), of the
objective the reference minimises by gradient descent (mean log-loss +
lambda/2 * ||w||^2, intercept unpenalised, inputs z-scored with the
population sd), scoring is a column expression and evaluation uses the
distributed ranking in :mod:`paylens.operators.ranking`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.config import Config
from paylens.functions.exact import pct, round_ratio
from paylens.functions.hashing import stable_hash32
from paylens.operators.ranking import global_row_number, score_report

BOOL_FEATURES = ("stated_intent", "was_invited", "surveyed")
SIGMOID_CLIP = 30.0  # fixed values, with 1e-13 below: the published score clips there


def feature_matrix(store: DataFrame, cfg: Config) -> DataFrame:
    """M1: label, test flag, features as doubles (booleans as 0/1)."""
    cols = []
    for f in cfg.model_features:
        c = F.col(f).cast("int") if store.schema[f].dataType == T.BooleanType() else F.col(f)
        cols.append(c.cast("double").alias(f))
    return store.select("player_id", F.col("is_holdout").cast("int").alias("is_test"),
                        F.col("is_payer").cast("int").alias("y"), *cols)


def feature_moments(matrix: DataFrame, cfg: Config) -> DataFrame:
    """M2: training mean and population sd per feature (sd 0 or NULL -> 1)."""
    train = matrix.filter(F.col("is_test") == 0)
    aggs = []
    for f in cfg.model_features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")]
    one = train.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i).alias("pos"),
                              F.col(f"m_{f}").alias("mean"),
                              F.when(F.col(f"s_{f}") > 0, F.col(f"s_{f}")).otherwise(F.lit(1.0)).alias("sd"))
                     for i, f in enumerate(cfg.model_features)])
    return one.select(F.inline(rows))


@dataclass
class Moments:
    mean: dict[str, float]
    sd: dict[str, float]

    @classmethod
    def of(cls, moments: DataFrame) -> "Moments":
        rows = moments.collect()  # one row per feature: a fixed, small bound
        return cls({r.feature: (r.mean or 0.0) for r in rows}, {r.feature: r.sd for r in rows})


def standardize(matrix: DataFrame, m: Moments, cfg: Config) -> DataFrame:
    return matrix.select("player_id", "is_test", "y",
                         *[((F.col(f) - F.lit(m.mean[f])) / F.lit(m.sd[f])).alias(f) for f in cfg.model_features])


def training_stride(n_pos: int, n_neg: int, cfg: Config) -> int:
    """M3: keep every k-th negative, k = max(1, n_neg div (neg_per_pos * n_pos))."""
    return max(1, n_neg // (cfg.neg_per_pos * n_pos)) if n_pos else 1


def class_counts(matrix: DataFrame) -> tuple[int, int]:
    """Training positives and negatives."""
    c = matrix.filter(F.col("is_test") == 0).agg(F.count(F.when(F.col("y") == 1, 1)).alias("p"),
                                                 F.count(F.when(F.col("y") == 0, 1)).alias("n")).first()
    return c.p, c.n


def class_balance(matrix: DataFrame, cfg: Config, counts: tuple[int, int] | None = None) -> DataFrame:
    """M3: all training positives + every k-th training negative, negatives
    taken in a reproducible hash order (ties by id).

    Only (hash, id) is sorted and checkpointed; the chosen ids, a k-th of
    the negatives, are joined back to their features.
    """
    train = matrix.filter(F.col("is_test") == 0)
    k = training_stride(*(counts or class_counts(matrix)), cfg)
    neg = train.filter(F.col("y") == 0)
    if k > 1:
        ids = neg.select("player_id", stable_hash32(F.col("player_id")).alias("_h"))
        ranked = global_row_number(ids, [F.col("_h"), F.col("player_id")], "_rn")
        neg = neg.join(ranked.filter((F.col("_rn") - 1) % k == 0).select("player_id"), "player_id", "left_semi")
    return train.filter(F.col("y") == 1).unionByName(neg.select(train.columns))


def fit(train_z: DataFrame, cfg: Config):
    """M4: MLlib logistic regression on z-scored inputs."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    vec = VectorAssembler(inputCols=list(cfg.model_features), outputCol="features").transform(train_z)
    lr = LogisticRegression(featuresCol="features", labelCol="y", regParam=cfg.reg_param,
                            elasticNetParam=0.0, standardization=False, fitIntercept=True,
                            maxIter=cfg.max_iter, tol=cfg.tol)
    return lr.fit(vec.select("features", F.col("y").cast("double").alias("y")))


NEWTON_STEPS, NEWTON_TOLERANCE = 50, 1e-10


def _margin(names: tuple[str, ...], w) -> F.Column:
    z = F.lit(float(w[-1]))
    for f, v in zip(names, w):
        z = z + F.col(f) * F.lit(float(v))
    return z


def _derivatives(train_z: DataFrame, w, cfg: Config):
    """Loss, gradient and Hessian of the objective at ``w`` (intercept last): one aggregate."""
    import numpy as np
    names, d = cfg.model_features, len(cfg.model_features) + 1
    rows = train_z.select(*names, F.lit(1.0).alias("_one"), F.col("y").cast("double").alias("_y"), _margin(names, w).alias("_z"))
    p = 1.0 / (1.0 + F.exp(-F.col("_z")))
    rows = rows.select("*", (p - F.col("_y")).alias("_err"), (p * (1.0 - p)).alias("_var"))
    x = [F.col(c) for c in (*names, "_one")]
    loss = F.greatest(F.col("_z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z"))) - F.col("_y") * F.col("_z")
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    one = rows.agg(F.avg(loss).alias("loss"), *[F.avg(F.col("_err") * x[i]).alias(f"g{i}") for i in range(d)],
                   *[F.avg(F.col("_var") * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in upper]).first()
    ridge = np.append(np.full(d - 1, cfg.reg_param), 0.0)
    g = np.array([one[f"g{i}"] for i in range(d)]) + ridge * w
    h = np.diag(ridge)
    for i, j in upper:
        h[i, j] += one[f"h{i}_{j}"]
        h[j, i] = h[i, j]
    return one["loss"] + float((ridge * w * w).sum()) / 2, g, h


def newton_fit(train_z: DataFrame, cfg: Config) -> tuple[dict[str, float], float]:
    """M4: the published objective (mean log-loss + lambda/2 * ||w||^2) by damped Newton steps.

    A step is one pass: one aggregate row holds the gradient and the 14 x 14
    Hessian, whatever the number of rows, and the driver solves for the
    step. A step that raises the loss is halved. Training sets with one
    class have no finite intercept; they give zero coefficients and an
    intercept of plus or minus infinity (none at all: 0).
    """
    import numpy as np
    w = np.zeros(len(cfg.model_features) + 1)
    seen = [r["y"] for r in train_z.select("y").distinct().collect()]  # at most the two classes
    if len(seen) < 2:
        return dict.fromkeys(cfg.model_features, 0.0), (math.inf if seen[0] else -math.inf) if seen else 0.0
    loss, g, h = _derivatives(train_z, w, cfg)
    for _ in range(NEWTON_STEPS):
        step = np.linalg.solve(h, g)
        size = 1.0
        while True:
            new = _derivatives(train_z, w - size * step, cfg)
            if new[0] <= loss + 1e-14 or size < 1e-6:
                break
            size /= 2
        w, (loss, g, h) = w - size * step, new
        if size * float(np.abs(step).max()) < NEWTON_TOLERANCE:
            break
    return dict(zip(cfg.model_features, w[:-1].tolist())), float(w[-1])


def score(df_z: DataFrame, coef: dict[str, float], intercept: float, cfg: Config) -> DataFrame:
    """M5: clipped sigmoid of the linear predictor (a column expression)."""
    z = F.lit(intercept)
    for f in cfg.model_features:
        z = z + F.col(f) * F.lit(coef[f])
    p = (F.when(z < -SIGMOID_CLIP, F.lit(1e-13)).when(z > SIGMOID_CLIP, F.lit(1.0))
         .otherwise(1.0 / (1.0 + F.exp(-z))))
    return df_z.withColumn("score", p)


@dataclass
class ModelRun:
    coefficients: dict[str, float]
    intercept: float
    train_pos: int
    train_neg: int
    test_scores: DataFrame

    def coefficient_frame(self, spark) -> DataFrame:
        """M8: coef (3 dp) and odds per sd (2 dp), by |rounded coef| descending,
        ties in feature order. Thirteen numbers from the fitted model."""
        rows = [(i, f, float(w)) for i, (f, w) in enumerate(self.coefficients.items())]
        df = spark.createDataFrame(rows, "pos int, feature string, w double")
        return (df.select("pos", "feature", (F.round("w", 3) + F.lit(0.0)).alias("coef"),
                          F.round(F.exp("w"), 2).alias("odds_per_sd"))
                .orderBy(F.abs(F.col("coef")).desc(), "pos").drop("pos"))


def train(store: DataFrame, cfg: Config) -> ModelRun:
    matrix = feature_matrix(store, cfg)
    moments = Moments.of(feature_moments(matrix, cfg))
    z = standardize(matrix, moments, cfg)
    n_pos, n_neg = class_counts(z)
    k = training_stride(n_pos, n_neg, cfg)
    # every Newton step is a job over the training set: rebalance the
    # small balanced set by a shuffle (AQE sizes it), which leaves the scan of
    # the store as wide as it is
    train_set = class_balance(z, cfg, (n_pos, n_neg)).hint("rebalance").persist()
    coef, intercept = newton_fit(train_set, cfg)
    tests = score(z.filter(F.col("is_test") == 1), coef, intercept, cfg)
    train_set.unpersist()
    return ModelRun(coef, intercept, n_pos, -(-n_neg // k), tests)


def evaluation(run: ModelRun, cfg: Config) -> DataFrame:
    """M6 + M7 on the held-out natural distribution: one row."""
    rep = score_report(run.test_scores, "score", "y", "player_id", cfg.n_tiles, 3)
    return rep.select(
        F.lit("logistic regression (Newton, L2 on weights)").alias("model"),
        (F.lit(run.train_pos) + F.lit(run.train_neg)).alias("train_rows"),
        F.col("n").alias("test_rows"),
        F.lit(f"trained on {run.train_pos} payers + {run.train_neg} sampled non-payers").alias("class_balance"),
        F.col("auc").alias("test_auc"),
        pct(F.col("positives"), F.col("n")).alias("test_base_rate_pct"),
        pct(F.col("top_positives"), F.col("top_n")).alias("top_decile_rate_pct"),
        round_ratio(F.col("top_positives").cast("decimal(38,0)") * F.col("n"), F.col("top_n").cast("decimal(38,0)") * F.col("positives"), 1, wide=True)
        .alias("top_decile_lift"),
        F.lit("Coefficients are per +1 SD of the feature; odds_per_sd > 1 means the feature raises "
              "the odds of paying.").alias("note"))


def gradient(train_z: DataFrame, coef: dict[str, float], intercept: float, cfg: Config) -> DataFrame:
    """The published objective's gradient at (coef, intercept): feature, gradient."""
    scored = score(train_z, coef, intercept, cfg).withColumn("err", F.col("score") - F.col("y"))
    aggs = [(F.avg(F.col("err") * F.col(f)) + F.lit(cfg.reg_param * coef[f])).alias(f) for f in cfg.model_features]
    one = scored.agg(*aggs, F.avg("err").alias("intercept"))
    names = (*cfg.model_features, "intercept")
    return one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("gradient")) for f in names])))


def gradient_norm(train_z: DataFrame, coef: dict[str, float], intercept: float, cfg: Config) -> float:
    rows = gradient(train_z, coef, intercept, cfg).collect()  # one row per feature
    return math.sqrt(sum(r.gradient ** 2 for r in rows))


# A fixed coefficient vector: scoring is checked apart from fitting.
CHECK_COEFFICIENTS = {"pcoins_wagered": 0.4, "max_streak": -0.1, "n_games_hosted": 0.25, "active_days": 0.3, "login_days": -0.2,
                      "n_invited": 0.15, "n_rooms": 0.05, "furniture_cnt": -0.35, "n_feedings": 0.1, "n_arcade": -0.05,
                      "stated_intent": 0.5, "was_invited": -0.15, "surveyed": 0.2}
CHECK_INTERCEPT = -1.25
