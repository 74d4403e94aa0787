"""M4-M7: the MLlib fit minimises the reference objective; AUC sees signal."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from paylens.config import REFERENCE_PROFILE as REF


def test_gradient_vanishes_at_solution(spark):
    from paylens.operators import model
    from paylens.plans.workspace import workspace
    ws = workspace(spark, SF001)
    run = model.train(ws.store, ws.cfg)
    m = model.feature_matrix(ws.store, ws.cfg)
    z = model.standardize(m, model.Moments.of(model.feature_moments(m, ws.cfg)), ws.cfg)
    g = model.gradient_norm(model.class_balance(z, ws.cfg), run.coefficients, run.intercept, ws.cfg)
    assert g < 1e-4


def test_planted_signal_gives_high_auc(spark):
    from paylens.operators import model
    cfg = REF.with_(model_features=("a", "b"), neg_per_pos=4)
    df = spark.range(4000).select(
        F.col("id").alias("player_id"),
        (F.col("id") % 5 == 0).cast("int").alias("is_test"),
        ((F.col("id") * 7919) % 100 < 20).cast("int").alias("y"))
    df = df.withColumn("a", F.col("y") * 2.0 + ((F.col("player_id") * 31) % 17) / 17.0) \
           .withColumn("b", ((F.col("player_id") * 13) % 11) / 11.0)
    mo = model.Moments.of(model.feature_moments(df, cfg))
    z = model.standardize(df, mo, cfg)
    fitted = model.fit(model.class_balance(z, cfg), cfg)
    coef = dict(zip(cfg.model_features, fitted.coefficients.toArray().tolist()))
    run = model.ModelRun(coef, float(fitted.intercept), 1, 1,
                         model.score(z.filter("is_test = 1"), coef, float(fitted.intercept), cfg))
    ev = model.evaluation(run, cfg).first()
    assert ev.test_auc > 0.95 and coef["a"] > abs(coef["b"])


def test_newton_equals_mllib(spark):
    """Both minimise the same objective: coefficients agree as far as L-BFGS comes, Newton ends at the zero of the gradient."""
    from paylens.operators import model
    from paylens.plans.workspace import workspace
    ws = workspace(spark, SF001)
    cfg = ws.cfg.with_(tol=1e-16, max_iter=1000)
    m = model.feature_matrix(ws.store, cfg)
    z = model.standardize(m, model.Moments.of(model.feature_moments(m, cfg)), cfg)
    train = model.class_balance(z, cfg).persist()
    coef, intercept = model.newton_fit(train, cfg)
    other = model.fit(train, cfg)
    assert max(abs(coef[f] - w) for f, w in zip(cfg.model_features, other.coefficients.toArray())) < 5e-6
    assert abs(intercept - other.intercept) < 5e-6
    assert model.gradient_norm(train, coef, intercept, cfg) < 1e-9
    train.unpersist()


def test_newton_on_one_class_and_no_rows(spark):
    import math
    from paylens.operators import model
    cfg = REF.with_(model_features=("a",))
    rows = spark.range(5).select(F.col("id").alias("player_id"), F.lit(0).alias("is_test"), F.lit(0).alias("y"), F.rand(1).alias("a"))
    assert model.newton_fit(rows, cfg) == ({"a": 0.0}, -math.inf)
    assert model.newton_fit(rows.withColumn("y", F.lit(1)), cfg) == ({"a": 0.0}, math.inf)
    assert model.newton_fit(rows.filter("false"), cfg) == ({"a": 0.0}, 0.0)
    apart = rows.withColumn("y", (F.col("player_id") > 2).cast("int")).withColumn("a", F.col("player_id") * 50.0)
    coef, intercept = model.newton_fit(apart, cfg)     # separable: the ridge keeps it finite, damping keeps it going
    assert model.gradient_norm(apart, coef, intercept, cfg) < 1e-6
