"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's tables through the role bindings, so its
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.operators import (behaviour, features, growth, headline, levers, payer_dna,
                               propensity, social, why_pay)
from paylens.plans.workspace import workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TENANT = ("acquisition_source",)


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _ws(spark, sf_dir):
    return workspace(spark, sf_dir)


# --- F: feature store ------------------------------------------------------

@query("player_base")
def q_player_base(spark, d):
    return features.player_base(_ws(spark, d).roles.player)


@query("latest_survey")
def q_latest_survey(spark, d):
    return features.latest_survey(_ws(spark, d).roles.survey_response)


@query("room_streak")
def q_room_streak(spark, d):
    return features.room_streak(_ws(spark, d).roles.player_room)


@query("owned_items")
def q_owned_items(spark, d):
    return features.owned_items(_ws(spark, d).roles.room)


@query("wager_profile")
def q_wager_profile(spark, d):
    return features.wager_profile(_ws(spark, d).roles.game_session)


@query("feed_count")
def q_feed_count(spark, d):
    return features.event_count(_ws(spark, d).roles.pet_feeding, "n_feedings")


@query("arcade_count")
def q_arcade_count(spark, d):
    return features.event_count(_ws(spark, d).roles.arcade_score, "n_arcade")


@query("invite_count")
def q_invite_count(spark, d):
    return features.invite_count(_ws(spark, d).roles.player)


@query("purchases")
def q_purchases(spark, d):
    return features.purchases(_ws(spark, d).roles.pcoin_transaction)


@query("prime_revenue")
def q_prime_revenue(spark, d):
    return features.prime_revenue(_ws(spark, d).roles.prime_subscription_event)


@query("survey_intent")
def q_survey_intent(spark, d):
    s = _ws(spark, d).store
    return s.select("player_id", "age_bucket", "surveyed", "price_feeling", "pay_state", "half_off",
                    "stated_intent")


@query("revealed_outcome")
def q_revealed_outcome(spark, d):
    s = _ws(spark, d).store
    return s.select("player_id", "n_purchases", "pcoin_usd", "prime_usd", "lifetime_usd", "is_payer",
                    "is_prime_real", "first_buy_lag_days")


@query("feature_store")
def q_feature_store(spark, d):
    return _ws(spark, d).store.select(*features.STORE_COLUMNS)


# --- H, W ------------------------------------------------------------------

@query("headline")
def q_headline(spark, d):
    return headline.headline(_ws(spark, d).store)


@query("stated_vs_revealed")
def q_stated_vs_revealed(spark, d):
    return headline.stated_vs_revealed(headline.headline(_ws(spark, d).store))


@query("product_mix")
def q_product_mix(spark, d):
    return why_pay.product_mix(_ws(spark, d).roles.pcoin_transaction)


@query("wagering_by_game")
def q_wagering_by_game(spark, d):
    return why_pay.wagering_by_game(_ws(spark, d).roles.game_session)


@query("cosmetics_gap")
def q_cosmetics_gap(spark, d):
    return why_pay.cosmetics_gap(_ws(spark, d).store)


@query("payer_archetypes")
def q_payer_archetypes(spark, d):
    ws = _ws(spark, d)
    return why_pay.payer_archetypes(ws.store, ws.cfg)


# --- D ---------------------------------------------------------------------

@query("player_game_economy")
def q_player_game_economy(spark, d):
    return _ws(spark, d).economy


@query("loss_chasing")
def q_loss_chasing(spark, d):
    ws = _ws(spark, d)
    return payer_dna.loss_chasing(ws.store, ws.cfg)


@query("bet_size_lift")
def q_bet_size_lift(spark, d):
    ws = _ws(spark, d)
    return payer_dna.bet_size_lift(ws.store, ws.cfg)


@query("game_type_pay")
def q_game_type_pay(spark, d):
    return payer_dna.game_type_pay(_ws(spark, d).store)


@query("payer_psychology")
def q_payer_psychology(spark, d):
    ws = _ws(spark, d)
    return payer_dna.payer_psychology(ws.store, ws.cfg)


@query("why_never_bought")
def q_why_never_bought(spark, d):
    ws = _ws(spark, d)
    return payer_dna.why_never_bought(ws.roles.survey_response, ws.store)


# --- B, P ------------------------------------------------------------------

@query("predictor_lift")
def q_predictor_lift(spark, d):
    ws = _ws(spark, d)
    return behaviour.predictor_lift(ws.store, ws.cfg)


@query("propensity_score")
def q_propensity_score(spark, d):
    return _ws(spark, d).store.select("player_id", "propensity")


@query("holdout_split")
def q_holdout_split(spark, d):
    return _ws(spark, d).store.select("player_id", "is_holdout")


@query("score_deciles")
def q_score_deciles(spark, d):
    ws = _ws(spark, d)
    return propensity.holdout_deciles(ws.store, ws.cfg).select("player_id", "propensity", "decile")


@query("decile_payer_rate")
def q_decile_payer_rate(spark, d):
    ws = _ws(spark, d)
    return propensity.decile_payer_rate(propensity.holdout_deciles(ws.store, ws.cfg))


@query("holdout_summary")
def q_holdout_summary(spark, d):
    ws = _ws(spark, d)
    return propensity.holdout_summary(propensity.holdout_deciles(ws.store, ws.cfg), ws.cfg)


# --- C, E, G, L --------------------------------------------------------------

@query("target_pool")
def q_target_pool(spark, d):
    ws = _ws(spark, d)
    return growth.target_pool(ws.store, ws.cfg)


@query("target_by_country")
def q_target_by_country(spark, d):
    ws = _ws(spark, d)
    return growth.target_by_country(ws.store, ws.cfg)


@query("conversion_moment")
def q_conversion_moment(spark, d):
    return growth.conversion_moment(_ws(spark, d).store)


@query("wagered_share_of_payers")
def q_wagered_share(spark, d):
    return growth.wagered_share_of_payers(_ws(spark, d).store)


@query("purchase_freq")
def q_purchase_freq(spark, d):
    ws = _ws(spark, d)
    return growth.purchase_freq(ws.store, ws.cfg)


@query("one_time_vs_repeat")
def q_one_time_vs_repeat(spark, d):
    ws = _ws(spark, d)
    return growth.one_time_vs_repeat(ws.store, ws.cfg)


@query("whale_concentration")
def q_whale_concentration(spark, d):
    return growth.whale_concentration(_ws(spark, d).store)


@query("prime_cross_sell")
def q_prime_cross_sell(spark, d):
    return growth.prime_cross_sell(_ws(spark, d).store)


@query("one_time_share")
def q_one_time_share(spark, d):
    return growth.one_time_share(_ws(spark, d).store)


@query("social_rates")
def q_social_rates(spark, d):
    return social.social_rates(_ws(spark, d).store)


@query("retention_x_pay")
def q_retention_x_pay(spark, d):
    ws = _ws(spark, d)
    return social.retention_x_pay(ws.store, ws.cfg)


@query("geo")
def q_geo(spark, d):
    ws = _ws(spark, d)
    return social.geo(ws.store, ws.cfg)


@query("lever_inputs")
def q_lever_inputs(spark, d):
    ws = _ws(spark, d)
    return levers.lever_inputs(ws.store, ws.cfg)


@query("levers")
def q_levers(spark, d):
    ws = _ws(spark, d)
    return levers.levers(levers.lever_inputs(ws.store, ws.cfg), ws.cfg)


@query("lever_pct_of_max")
def q_lever_pct_of_max(spark, d):
    ws = _ws(spark, d)
    return levers.pct_of_max(levers.levers(levers.lever_inputs(ws.store, ws.cfg), ws.cfg), "est_upside_usd")


@query("wagering_pct_of_max")
def q_wagering_pct_of_max(spark, d):
    return levers.pct_of_max(why_pay.wagering_by_game(_ws(spark, d).roles.game_session), "pcoins_wagered")


# --- M ---------------------------------------------------------------------

@query("score_auc")
def q_score_auc(spark, d):
    """M6 over the additive score on the holdout."""
    from paylens.operators.ranking import score_report
    ws = _ws(spark, d)
    hold = ws.store.filter(F.col("is_holdout")).select("player_id", "propensity", F.col("is_payer").cast("int").alias("y"))
    return score_report(hold, "propensity", "y", "player_id", ws.cfg.n_tiles).select(
        "auc", "positives", "negatives")


@query("score_top_decile")
def q_score_top_decile(spark, d):
    """M7 over the additive score: top floor(n/10) by score vs the base rate."""
    from paylens.functions.exact import pct, round_ratio
    from paylens.operators.ranking import score_report
    ws = _ws(spark, d)
    hold = ws.store.filter(F.col("is_holdout")).select("player_id", "propensity", F.col("is_payer").cast("int").alias("y"))
    r = score_report(hold, "propensity", "y", "player_id", ws.cfg.n_tiles)
    return r.select("n", "positives", "top_n", "top_positives",
                    pct(F.col("positives"), F.col("n")).alias("base_rate_pct"),
                    pct(F.col("top_positives"), F.col("top_n")).alias("top_rate_pct"),
                    round_ratio(F.col("top_positives").cast("decimal(38,0)") * F.col("n"), F.col("top_n").cast("decimal(38,0)") * F.col("positives"), 1, wide=True)
                    .alias("top_lift"))


@query("feature_matrix")
def q_feature_matrix(spark, d):
    from paylens.operators import model
    ws = _ws(spark, d)
    return model.feature_matrix(ws.store, ws.cfg)


@query("feature_moments")
def q_feature_moments(spark, d):
    from paylens.operators import model
    ws = _ws(spark, d)
    m = model.feature_moments(model.feature_matrix(ws.store, ws.cfg), ws.cfg)
    return m.select("feature", "pos", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@query("class_balance")
def q_class_balance(spark, d):
    from paylens.operators import model
    ws = _ws(spark, d)
    return model.class_balance(model.feature_matrix(ws.store, ws.cfg), ws.cfg).select("player_id", "y")


def _model_run(ws):
    from paylens.operators import model
    if "_model" not in ws.__dict__:
        ws.__dict__["_model"] = model.train(ws.store, ws.cfg)
    return ws.__dict__["_model"]


@query("model_coefficients")
def q_model_coefficients(spark, d):
    ws = _ws(spark, d)
    return _model_run(ws).coefficient_frame(spark)


@query("model_report")
def q_model_report(spark, d):
    from paylens.operators import model
    ws = _ws(spark, d)
    return model.evaluation(_model_run(ws), ws.cfg)


# --- V ---------------------------------------------------------------------

@query("revenue_reconciliation")
def q_revenue_reconciliation(spark, d):
    from paylens.operators.quality import revenue_reconciliation
    ws = _ws(spark, d)
    return revenue_reconciliation(ws.revenue, ws.store)


PII_SOURCES = (("documents", ("text", "lang", "source")), ("pages", ("url", "html")), ("benchmark", ("text",)),
               ("conversations", ("role", "text")))


@query("pii_scan")
def q_pii_scan(spark, d):
    from functools import reduce

    from paylens.operators.quality import pii_scan
    ws = _ws(spark, d)
    parts = [pii_scan(ws.tables(t).select(*cols), t) for t, cols in PII_SOURCES]
    return reduce(DataFrame.unionByName, parts)


@query("insights_bundle")
def q_insights_bundle(spark, d):
    from paylens.operators import bundle
    from paylens.plans.run import sections
    return bundle.insights_rows(sections(_ws(spark, d)))


@query("brief_facts")
def q_brief_facts(spark, d):
    from paylens.plans.run import brief
    return brief(_ws(spark, d))


# --- X ---------------------------------------------------------------------

@query("wagered_before_first_buy")
def q_wagered_before_first_buy(spark, d):
    from paylens.operators.extensions import wagered_before_first_buy
    from paylens.sources.bindings import bind_event_purchases
    ws = _ws(spark, d)
    wagers = ws.roles.game_session.filter(F.col("game_type") != "purchase")
    return wagered_before_first_buy(wagers, bind_event_purchases(ws.tables))


@query("guarded_target_pool")
def q_guarded_target_pool(spark, d):
    from paylens.operators.extensions import guarded_target_pool
    ws = _ws(spark, d)
    return guarded_target_pool(ws.store, ws.cfg)


@query("headline_by_tenant")
def q_headline_by_tenant(spark, d):
    return headline.headline(_ws(spark, d).store, by=("acquisition_source",))


@query("cohort_conversion_7d")
def q_cohort_conversion_7d(spark, d):
    from paylens.operators.extensions import cohort_conversion_7d
    return cohort_conversion_7d(_ws(spark, d).store)


@query("monthly_purchases")
def q_monthly_purchases(spark, d):
    from paylens.operators.extensions import monthly_purchases
    return monthly_purchases(_ws(spark, d).roles.pcoin_transaction)


@query("arpu")
def q_arpu(spark, d):
    from paylens.operators.extensions import arpu
    ws = _ws(spark, d)
    return arpu(ws.store, ws.roles.pcoin_transaction)


@query("revenue_document")
def q_revenue_document(spark, d):
    """The second source as the nested JSON document it comes as, written and read back."""
    from paylens.sources import sinks
    from paylens.sources.revenue import read_revenue_document
    ws = _ws(spark, d)
    path = ws.output_folder("revenue") + "/revenue.json"
    nested = F.struct(F.struct("revenue_usd").alias("revenue_total"), F.struct("active_users_28d").alias("overview_28d"))
    sinks.write_document(ws.revenue.select(F.to_json(nested).alias("value")), path)
    return read_revenue_document(spark, path)


@query("store_view_sql")
def q_store_view_sql(spark, d):
    """The store and the game economy as session temp views, asked in SQL."""
    ws = _ws(spark, d)
    ws.register_views("q_")
    return spark.sql("""SELECT country_code, count(*) AS players, count_if(is_payer) AS payers, sum(g.games) AS games,
        CAST(sum(lifetime_usd) AS DECIMAL(38,2)) AS usd
        FROM q_player_features LEFT JOIN q_pgs g USING (player_id) GROUP BY country_code""")


@query("feature_matrix_csv")
def q_feature_matrix_csv(spark, d):
    """The feature matrix exported as CSV with a header, read back with its types."""
    from paylens.operators import model
    from paylens.sources import sinks
    ws = _ws(spark, d)
    matrix, path = model.feature_matrix(ws.store, ws.cfg), ws.output_folder("matrix")
    sinks.export_csv(matrix, path)
    return spark.read.option("header", True).schema(matrix.schema).csv(path)


@query("insights_file")
def q_insights_file(spark, d):
    """The published insights file, its headline read back."""
    from paylens.operators import bundle
    from paylens.plans.run import sections
    from paylens.sources import sinks
    ws = _ws(spark, d)
    path = ws.output_folder("insights") + "/insights.json"
    sinks.write_document(bundle.insights_document(bundle.insights_members(sections(ws))), path)
    head = headline.headline(ws.store).schema.simpleString()
    return spark.read.schema(f"headline {head}").json(path).select("headline.*")


@query("model_report_file")
def q_model_report_file(spark, d):
    """The published model report, its coefficients read back."""
    from paylens.operators import model
    from paylens.sources import sinks
    ws = _ws(spark, d)
    run, path = _model_run(ws), ws.output_folder("report") + "/model_report.json"
    sinks.write_document(sinks.model_report_document(model.evaluation(run, ws.cfg), run.coefficient_frame(spark)), path)
    rows = "coefficients_by_importance array<struct<feature string, coef double, odds_per_sd double>>"
    return spark.read.schema(rows).json(path).select(F.inline("coefficients_by_importance"))


@query("whales_from_sketches")
def q_whales_from_sketches(spark, d):
    """Per tenant, quantiles merged from (tenant, month) sketches lie within their bound of the exact ranks."""
    from paylens.operators import sketches
    ws = _ws(spark, d)
    return sketches.spend_quantile_check(ws.store, ws.spend_sketches, TENANT)


@query("buyers_from_sketches")
def q_buyers_from_sketches(spark, d):
    """Buyers per product over all months, merged from (product, month) sketches."""
    from paylens.operators import sketches
    return sketches.distinct_people(_ws(spark, d).buyer_sketches, ("product_id",))


@query("monthly_buyer_overlap")
def q_monthly_buyer_overlap(spark, d):
    """Each month's buyers, and those who also bought the month before, by sketch intersection."""
    from paylens.operators import sketches
    return sketches.month_overlap(_ws(spark, d).buyer_sketches)


@query("scored_store_bucketed")
def q_scored_store_bucketed(spark, d):
    """The store and the score as tables bucketed by player, joined without moving the store."""
    ws = _ws(spark, d)
    store, score = ws.bucketed
    return store.join(score, "player_id").select("player_id", "is_payer", "lifetime_usd", "n_games_hosted", "propensity", "is_holdout")


@query("incremental_player_activity")
def q_incremental_player_activity(spark, d):
    """The streaming job run over the event table to completion."""
    from paylens.streaming.incremental import run_to_completion
    return run_to_completion(spark, d.rstrip("/") + "/events.parquet")


@query("incremental_player_profile")
def q_incremental_player_profile(spark, d):
    """Features that retractions lower, from a change feed of the event table."""
    from paylens.streaming.profile import stream_profile
    return stream_profile(spark, d)


@query("incremental_play_sessions")
def q_incremental_play_sessions(spark, d):
    """Event-time play sessions of the event stream, late rows merged in."""
    from paylens.streaming.sessions import run_to_completion
    return run_to_completion(spark, d.rstrip("/") + "/events.parquet").drop("late_events")


@query("decile_pct_of_max")
def q_decile_pct_of_max(spark, d):
    ws = _ws(spark, d)
    return levers.pct_of_max(propensity.decile_payer_rate(propensity.holdout_deciles(ws.store, ws.cfg)), "payer_pct")


@query("loss_pct_of_max")
def q_loss_pct_of_max(spark, d):
    ws = _ws(spark, d)
    return levers.pct_of_max(payer_dna.loss_chasing(ws.store, ws.cfg), "payer_pct")


@query("retention_pct_of_max")
def q_retention_pct_of_max(spark, d):
    ws = _ws(spark, d)
    return levers.pct_of_max(social.retention_x_pay(ws.store, ws.cfg), "payer_pct")


@query("archetypes_by_tenant")
def q_archetypes_by_tenant(spark, d):
    ws = _ws(spark, d)
    return why_pay.payer_archetypes(ws.store, ws.cfg, by=TENANT)


@query("retention_by_tenant")
def q_retention_by_tenant(spark, d):
    ws = _ws(spark, d)
    return social.retention_x_pay(ws.store, ws.cfg, by=TENANT)


@query("levers_by_tenant")
def q_levers_by_tenant(spark, d):
    ws = _ws(spark, d)
    return levers.levers(levers.lever_inputs(ws.store, ws.cfg, by=TENANT), ws.cfg, by=TENANT)


@query("lift_by_tenant")
def q_lift_by_tenant(spark, d):
    ws = _ws(spark, d)
    return behaviour.predictor_lift(ws.store, ws.cfg, by=TENANT)


@query("deciles_by_tenant")
def q_deciles_by_tenant(spark, d):
    ws = _ws(spark, d)
    return propensity.holdout_deciles(ws.store, ws.cfg, by=TENANT).select(*TENANT, "player_id", "propensity", "decile")


@query("whales_by_tenant")
def q_whales_by_tenant(spark, d):
    return growth.whale_concentration(_ws(spark, d).store, by=TENANT)


@query("target_countries_by_tenant")
def q_target_countries_by_tenant(spark, d):
    ws = _ws(spark, d)
    return growth.target_by_country(ws.store, ws.cfg, by=TENANT)


@query("retention_pct_of_max_by_tenant")
def q_retention_pct_of_max_by_tenant(spark, d):
    ws = _ws(spark, d)
    return levers.pct_of_max(social.retention_x_pay(ws.store, ws.cfg, by=TENANT), "payer_pct", by=TENANT)


@query("model_gradient")
def q_model_gradient(spark, d):
    """M4, M8: the published objective has no slope left at the fitted coefficients (4 dp)."""
    from paylens.operators import model
    ws = _ws(spark, d)
    run = _model_run(ws)
    matrix = model.feature_matrix(ws.store, ws.cfg)
    z = model.standardize(matrix, model.Moments.of(model.feature_moments(matrix, ws.cfg)), ws.cfg)
    slope = model.gradient(model.class_balance(z, ws.cfg), run.coefficients, run.intercept, ws.cfg)
    return slope.select("feature", (F.round("gradient", 4) + F.lit(0.0)).alias("gradient"))


@query("model_scores")
def q_model_scores(spark, d):
    """M5: holdout scores under a fixed coefficient vector."""
    from paylens.operators import model
    ws = _ws(spark, d)
    matrix = model.feature_matrix(ws.store, ws.cfg)
    z = model.standardize(matrix, model.Moments.of(model.feature_moments(matrix, ws.cfg)), ws.cfg)
    scored = model.score(z.filter(F.col("is_test") == 1), model.CHECK_COEFFICIENTS, model.CHECK_INTERCEPT, ws.cfg)
    return scored.select("player_id", "y", F.round("score", 6).alias("score"))
