"""Invariants of the published goldens, checked on the driver's tables
"""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001


@pytest.fixture(scope="module")
def q(spark):
    from paylens.plans.registry import QUERIES
    return lambda name: QUERIES[name](spark, SF001)


def test_archetypes_partition_payers_and_revenue(q):
    h = q("headline").first()
    a = q("payer_archetypes").agg(F.sum("players").alias("p"), F.sum("usd").alias("u")).first()
    assert a.p == h.payers and a.u == h.total_usd


def test_decile_sizes(q):
    sizes = [r.players for r in q("decile_payer_rate").orderBy("decile").collect()]
    size = q("holdout_summary").first().holdout_size
    assert sum(sizes) == size and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_loss_and_stake_cover_same_players(q):
    a = q("loss_chasing").agg(F.sum("players")).first()[0]
    b = q("bet_size_lift").agg(F.sum("players")).first()[0]
    assert a == b and a > 0


def test_retention_buckets_partition_players(q):
    assert q("retention_x_pay").agg(F.sum("players")).first()[0] == q("headline").first().players


def test_prime_plus_nonprime_buyers_is_total(q):
    prime = q("payer_archetypes").filter(F.col("archetype") == "prime").first().usd
    cross = q("prime_cross_sell").first().their_lifetime_usd
    h = q("headline").first()
    prime_only_no_buys = q("feature_store").filter("is_prime_real OR n_purchases >= 1").count()
    assert prime + cross == h.total_usd and prime_only_no_buys == h.payers


def test_holdout_same_for_score_and_model(q):
    assert q("holdout_summary").first().holdout_size == q("model_report").first().test_rows


def test_lever_arithmetic(q, spark):
    from paylens.plans.workspace import workspace
    cfg = workspace(spark, SF001).cfg
    lv = {r.lever: r for r in q("levers").collect()}
    prime = lv["Cross-sell PRIME to pcoin buyers"]
    assert prime.est_upside_usd == round(prime.pool * cfg.prime_rate * cfg.prime_price)


def test_train_rows_positives_plus_sampled(q):
    r = q("model_report").first()
    cb = q("class_balance")
    assert r.train_rows == cb.count()
    assert cb.filter("y = 1").count() + cb.filter("y = 0").count() == r.train_rows


def _document(path):
    import json
    with open(path) as f:
        return json.load(f)


def test_insights_document_has_the_published_shape(spark, q):
    """Nested sections whose values equal the oracle-checked queries."""
    import json
    from decimal import Decimal

    from paylens.operators import bundle
    from paylens.plans.run import sections
    from paylens.plans.workspace import workspace
    model = spark.createDataFrame([('{"test_auc":0.5}',)], "value string")
    members = bundle.insights_members(sections(workspace(spark, SF001)))
    doc = json.loads(bundle.insights_document(members, model).first().document)
    assert list(doc) == ["headline", "why_pay", "payer_dna", "behavior_diff", "propensity", "convert_more", "expand_more",
                         "social_retention_geo", "diagnostic", "model", "revenuecat_validation"]
    assert doc["headline"]["players"] > 0 and len(doc["diagnostic"]["levers"]) == 3 and doc["model"]["test_auc"] == 0.5
    assert doc["propensity"]["weights"]["pcoins_wagered"] == 30 and doc["propensity"]["holdout_size"] > 0
    assert isinstance(doc["convert_more"]["wagered_before_paying_pct"], float)

    def norm(v):
        return float(v) if isinstance(v, (Decimal, float, int)) and not isinstance(v, bool) else v
    for s in bundle.SECTIONS:
        if not s.query:
            continue
        want = [{k: norm(v) for k, v in r.asDict().items()} for r in q(s.query).collect()]
        have = doc[s.parent] if s.shape == bundle.MERGE or "." not in s.path else doc[s.parent][s.name]
        if s.shape == bundle.SCALAR:
            assert [{s.columns[0]: norm(have)}] == want
            continue
        have = have if s.shape == bundle.ROWS else [{k: v for k, v in have.items() if k in s.columns}]
        have = [{k: norm(v) for k, v in r.items()} for r in have]
        key = lambda r: repr(sorted(r.items()))
        assert sorted(have, key=key) == sorted(want, key=key), s.path


def test_reference_profile_runs_end_to_end(spark, tmp_path):
    """The published thresholds (REFERENCE_PROFILE) drive the same run; only
    aggregates reach the published folder."""
    import os

    from paylens.config import REFERENCE_PROFILE
    from paylens.plans.run import run_all
    from tests.conftest import SF0001
    res = run_all(spark, SF0001, str(tmp_path / "out"), REFERENCE_PROFILE, store_dir=str(tmp_path / "private"))
    assert res["sections"] == 27
    doc = _document(tmp_path / "out" / "insights.json")
    assert {r["archetype"] for r in doc["why_pay"]["payer_archetypes"]} <= {"prime", "whale_75+", "repeat", "one_time"}
    assert [r["bucket"] for r in doc["social_retention_geo"]["retention_x_pay"]][-1] == "30+"
    assert len(doc["diagnostic"]["levers"]) == 3 and len(doc["model"]["coefficients_by_importance"]) == 13
    assert sorted(n for n in os.listdir(tmp_path / "out") if not n.startswith(".")) == ["brief_facts", "insights.json", "model_report.json"]
    assert spark.read.parquet(str(tmp_path / "private")).count() == doc["headline"]["players"]


def test_production_run_equals_the_bound_run(spark, tmp_path):
    """The nine role tables and a revenue document, through the command line."""
    import json

    from paylens.config import REFERENCE_PROFILE
    from paylens.plans.run import main, run_all
    from paylens.plans.workspace import Workspace
    from tests.conftest import SF0001
    ws = Workspace(spark, SF0001, REFERENCE_PROFILE)
    for name, df in ws.roles.as_dict().items():
        df.write.parquet(str(tmp_path / "roles" / name))
    r = ws.revenue.first()
    (tmp_path / "revenue.json").write_text(json.dumps({"revenue_total": {"revenue_usd": str(r.revenue_usd)},
                                                       "overview_28d": {"active_users_28d": r.active_users_28d}}))
    run_all(spark, SF0001, str(tmp_path / "a"), ws=ws)
    ws.release()
    main(["--roles", str(tmp_path / "roles"), "--revenue", str(tmp_path / "revenue.json"), "--out", str(tmp_path / "b")])
    a, b = _document(tmp_path / "a" / "insights.json"), _document(tmp_path / "b" / "insights.json")
    assert a == b


def test_workspace_follows_config_and_input(spark, tmp_path):
    """A changed threshold or changed input files give fresh answers; release removes the tables."""
    import os
    import shutil

    from paylens.config import FIXTURE_PROFILE
    from paylens.operators.headline import headline
    from paylens.plans.workspace import workspace
    from tests.conftest import SF0001
    d = str(tmp_path / "data")
    os.mkdir(d)  # not copytree: the copy must be writable whatever the source's modes
    for name in os.listdir(SF0001):
        shutil.copyfile(f"{SF0001}/{name}", f"{d}/{name}")
    ws = workspace(spark, d)
    before = headline(ws.store).first().players
    assert workspace(spark, d) is ws
    other = workspace(spark, d, FIXTURE_PROFILE.with_(target_score=5.0))
    assert other is not ws and other.cfg.target_score == 5.0
    customers = spark.read.parquet(f"{d}/customer.parquet")
    customers.unionByName(customers.withColumn("c_custkey", customers.c_custkey + 1_000_000)).coalesce(1).write.parquet(f"{d}/more")
    part = next(f for f in os.listdir(f"{d}/more") if f.endswith(".parquet"))
    shutil.copyfile(f"{d}/more/{part}", f"{d}/customer.parquet")
    fresh = workspace(spark, d)
    assert fresh is not ws and headline(fresh.store).first().players > before
    written = [p.replace("file:", "") for p in fresh._written]
    assert written and all(os.path.isdir(p) for p in written)
    fresh.release()
    assert not any(os.path.exists(p) for p in written)
    other.release()
