"""End-to-end run: store -> analyses -> model -> reconciliation -> gate -> sinks.

    python -m paylens --roles <folder of role tables> --revenue <document.json> --out <folder>
    python -m paylens --data /root/testdata/sf0.1 --out <folder>

Nothing is published before the personal-data gate has passed on every
document (the model report included); the gate counts while they are staged.
"""

from __future__ import annotations

import argparse
import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.config import FIXTURE_PROFILE, PROFILES, Config
from paylens.operators import (behaviour, bundle, growth, headline, levers, model, payer_dna,
                               propensity, social, why_pay)
from paylens.operators.breakdown import one_pass
from paylens.operators.quality import reconcile
from paylens.plans.workspace import Workspace, workspace
from paylens.sources import sinks


class Analyses:
    """Every analysis frame of one workspace, each built once and shared by
    the insights bundle and the brief (rankings checkpoint eagerly, so
    building a frame twice would rank twice)."""

    def __init__(self, ws: Workspace):
        self.ws = ws

    def _families(self) -> dict[str, dict]:
        cfg = self.ws.cfg
        return {"head": headline.headline_metrics(), "cos": why_pay.cosmetics_metrics(),
                "pool": growth.target_pool_metrics(cfg), "wsh": growth.wagered_share_metrics(),
                "pcs": growth.prime_cross_sell_metrics(), "soc": social.social_metrics(),
                "li": levers.lever_input_metrics(cfg), "lift": behaviour.lift_metrics(cfg)}

    @cached_property
    def store_metrics(self) -> DataFrame:
        """All one-row metrics over the store in a single aggregate pass (the
        reference scans the store once per metric family); one cached row."""
        aggs = [c.alias(f"{fam}__{n}") for fam, m in self._families().items() for n, c in m.items()]
        return self.ws.store.agg(*aggs).persist()

    def _family(self, fam: str) -> DataFrame:
        names = self._families()[fam].keys()
        return self.store_metrics.select(*[F.col(f"{fam}__{n}").alias(n) for n in names])

    @cached_property
    def deciles(self) -> DataFrame:
        return propensity.holdout_deciles(self.ws.store, self.ws.cfg)

    @cached_property
    def levers(self) -> DataFrame:
        return levers.levers(self._family("li"), self.ws.cfg)

    @cached_property
    def head(self) -> DataFrame:
        return self._family("head")

    @cached_property
    def lift(self) -> DataFrame:
        return behaviour.lift_rows(self._family("lift"), self.ws.cfg)

    @cached_property
    def breakdowns(self) -> dict[str, DataFrame]:
        """Every breakdown by a band or group, from one grouping-sets pass over the store."""
        cfg = self.ws.cfg
        return one_pass(self.ws.store, {
            "payer_archetypes": why_pay.by_archetype(cfg), "loss_chasing": payer_dna.by_net_outcome(cfg),
            "bet_size_lift": payer_dna.by_stake(cfg), "game_type_pay": payer_dna.by_game_type(),
            "payer_psychology": payer_dna.by_spender(cfg), "target_by_country": growth.targets_by_country(cfg),
            "purchase_freq": growth.by_frequency(cfg), "one_time_vs_repeat": growth.by_repeat(cfg),
            "retention_x_pay": social.by_active_days(cfg), "geo": social.by_country(cfg)},
            keep=lambda groups: self.ws._materialize(groups, "breakdowns"))

    @cached_property
    def summary(self) -> DataFrame:
        return propensity.holdout_summary(self.deciles, self.ws.cfg)

    @cached_property
    def pool(self) -> DataFrame:
        return self._family("pool")

    @cached_property
    def moment(self) -> DataFrame:
        return growth.conversion_moment(self.ws.store)

    @cached_property
    def wager_share(self) -> DataFrame:
        return self._family("wsh")

    @cached_property
    def cosmetics(self) -> DataFrame:
        return self._family("cos")

    @cached_property
    def freq(self) -> DataFrame:
        return self.breakdowns["purchase_freq"]

    @cached_property
    def cross_sell(self) -> DataFrame:
        return self._family("pcs")

    def sections(self) -> dict[str, DataFrame]:
        """Every section of the insights document by its path."""
        ws = self.ws
        s, cfg, roles = ws.store, ws.cfg, ws.roles
        return {
            "headline": self.head,
            "why_pay.product_mix": why_pay.product_mix(roles.pcoin_transaction),
            "why_pay.wagering_by_game": why_pay.wagering_by_game(roles.game_session),
            "why_pay.cosmetics_gap": self.cosmetics,
            "why_pay.payer_archetypes": self.breakdowns["payer_archetypes"],
            "payer_dna.loss_chasing": self.breakdowns["loss_chasing"],
            "payer_dna.bet_size_lift": self.breakdowns["bet_size_lift"],
            "payer_dna.game_type_pay": self.breakdowns["game_type_pay"],
            "payer_dna.payer_psychology": self.breakdowns["payer_psychology"],
            "payer_dna.why_never_bought": payer_dna.why_never_bought(roles.survey_response, s),
            "behavior_diff.predictor_lift": self.lift,
            "propensity.decile_payer_rate": propensity.decile_payer_rate(self.deciles),
            "propensity.summary": self.summary,
            "propensity.weights": propensity.score_weights(ws.spark, cfg),
            "convert_more.target_pool": self.pool,
            "convert_more.target_by_country": self.breakdowns["target_by_country"],
            "convert_more.conversion_moment": self.moment,
            "convert_more.wagered_before_paying_pct": self.wager_share,
            "expand_more.purchase_freq": self.freq,
            "expand_more.one_time_vs_repeat": self.breakdowns["one_time_vs_repeat"],
            "expand_more.whale_concentration": growth.whale_concentration(s),
            "expand_more.prime_cross_sell": self.cross_sell,
            "social_retention_geo.social": self._family("soc"),
            "social_retention_geo.retention_x_pay": self.breakdowns["retention_x_pay"],
            "social_retention_geo.geo": self.breakdowns["geo"],
            "diagnostic.levers": self.levers,
            "revenuecat_validation": reconcile(ws.revenue, self.head.select("total_usd")),
        }

    def brief(self) -> DataFrame:
        return bundle.brief_facts(self.head, self.levers, self.wager_share, self.moment, self.cosmetics,
                                  self.lift, self.summary, self.pool, self.freq, self.cross_sell)


def analyses(ws: Workspace) -> Analyses:
    if "_analyses" not in ws.__dict__:
        ws.__dict__["_analyses"] = Analyses(ws)
    return ws.__dict__["_analyses"]


def sections(ws: Workspace) -> dict[str, DataFrame]:
    return analyses(ws).sections()


def brief(ws: Workspace) -> DataFrame:
    return analyses(ws).brief()


def run_all(spark: SparkSession, data_dir: str, out_dir: str, cfg: Config = FIXTURE_PROFILE,
            fresh: bool = False, ws: Workspace | None = None, store_dir: str | None = None) -> dict:
    """Build, analyse, gate, write.

    ``fresh`` rebuilds everything instead of reusing this session's store;
    ``ws`` runs on a prepared workspace (its own config and role tables).
    ``out_dir`` gets the published documents, aggregates only. Per-player
    rows stay in the workspace's own table; ``store_dir``, a private folder,
    gets a copy of them if given.
    """
    if ws is None:
        ws = Workspace(spark, data_dir.rstrip("/"), cfg) if fresh else workspace(spark, data_dir, cfg)
    cfg = ws.cfg
    a = analyses(ws)
    secs = a.sections()  # builds every analysis plan (rankings checkpoint here, once)
    facts_plan = a.brief()
    # the documents are a few hundred bytes each: keep them so the
    # writes do not recompute the analyses behind them. Model report and
    # facts are independent, so their jobs run concurrently (Spark schedules
    # jobs from several driver threads side by side; most stages are small).
    from concurrent.futures import ThreadPoolExecutor

    def materialise(df):
        df = df.persist()
        df.count()
        return df

    def model_report():
        run = model.train(ws.store, cfg)
        return materialise(sinks.model_report_document(model.evaluation(run, cfg), run.coefficient_frame(spark)))

    with ThreadPoolExecutor(max_workers=3) as pool:
        f_body = pool.submit(lambda: materialise(bundle.insights_members(secs)))
        f_report = pool.submit(model_report)
        f_facts = pool.submit(lambda: materialise(facts_plan))
        body, report, facts = f_body.result(), f_report.result(), f_facts.result()
    doc = materialise(bundle.insights_document(body, report))
    sinks.publish({os.path.join(out_dir, "insights.json"): doc, os.path.join(out_dir, "model_report.json"): report,
                   os.path.join(out_dir, "brief_facts"): facts})
    if store_dir:
        sinks.write_store(ws.store, store_dir)
    for df in (doc, body, report, facts):
        df.unpersist()
    if fresh:
        ws.release()
    return {"sections": len(secs), "out": out_dir}


def main(argv=None):
    from paylens.session import get_session
    from paylens.sources.revenue import read_revenue_document
    from paylens.sources.tables import read_role_tables
    ap = argparse.ArgumentParser(description="Build the store, run every analysis, gate and write the documents.")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--roles", help="folder with the nine role tables (or a JDBC URL with --format jdbc)")
    src.add_argument("--data", help="folder with the test tables")
    ap.add_argument("--format", default="parquet", help="format of the role tables: parquet, orc, json, jdbc ...")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="reader option (repeatable)")
    ap.add_argument("--revenue", help="JSON document of the second revenue source (with --roles)")
    ap.add_argument("--profile", choices=sorted(PROFILES), help="thresholds (default: reference with --roles, else fixture)")
    ap.add_argument("--out", required=True, help="folder of the published documents")
    ap.add_argument("--store", help="private folder for the per-player store")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if a.roles and not a.revenue:
        ap.error("--roles needs --revenue")
    spark = get_session(master=a.master)
    cfg = PROFILES[a.profile or ("reference" if a.roles else "fixture")]
    ws = None
    if a.roles:
        roles = read_role_tables(spark, a.roles, a.format, options=dict(o.split("=", 1) for o in a.option))
        ws = Workspace(spark, a.roles, cfg, roles=roles, revenue=read_revenue_document(spark, a.revenue))
    result = run_all(spark, a.data or a.roles, a.out, cfg, ws=ws, store_dir=a.store)
    if ws:
        ws.release()
    print(result)
    return result


if __name__ == "__main__":
    main()
