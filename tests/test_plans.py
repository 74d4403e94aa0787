"""Physical-plan checks: the plans we want at scale."""

import pytest

from tests.conftest import SF001

# Queries whose final operator is a bounded top-k / ordered report over
# aggregated rows (the limit is the feature).
TOPK = {"target_by_country", "geo"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _names():
    from paylens.plans.registry import QUERIES
    return [n for n in QUERIES if not n.startswith("incremental_") and n not in ("model_coefficients", "model_report",
                                               "class_balance", "insights_bundle", "brief_facts")]


@pytest.mark.parametrize("name", _names())
def test_no_python_udf_in_plan(spark, name):
    from paylens.plans.registry import QUERIES
    plan = _plan(QUERIES[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


@pytest.mark.parametrize("by", [(), ("g",)])
def test_ranking_moves_rows_by_range_only(multi_partition, by):
    """The rows are range-exchanged once and checkpointed; what follows moves
    one count per partition (and group), never rows through one partition."""
    spark = multi_partition
    from pyspark.sql import functions as F

    from paylens.operators.ranking import global_row_number
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("s"), (F.col("id") % 3).alias("g"))
    ranked = global_row_number(df, [F.col("s"), F.col("id")], "rn", by=by)
    assert ranked.rdd.getNumPartitions() > 1
    plan = _plan(ranked)
    assert "ExistingRDD" in plan and "rangepartitioning" not in plan  # the sort is behind the checkpoint
    for below in _single_partition_inputs(plan):
        assert "Aggregate" in below
    want = df.selectExpr("id", f"row_number() OVER (PARTITION BY {'g' if by else '1'} ORDER BY s, id) AS rn")
    assert sorted(map(tuple, ranked.select("id", "rn").collect())) == sorted(map(tuple, want.collect()))


def test_class_balance_sorts_ids_only(spark):
    from pyspark.sql import functions as F

    from paylens.config import REFERENCE_PROFILE
    from paylens.operators import model
    cfg = REFERENCE_PROFILE.with_(model_features=("a", "b"))
    m = spark.range(3000).select(F.col("id").alias("player_id"), F.lit(0).alias("is_test"), (F.col("id") % 50 == 0).cast("int").alias("y"),
                                 F.rand(1).alias("a"), F.rand(2).alias("b"))
    kind = type(m)  # the session's own class overrides checkpoint
    seen, plain = [], kind.checkpoint
    kind.checkpoint = lambda self, *a, **k: (seen.append(self.columns), plain(self, *a, **k))[1]
    try:
        out = model.class_balance(m, cfg)
    finally:
        kind.checkpoint = plain
    assert seen == [["player_id", "_h"]] and out.columns == m.columns
    assert out.filter("y = 1").count() == 60 and out.filter("y = 0").count() == -(-2940 // 12)


def test_training_set_leaves_the_scan_wide(spark, tmp_path):
    """No Coalesce above a table scan: the store is read by as many tasks as it has splits."""
    from paylens.operators import model
    from paylens.plans.workspace import workspace
    ws = workspace(spark, SF001)
    plan = []
    plain = model.newton_fit
    model.newton_fit = lambda train, cfg: (plan.append(_plan(train)), plain(train, cfg))[1]
    try:
        model.train(ws.store, ws.cfg)
    finally:
        model.newton_fit = plain
    assert "Coalesce" not in plan[0] and "Scan" in plan[0]


@pytest.mark.parametrize("name", ["wagering_pct_of_max", "revenue_reconciliation"])
def test_events_are_scanned_once(spark, name):
    from paylens.plans.audit import final_plan
    from paylens.plans.registry import QUERIES
    from paylens.plans.workspace import workspace
    workspace(spark, SF001).store  # built beforehand
    plan = final_plan(QUERIES[name](spark, SF001))
    assert plan.count("events.parquet") == 1


def test_bundle_scans_the_store_three_times(spark):
    """One pass for all one-row metrics, one for all breakdowns, one for the barriers' join."""
    from paylens.operators import bundle
    from paylens.plans.audit import file_scans
    from paylens.plans.run import Analyses
    from paylens.plans.workspace import Workspace
    ws = Workspace(spark, SF001)
    scans = file_scans(bundle.insights_rows(Analyses(ws).sections()))
    assert 1 <= sum("paylens-store-" in p for p in scans) <= 3
    ws.release()


def test_breakdowns_together_equal_each_alone(spark):
    from pyspark.sql import functions as F

    from paylens.operators.breakdown import Breakdown, one_pass
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("b"))
    total = {"n": F.count("*"), "top": F.max("id")}
    parts = {"one": Breakdown("a", F.col("a"), total), "two": Breakdown("b", F.col("b"), {"n": F.count("*")}, where=F.col("b").isNotNull()),
             "three": Breakdown("g", F.lit("x"), total, where=F.col("id") > 450),
             "none": Breakdown("g", F.lit(1), {"s": F.sum("id")}, where=F.col("id") < 0)}
    out = one_pass(rows, parts)
    for name, b in parts.items():
        assert sorted(map(tuple, out[name].collect())) == sorted(map(tuple, b.alone(rows).collect()))
        assert out[name].columns == b.alone(rows).columns


def test_store_pushes_soft_delete_filter_and_prunes(spark):
    from paylens.plans.workspace import workspace
    from paylens.operators.features import feature_store
    ws = workspace(spark, SF001)
    plan = _formatted(spark, feature_store(ws.roles))
    assert "EqualTo(event_type,view)" in plan and "PushedFilters" in plan
    # scans read only the columns the bindings use
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double,c_mktsegment:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in plan


def test_store_joins_share_partitioning(spark):
    """Every input of the nine joins arrives hash-partitioned on the player key."""
    from paylens.plans.workspace import workspace
    ws = workspace(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from paylens.operators.features import feature_store
        plan = feature_store(ws.roles)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    import re
    base_key = re.search(r"SortMergeJoin \[(player_id#\d+L?)\]", plan).group(1)
    # the player base is shuffled once; the chain of joins keeps that partitioning
    assert plan.count(f"Exchange hashpartitioning({base_key},") == 1
    assert len(re.findall(rf"SortMergeJoin \[{re.escape(base_key)}\]", plan)) >= 9
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_store_can_be_materialised_as_a_table(spark):
    from paylens.operators.headline import headline
    from paylens.plans.workspace import Workspace
    a = Workspace(spark, SF001, materialize="table")
    b = Workspace(spark, SF001, materialize="cache")
    assert headline(a.store).collect() == headline(b.store).collect()
    assert all(f.startswith("file:") and "paylens-store-" in f for f in a.store.inputFiles())


def _single_partition_inputs(plan: str) -> list[str]:
    """The plan text under each ``Exchange SinglePartition``."""
    lines, out = plan.splitlines(), []
    for i, line in enumerate(lines):
        node = line.lstrip(" :+-")
        if node.startswith("Exchange SinglePartition"):
            depth, below = len(line) - len(node), []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                below.append(nxt)
            out.append("\n".join(below))
    return out


def _batch_names():
    from paylens.plans.registry import QUERIES
    return [n for n in QUERIES if not n.startswith("incremental_")]


@pytest.mark.parametrize("name", _batch_names())
def test_single_partition_only_above_aggregates(spark, name):
    """No unaggregated rows ever funnel into one partition: a SinglePartition
    exchange may only carry aggregates (partial ones, the rows of a report)
    or the per-partition counts of the global ranking."""
    from paylens.plans.registry import QUERIES
    df = QUERIES[name](spark, SF001)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for below in _single_partition_inputs(plan):
        groups = "_set:bigint" in below  # the written groups of all breakdowns: aggregates already
        assert "Aggregate" in below or "LocalTableScan" in below or "Scan ExistingRDD" in below or groups, f"{name}: {below[:200]}"
