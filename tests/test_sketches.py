"""Sketch tables against the exact operators; bucketed tables; JDBC key ranges."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF0001


def _big(spark, n=60_000):
    """Payers of two tenants over a year, with ties and one heavy tail."""
    return spark.range(n).select(
        F.col("id").alias("player_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("tenant"),
        F.expr("timestampadd(DAY, cast(id % 360 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("created_at"),
        (F.col("id") % 7 != 6).alias("is_payer"),
        F.expr("cast(pow(hash(id) % 1000, 2) / 7 + id % 11 as decimal(38,2))").alias("lifetime_usd"),
        F.when(F.col("id") % 5 > 0, (F.abs(F.hash("id")) % 9000) / 100.0).alias("first_buy_lag_days"))


@pytest.mark.parametrize("by", [(), ("tenant",)])
def test_merged_quantiles_stay_within_their_bound(spark, by):
    from paylens.operators import sketches
    store = _big(spark)
    cells = sketches.spend_sketches(store, ("tenant",), k=400)
    assert cells.count() == 2 * 12
    rows = sketches.spend_quantile_check(store, cells, by, k=400).collect()
    assert len(rows) == (2 if by else 1) and all(r[f"{n}_within"] for r in rows for _, n in sketches.FRACTIONS)
    got = {tuple(r[c] for c in by): r for r in sketches.spend_quantiles(cells, by).collect()}
    for r in store.filter("is_payer").groupBy(*by).agg(F.count("*").alias("n"), F.max("lifetime_usd").alias("top"),
                                                       F.sort_array(F.collect_list("first_buy_lag_days")).alias("lags")).collect():
        mine = got[tuple(r[c] for c in by)]
        assert (mine["payers"], mine["max_usd"]) == (r["n"], r["top"])
        for f, name in sketches.FRACTIONS:
            slack = sketches.rank_bound(400) * len(r["lags"]) + 1
            value = mine[f"{name}_lag_days"]
            assert sum(x < value - 1e-9 for x in r["lags"]) <= f * len(r["lags"]) + slack
            assert sum(x <= value + 1e-9 for x in r["lags"]) >= f * len(r["lags"]) - slack


def test_quantiles_of_few_values_are_exact(spark):
    from paylens.operators import sketches
    store = _big(spark, 300).filter("is_payer")
    one = sketches.spend_quantiles(sketches.spend_sketches(store)).first()
    values = sorted(r["lifetime_usd"] for r in store.collect())
    assert one["median_usd"] in values[len(values) // 2 - 1: len(values) // 2 + 1] and one["max_usd"] == values[-1]
    none = store.filter("false")
    assert sketches.spend_quantiles(sketches.spend_sketches(none), ("period_start",)).collect() == []
    untimed = store.withColumn("first_buy_lag_days", F.lit(None).cast("double"))
    row = sketches.spend_quantiles(sketches.spend_sketches(untimed)).first()
    assert row["median_lag_days"] is None and row["median_usd"] is not None


def test_distinct_and_overlap_against_exact(spark):
    from paylens.operators import sketches
    rows = spark.range(200_000).select(
        (F.abs(F.hash("id")) % 60_000).alias("player_id"), F.concat(F.lit("p"), F.col("id") % 4).alias("product_id"),
        F.expr("timestampadd(DAY, cast(id % 90 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("created_at"))
    cells = sketches.audience_sketches(rows, "player_id", ("product_id",), lg=12)
    exact = {r["product_id"]: r["n"] for r in rows.groupBy("product_id").agg(F.countDistinct("player_id").alias("n")).collect()}
    for r in sketches.distinct_people(cells, ("product_id",), lg=12).collect():
        assert abs(r["people"] / exact[r["product_id"]] - 1) < 3 / 64
    months = [{x["player_id"] for x in rows.filter(F.month("created_at") == m).select("player_id").distinct().collect()} for m in (1, 2, 3)]
    for r in sketches.month_overlap(cells, lg=12).collect():
        m = r["period_start"].month
        both = len(months[m - 1] & months[m - 2]) if m > 1 else 0
        assert abs(r["buyers"] / len(months[m - 1]) - 1) < 3 / 64 and abs(r["returning"] - both) < 0.1 * len(months[m - 1])
        assert abs(r["buyers"] - r["returning"] - r["others"]) <= 0.1 * r["buyers"]


def test_another_month_scans_no_transactions(spark):
    from paylens.operators import sketches
    from paylens.plans.workspace import workspace
    ws = workspace(spark, SF001)
    later = sketches.month_overlap(ws.buyer_sketches.filter("period_start >= '1995-01-01'"), 2)
    assert later.count() > 0 and all("buyer-sketches" in f for f in later.inputFiles())


def test_bucketed_join_moves_nothing(spark):
    from paylens.plans.workspace import Workspace
    ws = Workspace(spark, SF0001)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store, score = ws.bucketed
        joined = store.join(score, "player_id")
        plan = joined.groupBy("player_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert joined.count() == ws.store.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tables = list(ws._tables)
    ws.release()
    assert not any(spark.catalog.tableExists(t) for t in tables)


def test_tenants_are_replaced_one_by_one(spark, tmp_path):
    from paylens.sources.sinks import replace_tenants
    path = str(tmp_path / "store")
    rows = lambda *r: spark.createDataFrame(r, "player_id bigint, tenant string")
    replace_tenants(rows((1, "a"), (2, "b"), (3, "b")), path, "tenant")
    replace_tenants(rows((9, "b"), (8, "c")), path, "tenant")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (8, "c"), (9, "b")]
    assert os.path.isdir(path)


@pytest.mark.parametrize("bounds", [[], [5], [3, 3, 7, None], [-4, 0, 12, 100]])
def test_key_ranges_cover_every_row_once(spark, bounds):
    from paylens.sources.tables import key_ranges
    rows = spark.createDataFrame([(k,) for k in (*range(-6, 15), None, None, 3, 3)], "k int")
    parts = key_ranges("k", bounds)
    hits = rows.select(*[F.expr(f"coalesce(cast(({p}) as int), 0)").alias(f"p{i}") for i, p in enumerate(parts)])
    assert all(sum(r) == 1 for r in hits.collect())
    names = spark.createDataFrame([("a",), ("o'b",), (None,), ("z",)], "k string")
    texts = key_ranges("k", ["o'b", "m"])
    assert sum(names.filter(p).count() for p in texts) == 4


def test_quantile_query_names_every_split():
    from paylens.sources.tables import quantile_bounds_query
    q = quantile_bounds_query("game_session", "session_id", 4)
    assert [f"b{i}" in q for i in (1, 2, 3, 4)] == [True, True, True, False] and "percentile_disc(0.25)" in q
