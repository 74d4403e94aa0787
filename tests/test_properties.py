"""Property tests: distributed / exact primitives against brute force."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=30),
       st.integers(0, 3))
def test_round_ratio_is_decimal_half_up(spark, pairs, digits):
    from paylens.functions.exact import round_ratio
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), digits)).collect()]
    q = Decimal(1).scaleb(-digits)
    want = [float((Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


@SLOW
@given(st.lists(st.integers(0, 6), min_size=1, max_size=120), st.integers(1, 12))
def test_ntile_equals_sql_ntile(multi_partition, scores, tiles):
    spark = multi_partition
    from paylens.operators.ranking import ntile
    df = spark.createDataFrame(list(enumerate(scores)), "id long, s long")
    mine = {r.id: r.t for r in ntile(df, [F.col("s"), F.col("id")], tiles, "t").collect()}
    df.createOrReplaceTempView("prop_nt")
    ref = {r.id: r.t for r in spark.sql(f"SELECT id, ntile({tiles}) OVER (ORDER BY s, id) AS t FROM prop_nt").collect()}
    assert mine == ref


@SLOW
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=80))
def test_percentiles_equal_numpy_linear(multi_partition, vals):
    spark = multi_partition
    from paylens.operators.ranking import percentiles_cont
    df = spark.createDataFrame(list(enumerate(vals)), "k long, v long")
    r = percentiles_cont(df, F.col("v"), F.col("k"), [(1, 2), (9, 10), (99, 100)], 1, 6).first()
    for got, q in zip((r.p0, r.p1, r.p2), (50, 90, 99)):
        assert got == pytest.approx(float(np.percentile(vals, q)), abs=1e-6)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=2, max_size=80))
def test_auc_equals_pairwise_count(multi_partition, rows):
    spark = multi_partition
    from paylens.operators.ranking import score_report
    df = spark.createDataFrame([(i, float(s), int(y)) for i, (s, y) in enumerate(rows)], "k long, s double, y int")
    got = score_report(df, "s", "y", "k", 10, 6).first()
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    if not pos or not neg:
        assert got.auc is None
        return
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    want = float((Decimal(wins) / Decimal(len(pos) * len(neg))).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    assert got.auc == want
    k = len(rows) // 10
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][0], i))
    assert got.top_n == k and (got.top_positives or 0) == sum(rows[i][1] for i in order[:k])


def test_global_row_number_crosses_partitions(multi_partition):
    """Offsets from many range partitions reproduce SQL row_number exactly."""
    from paylens.operators.ranking import global_row_number
    spark = multi_partition
    df = spark.range(5000).select(F.col("id"), ((F.col("id") * 7919) % 101).alias("s"))
    ranked = global_row_number(df, [F.col("s"), F.col("id")], "rn", num_partitions=7)
    assert ranked.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    mine = {r.id: r.rn for r in ranked.collect()}
    df.createOrReplaceTempView("grn")
    ref = {r.id: r.rn for r in spark.sql("SELECT id, row_number() OVER (ORDER BY s, id) AS rn FROM grn").collect()}
    assert mine == ref
    auto = global_row_number(df, [F.col("s"), F.col("id")], "rn")
    assert {r.id: r.rn for r in auto.collect()} == ref


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 10**18).flatmap(
    lambda d: st.tuples(st.integers(-(10**16) * d, (10**16) * d), st.just(d))), min_size=1, max_size=20),
       st.integers(0, 2))
def test_wide_round_ratio_is_exact_for_huge_values(spark, pairs, digits):
    """decimal(38,0) path (lever sizing): exact for operands far beyond 64
    bits, as long as the rounded, scaled quotient fits in 64 bits."""
    from hypothesis import assume
    from pyspark.sql.types import DecimalType, StructField, StructType
    assume(all(abs(n) // d * 10 ** digits < 2 ** 62 for n, d in pairs))

    from paylens.functions.exact import round_ratio_scaled
    schema = StructType([StructField("n", DecimalType(38, 0)), StructField("d", DecimalType(38, 0))])
    df = spark.createDataFrame([(Decimal(n), Decimal(d)) for n, d in pairs], schema)
    got = [int(r[0]) for r in df.select(round_ratio_scaled(F.col("n"), F.col("d"), digits, wide=True)).collect()]
    want = [int((Decimal(n) / Decimal(d)).scaleb(digits).quantize(Decimal(1), rounding=ROUND_HALF_UP))
            for n, d in pairs]
    assert got == want
