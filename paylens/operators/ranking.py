"""Global ranking without a single-partition window.

``row_number()``/``ntile()`` over an un-partitioned window plans
``Exchange SinglePartition``: every row goes through one task. Instead:

1. range-partition on the full (unique) sort key and sort inside each
   partition;
2. checkpoint reliably -- range bounds are sampled, so every later use
   must see the very same partitions (a cache could be recomputed with
   other bounds after an executor loss);
3. count rows per partition (a table with one row per partition, a
   proven size bound), turn the counts into offsets and broadcast them;
4. global rank = partition offset + position inside the partition.

Everything after the range exchange is narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions.exact import round_ratio
from paylens.session import ensure_checkpoint_dir

_IDX_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      num_partitions: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Add a 1-based global row number following ``order`` (make it unique),
    and ``<name>_total``; with ``by`` both restart per group.

    Groups are ranges of the same sort (``by`` first), so a group that holds
    most rows still spreads over partitions. Without ``num_partitions`` the
    range exchange is sized by AQE from the data (adjacent ranges are
    coalesced, so order is kept): a 10k-row holdout becomes one partition, a
    billion rows a few hundred. The checkpoint then freezes the layout.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [*[F.col(c) for c in by], *order]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).checkpoint(eager=True)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.select("*", F.shiftrightunsigned("_mid", _IDX_BITS).alias("_part"),
                           F.col("_mid").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)).alias("_idx"))
    counts = tagged.groupBy(F.col("_part").alias("_pid"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]).agg(
        F.count("*").alias("_n"), F.min("_idx").alias("_first"))
    group = Window.partitionBy(*[f"_by{i}" for i in range(len(by))])
    before = group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *[f"_by{i}" for i in range(len(by))],
                            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"),
                            F.sum("_n").over(group).alias("_total"))
    # one row per partition is a proven bound; with groups the planner decides
    side = offsets if by else F.broadcast(offsets)
    cond = F.col("_part") == F.col("_pid")
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return (tagged.join(side, cond).withColumn(name, F.col("_off") + F.col("_idx") + 1)
            .withColumnRenamed("_total", f"{name}_total")
            .drop("_mid", "_part", "_idx", "_pid", "_off", *[f"_by{i}" for i in range(len(by))]))


def ntile(df: DataFrame, order: list[Column], tiles: int, name: str = "tile", by: tuple[str, ...] = ()) -> DataFrame:
    """SQL ``ntile(tiles) OVER (PARTITION BY by ORDER BY order)``: sizes differ
    by at most one, larger tiles first."""
    ranked = global_row_number(df, order, "_rn", by=by)
    rn, total = F.col("_rn"), F.col("_rn_total")
    q = F.call_function("div", total, F.lit(tiles))
    r = total % tiles
    big = r * (q + 1)
    first = F.call_function("div", rn - 1, q + 1) + 1
    rest = F.call_function("div", rn - 1 - big, F.greatest(q, F.lit(1))) + 1 + r
    return ranked.withColumn(name, F.when(rn <= big, first).otherwise(rest).cast("int")) \
        .drop("_rn", "_rn_total")


def top_rows(counts: DataFrame, order: list[Column], n: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The first ``n`` rows by ``order`` (per ``by`` group) of an aggregated table."""
    if not by:
        return counts.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return counts.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def score_report(df: DataFrame, score: str, label: str, key: str, parts: int = 10,
                 digits: int = 3) -> DataFrame:
    """Tie-aware AUC and top-1/parts lift of a score, from one global ranking.

    Rows are ranked ascending by (score, key desc), so the last
    floor(n/parts) rows are the top rows by (score desc, key asc).
    AUC (Mann-Whitney, mid-ranks for ties; NULL if a class is empty): the
    sum of positive ranks is sum over distinct scores of
    pos(s) * (rows below s + (count(s) + 1) / 2). One row out.
    """
    ranked = global_row_number(df.select(score, label, key),
                               [F.col(score), F.col(key).desc()], "_rn")
    n = F.col("_rn_total")
    top = F.col("_rn") > n - F.call_function("div", n, F.lit(parts))
    y = F.col(label).cast("bigint")
    per_score = ranked.groupBy(score).agg(
        F.min("_rn").alias("_first"), F.count("*").alias("_n"), F.sum(y).alias("_pos"),
        F.count(F.when(top, 1)).alias("_top_n"), F.sum(F.when(top, y)).alias("_top_pos"))
    # rank sums and P*N pass 64 bits at ~3e9 rows: keep them in 38 digits
    D = "decimal(38,0)"
    twice_rank_pos = F.sum(F.col("_pos").cast(D) * (F.col("_first") * 2 + F.col("_n") - 1))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))  # noqa: E731  counts of an empty input are 0
    p = total("_pos")
    neg = total("_n") - p
    return per_score.agg(
        total("_n").alias("n"), p.alias("positives"), neg.alias("negatives"),
        round_ratio(twice_rank_pos - p.cast(D) * (p + 1), p.cast(D) * neg * 2, digits, wide=True).alias("auc"),
        total("_top_n").alias("top_n"), total("_top_pos").alias("top_positives"))


def percentiles_cont(df: DataFrame, value: Column, key: Column, fractions: list[tuple[int, int]],
                     unit: int, digits: int, keep: tuple[str, ...] = (),
                     extra: tuple[Column, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """Exact ``percentile_cont(a/b)`` of an integral column, one row (per ``by`` group).

    For each fraction a/b: position a(n-1)/b splits into rank lo = a(n-1) div b
    and remainder f = a(n-1) mod b; the result is
    (v[lo+1] * b + (v[lo+2] - v[lo+1]) * f) / (b * unit), rounded to
    ``digits``. ``key`` breaks ties so a hot value spreads over partitions.
    ``keep`` columns ride along for the ``extra`` aggregates, which are
    computed in the same pass. Columns: ``n``, ``p<i>`` per fraction, extras.
    """
    ranked = global_row_number(df.select(*by, value.alias("_v"), key.alias("_k"), *keep),
                               [F.col("_v"), F.col("_k")], "_rn", by=by)
    n = F.col("_rn_total")
    aggs = [F.count("*").alias("n")]
    for i, (a, b) in enumerate(fractions):
        pos = (n - 1) * a
        lo = F.call_function("div", pos, F.lit(b)) + 1
        hi = F.least(lo + 1, n)
        aggs += [F.max(F.when(F.col("_rn") == lo, F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(F.col("_rn") == hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.max(pos % b).alias(f"_f{i}")]
    picked = ranked.groupBy(*by).agg(*aggs, *extra)
    outs = [*by, F.col("n")]
    for i, (a, b) in enumerate(fractions):
        lo_v, hi_v, f = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        num = lo_v * b + (hi_v - lo_v) * f
        outs.append(round_ratio(num, F.lit(b * unit), digits, wide=True).alias(f"p{i}"))
    names = [c for c in picked.columns if not c.startswith("_") and c != "n" and c not in by]
    return picked.select(*outs, *names)
