"""The second, independent revenue source.

Production: one nested JSON document (``revenue_total.revenue_usd``,
``overview_28d.active_users_28d``). Test binding: line-item revenue
sum(extendedprice * (1 - discount) * (1 + tax)) in exact decimals, and
distinct event users in the last 28 days of the event stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.exact import cents_of_double, cents_to_money, round_ratio_scaled
from paylens.sources.tables import Tables

ACTIVE_WINDOW_DAYS = 28


def read_revenue_document(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select(F.col("revenue_total.revenue_usd").cast("decimal(38,2)").alias("revenue_usd"),
                      F.col("overview_28d.active_users_28d").cast("bigint").alias("active_users_28d"))


def lineitem_revenue_source(t: Tables) -> DataFrame:
    li = t("lineitem")
    c = lambda name: cents_of_double(F.col(name))
    # price, discount and tax carry two decimals: the product is exact in
    # 1e-6 units and fits 64 bits per row; only the sum needs 38 digits
    micro = c("l_extendedprice") * (F.lit(100) - c("l_discount")) * (F.lit(100) + c("l_tax"))
    revenue = cents_to_money(round_ratio_scaled(F.sum(micro.cast("decimal(38,0)")), F.lit(10000), 0, wide=True))
    # a user is active if their own last event is inside the window. Both the
    # newest moment and the count read the same per-user aggregate, whose
    # exchange Spark reuses: one scan of the events and no distinct
    last = t("events").groupBy("user_id").agg(F.max("ts").alias("last_ts")).filter(F.col("user_id").isNotNull())
    newest = last.select(F.max("last_ts")).scalar()
    active = (last.filter(F.col("last_ts") > newest - F.expr(f"INTERVAL {ACTIVE_WINDOW_DAYS} DAYS"))
              .select(F.count("*")).scalar())
    return li.agg(revenue.alias("revenue_usd")).select("revenue_usd", active.alias("active_users_28d"))
