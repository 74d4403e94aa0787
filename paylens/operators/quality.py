"""V1 revenue reconciliation and V2 personal-data gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.exact import round_ratio

# The shapes the gate refuses to let out.
UUID_PATTERN = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PII_PATTERNS = (("uuid", UUID_PATTERN), ("email", EMAIL_PATTERN))
# A literal every match must contain: a cheap substring test skips the
# regex on texts that cannot match (same result, far less backtracking).
_MUST_CONTAIN = {"uuid": "-", "email": "@"}
# What the scan runs. Whether a text holds an email does not depend on how
# many characters stand before the "@": one is enough, and without the "+"
# a long run of word characters is read once instead of once per position.
_SCAN_PATTERNS = {"uuid": UUID_PATTERN, "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}


def revenue_reconciliation(second_source: DataFrame, store: DataFrame, tolerance_pct: float = 5.0) -> DataFrame:
    """V1: both totals side by side, difference, a tolerance flag and a note in words (ours)."""
    return reconcile(second_source, store.select(F.sum("lifetime_usd").cast("decimal(38,2)")), tolerance_pct)


def reconcile(second_source: DataFrame, total: DataFrame, tolerance_pct: float = 5.0) -> DataFrame:
    """V1 for a database total that is known already (one row, one column)."""
    db_total = total.scalar()
    rc = F.col("revenue_usd")
    diff = (db_total - rc).cast("decimal(38,2)")
    # totals may pass 64 bits in cents: widen before the factor of 100
    wide = lambda c: (c * 100).cast("decimal(38,0)")
    diff_pct = round_ratio(wide(diff) * 100, wide(rc), 2, wide=True)
    near = F.abs(diff_pct) <= tolerance_pct
    note = (F.when(near, f"database revenue agrees with the second source within {tolerance_pct} %")
            .when(~near, f"database revenue differs from the second source by more than {tolerance_pct} %")
            .otherwise("one of the totals is missing"))
    return second_source.select(
        # fixed values: the published field names
        rc.alias("rc_total_revenue_usd"), db_total.alias("db_total_revenue_usd"),
        F.col("active_users_28d").alias("rc_active_users_28d"), diff.alias("diff_usd"),
        diff_pct.alias("diff_pct"), near.alias("within_tolerance"), note.alias("note"))


def _text_columns(df: DataFrame) -> list[tuple[str, F.Column]]:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out.append((f.name, F.col(f.name)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append((f.name, F.to_json(F.col(f.name))))
    return out


def pii_scan(df: DataFrame, table: str) -> DataFrame:
    """V2: per-column count of rows holding uuid- or email-shaped text.

    One pass; every text column (nested ones rendered as JSON) is searched
    whole. Columns: table, column, kind, violations.
    """
    cols = _text_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "table string, column string, kind string, violations bigint")
    # render nested columns once, below the aggregate, for both patterns
    texts = df.select(*[c.alias(f"t{i}") for i, (_, c) in enumerate(cols)])
    one = texts.agg(*[_violations(F.col(f"t{i}"), kind).alias(f"{name}__{kind}")
                      for i, (name, _) in enumerate(cols) for kind, _ in PII_PATTERNS])
    rows = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(name).alias("column"),
                              F.lit(kind).alias("kind"), F.col(f"`{name}__{kind}`").alias("violations"))
                     for name, _ in cols for kind, _ in PII_PATTERNS])
    return one.select(F.inline(rows))


class PIIGateError(ValueError):
    pass


def _violations(text: F.Column, kind: str) -> F.Column:
    return F.count(F.when(text.contains(_MUST_CONTAIN[kind]) & text.rlike(_SCAN_PATTERNS[kind]), 1))


def gated(df: DataFrame, table: str) -> tuple[DataFrame, Callable[[], None]]:
    """V2 inside a write: ``df`` that counts its violations while it is written, and
    the check to call after the write and before publishing what it wrote."""
    counts = [_violations(c, kind).alias(f"{name}: {kind}") for name, c in _text_columns(df) for kind, _ in PII_PATTERNS]
    if not counts:
        return df, lambda: None
    seen = Observation()

    def check():
        hits = {k: n for k, n in seen.get.items() if n}
        if hits:
            raise PIIGateError(f"PII gate: {table} holds personal-data-shaped values ({hits})")
    return df.observe(seen, *counts), check


def assert_no_pii(df: DataFrame, table: str = "output") -> None:
    """The gate: refuse ``df`` if one of its texts has the shape of a personal identifier."""
    hits = pii_scan(df, table).filter(F.col("violations") > 0).collect()  # at most 2 rows per column
    if hits:
        desc = ", ".join(f"{h['column']}: {h['violations']} {h['kind']}" for h in hits)
        raise PIIGateError(f"PII gate: {table} holds personal-data-shaped values ({desc})")
