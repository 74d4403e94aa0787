"""Survey answer recoding (age bucket, stated intent)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# These must equal the source system's survey vocabulary.
# Age answer -> age bucket; anything else (including empty) -> 'unknown'.
AGE_BUCKETS = {
    "13-17": "under_18",
    "18-24": "18_24", "18-22": "18_24",
    "25-34": "25_34", "23-27": "25_34", "28-35": "25_34",
    "35-44": "35_44", "36-45": "35_44",
    "45-54": "45_plus", "55-64": "45_plus", "65+": "45_plus", "46+": "45_plus",
}
# Answers that count as stated intent to pay.
PRICE_FEELING_INTENT = ("fair", "cheap")
PAY_STATE_INTENT = ("once", "many", "considering", "pcoins_only", "prime_only", "both")
WOULD_PAY_FOR_NONE = ("[]", '["nothing"]')
HALF_OFF_INTENT = ("yes", "maybe")

# Keys read from one survey response document.
RESPONSE_FIELDS = ("ageRange", "age", "priceFeeling", "wouldPayFor", "boughtPcoins",
                   "paymentStatus", "halfOffWouldTry", "neverBoughtReason")
RESPONSE_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in RESPONSE_FIELDS])


def age_bucket(age_raw: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(AGE_BUCKETS.items())])
    return F.coalesce(mapping[F.coalesce(age_raw, F.lit(""))], F.lit("unknown"))


def stated_intent(price_feeling: Column, pay_state: Column, would_pay_for: Column,
                  half_off: Column) -> Column:
    """Lenient intent; three-valued OR, unknown -> false."""
    names_item = would_pay_for.isNotNull() & ~would_pay_for.isin(*WOULD_PAY_FOR_NONE)
    return F.coalesce(
        price_feeling.isin(*PRICE_FEELING_INTENT)
        | pay_state.isin(*PAY_STATE_INTENT)
        | names_item
        | half_off.isin(*HALF_OFF_INTENT),
        F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)
