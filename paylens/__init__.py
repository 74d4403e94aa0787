"""paylens: monetization analytics on Spark.

Turns first-party behaviour and revenue tables into a one-row-per-player
feature store with a payer label, and computes the analyses on top of it
(product mix, archetypes, payer DNA cross-tabs, lift, propensity deciles,
levers, a logistic model, reconciliation and a PII gate) as DataFrame /
Spark SQL / MLlib jobs.
"""

from paylens.config import Config, FIXTURE_PROFILE, REFERENCE_PROFILE  # noqa: F401
from paylens.session import get_session, ensure_checkpoint_dir  # noqa: F401

__all__ = ["Config", "FIXTURE_PROFILE", "REFERENCE_PROFILE", "get_session", "ensure_checkpoint_dir"]
