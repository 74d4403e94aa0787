"""Thresholds, bands, weights and lever assumptions.

Every number an analysis uses is a parameter here. ``REFERENCE_PROFILE``
holds the published values; ``FIXTURE_PROFILE`` holds the values fitted
to the driver's synthetic tables (money there is in the 100k range and
activity spans years, so the published cuts would put everyone in one
bucket).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Band:
    """Ordered buckets over one numeric value.

    ``edges[i]`` closes bucket ``i``; ``inclusive[i]`` says whether the
    comparison is ``<=`` (True) or ``<`` (False). Values that pass no edge,
    and NULL values, fall into the last label (searched-CASE semantics).
    """
    edges: tuple[float, ...]
    labels: tuple[str, ...]
    inclusive: tuple[bool, ...] = ()

    def __post_init__(self):
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("a band needs one more label than edges")
        if self.inclusive and len(self.inclusive) != len(self.edges):
            raise ValueError("inclusive flags must match edges")

    def is_inclusive(self, i: int) -> bool:
        return bool(self.inclusive[i]) if self.inclusive else False


@dataclass(frozen=True)
class ScoreTerm:
    feature: str
    cap: float
    weight: float


@dataclass(frozen=True)
class Lift:
    """A behaviour signal: SQL boolean expressions over the store."""
    name: str
    high: str
    low: str


@dataclass(frozen=True)
class Config:
    name: str
    # why-pay / expand
    whale_usd: float = 75.0
    whale_label: str = "whale_75+"
    repeat_min: int = 2
    # payer DNA bands
    net_band: Band = Band((-5000, -500, 500, 5000),
                          ("big_loser", "loser", "even", "winner", "big_winner"),
                          (False, False, True, True))
    stake_band: Band = Band((100, 300, 800), ("<100", "100-300", "300-800", "800+"))
    # retention
    active_band: Band = Band((1, 7, 30), ("0", "1-6", "7-29", "30+"))
    # purchase frequency (on n_purchases, edges inclusive)
    freq_band: Band = Band((1, 3, 10), ("1 (one-time)", "2-3", "4-10", "11+"), (True, True, True))
    # propensity score
    score_terms: tuple[ScoreTerm, ...] = (
        ScoreTerm("pcoins_wagered", 2000.0, 30.0),
        ScoreTerm("max_streak", 30.0, 20.0),
        ScoreTerm("n_games_hosted", 20.0, 15.0),
        ScoreTerm("active_days", 30.0, 15.0),
        ScoreTerm("n_invited", 3.0, 10.0),
    )
    intent_weight: float = 10.0
    target_score: float = 40.0
    holdout_buckets: int = 5
    n_tiles: int = 10
    top_countries_target: int = 8
    top_countries_geo: int = 10
    # behaviour lift signals (high group, low group)
    lifts: tuple[Lift, ...] = (
        Lift("streak >= 7 days", "max_streak >= 7", "max_streak < 7"),
        Lift("wagered pcoins (>0)", "pcoins_wagered > 0", "pcoins_wagered = 0"),
        Lift("hosted >= 10 minigames", "n_games_hosted >= 10", "n_games_hosted < 10"),
        Lift("invited >= 1 friend", "n_invited >= 1", "n_invited = 0"),
        Lift("active >= 14 days", "active_days >= 14", "active_days < 14"),
        Lift("stated intent to pay (survey)", "stated_intent", "surveyed AND NOT stated_intent"),
        Lift("was invited in (vs organic)", "was_invited", "NOT was_invited"),
    )
    # levers: (name, assumption, rate)
    convert_rate: float = 0.03
    repeat_rate: float = 0.15
    prime_rate: float = 0.05
    prime_price: float = 48.0
    # model
    model_features: tuple[str, ...] = (
        "pcoins_wagered", "max_streak", "n_games_hosted", "active_days", "login_days",
        "n_invited", "n_rooms", "furniture_cnt", "n_feedings", "n_arcade",
        "stated_intent", "was_invited", "surveyed")
    neg_per_pos: int = 4
    reg_param: float = 1e-3
    max_iter: int = 100
    tol: float = 1e-6
    # guarded targeting (X2): net outcome below this is flagged
    loss_flag_net: float = -5000.0

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


# The defaults of Config (thresholds, weights, feature list, signal labels) are the published ones.
REFERENCE_PROFILE = Config(name="reference")

FIXTURE_PROFILE = Config(
    name="fixture",
    whale_usd=1_300_000.0,
    whale_label="whale_1.3m+",
    net_band=Band((-350, -100, 100, 350),
                  ("big_loser", "loser", "even", "winner", "big_winner"),
                  (False, False, True, True)),
    stake_band=Band((45, 49, 53), ("<45", "45-49", "49-53", "53+")),
    active_band=Band((1500, 2000, 2300), ("<1500", "1500-1999", "2000-2299", "2300+")),
    score_terms=(
        ScoreTerm("pcoins_wagered", 5000.0, 30.0),
        ScoreTerm("max_streak", 30.0, 20.0),
        ScoreTerm("n_games_hosted", 80.0, 15.0),
        ScoreTerm("active_days", 2400.0, 15.0),
        ScoreTerm("n_invited", 3.0, 10.0),
    ),
    lifts=(
        Lift("streak >= 14 days", "max_streak >= 14", "max_streak < 14"),
        Lift("wagered pcoins (>0)", "pcoins_wagered > 0", "pcoins_wagered = 0"),
        Lift("hosted >= 80 minigames", "n_games_hosted >= 80", "n_games_hosted < 80"),
        Lift("invited >= 1 friend", "n_invited >= 1", "n_invited = 0"),
        Lift("active >= 2000 days", "active_days >= 2000", "active_days < 2000"),
        Lift("stated intent to pay (survey)", "stated_intent", "surveyed AND NOT stated_intent"),
        Lift("was invited in (vs organic)", "was_invited", "NOT was_invited"),
    ),
    loss_flag_net=-350.0,
)

PROFILES = {c.name: c for c in (REFERENCE_PROFILE, FIXTURE_PROFILE)}
