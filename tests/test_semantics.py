"""
FIXTURES.md section 4). Expected values are derived by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylens.config import REFERENCE_PROFILE as REF

T0 = dt.datetime(2025, 1, 1)


def day(n, h=0):
    return T0 + dt.timedelta(days=n, hours=h)


def player(pid, created=T0, last=None, deleted=False, invited_by=None, country="TW"):
    return (pid, created, last or day(40), country, None, None, "organic", invited_by, deleted, 1.0, 2.0, None)


def store_of(spark, roles, cfg=REF):
    from paylens.operators.features import feature_store
    from paylens.operators.propensity import with_propensity
    return with_propensity(feature_store(roles), cfg)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_latest_survey_null_time_wins_and_ties_break(spark, roles):
    from paylens.operators.features import latest_survey
    r = roles(survey_response=[
        (1, 7, day(1), '{"priceFeeling":"old"}'),
        (2, 7, None, '{"priceFeeling":"nulltime"}'),
        (3, 7, day(5), '{"priceFeeling":"new"}'),
        (4, 8, day(5), '{"priceFeeling":"a"}'),
        (5, 8, day(5), '{"priceFeeling":"b"}'),
    ])
    got = {x.player_id: x.price_feeling for x in latest_survey(r.survey_response).collect()}
    assert got == {7: "nulltime", 8: "b"}


@pytest.mark.parametrize("doc,expect", [
    ('{"wouldPayFor": null}', False),          # JSON null: read as absent (documented reading)
    ('{"wouldPayFor": ""}', True),             # a non-list text names something
    ('{"wouldPayFor": []}', False),
    ('{"wouldPayFor": ["nothing"]}', False),
    ('{}', False),
    ('{"wouldPayFor": ["hat"]}', True),
    ('{"priceFeeling": "cheap"}', True),
    ('{"boughtPcoins": "", "paymentStatus": "many"}', True),
    ('{"halfOffWouldTry": "no"}', False),
])
def test_stated_intent(spark, roles, doc, expect):
    r = roles(player=[player(1)], survey_response=[(1, 1, day(1), doc)])
    s = one(store_of(spark, r))
    assert s.stated_intent is expect and s.surveyed is True


def test_unsurveyed_intent_is_false_not_null(spark, roles):
    s = one(store_of(spark, roles(player=[player(1)])))
    assert s.stated_intent is False and s.surveyed is False and s.age_bucket == "unknown"


def test_modal_game_ties_and_nulls(spark, roles):
    from paylens.operators.features import wager_profile

    def sess(i, host, game):
        return (i, host, game, Decimal("1.00"), Decimal("2.00"), "[]", [], day(1))
    r = roles(game_session=[sess(1, 1, "b"), sess(2, 1, "a"), sess(3, 1, "b"), sess(4, 1, "a"),
                            sess(5, 2, None), sess(6, 2, None), sess(7, 2, None), sess(8, 2, "a")])
    got = {x.player_id: (x.fav_game, x.n_games_hosted) for x in wager_profile(r.game_session).collect()}
    assert got == {1: ("a", 4), 2: ("a", 4)}


def test_admin_grant_prime_only_and_negative_lag(spark, roles):
    from paylens.operators.growth import conversion_moment
    from paylens.operators.payer_dna import payer_psychology
    from paylens.operators.economy import player_game_economy
    r = roles(
        player=[player(1, created=day(10)), player(2), player(3, created=day(10))],
        pcoin_transaction=[(1, 1, "p", None, "completed", day(12)),           # admin grant, NULL price
                           (2, 3, "p", Decimal("5.00"), "completed", day(9))],  # bought before signup
        prime_subscription_event=[(2, Decimal("4.99"), "RENEWAL", day(3))],
        game_session=[(1, 1, "x", Decimal("1.00"), Decimal("2.00"), '[{"playerId":"1"},{"playerId":"3"}]',
                       ["1"], day(1))])
    s = store_of(spark, r)
    got = {x.player_id: x for x in s.collect()}
    assert got[1].is_payer and got[1].lifetime_usd == Decimal("0.00") and got[1].first_buy_lag_days == 2.0
    assert got[2].is_payer and got[2].first_buy_lag_days is None and got[2].is_prime_real
    assert got[3].first_buy_lag_days == -1.0
    psych = {x.grp: x.players for x in payer_psychology(s, REF).collect()}
    assert psych == {"regular_payer": 1}  # player 1 (0 usd) is excluded, player 3 counted
    cm = one(conversion_moment(s))
    assert cm.same_day_pct == 50.0 and cm.within_7d_pct == 100.0 and cm.median_lag_days == 0.5


def test_active_days_floor(spark, roles):
    r = roles(player=[player(1, created=day(5), last=day(2)),
                      (2, day(1), None, "TW", None, None, "o", None, False, None, None, None),
                      player(3, created=day(0), last=day(1, 12))])
    got = {x.player_id: (x.active_days, x.pcoins_balance, x.login_days) for x in store_of(spark, r).collect()}
    assert got == {1: (0.0, 1.0, 0), 2: (0.0, 0.0, 0), 3: (1.5, 1.0, 0)}


def test_deleted_players_leave_store_but_count_as_invitees(spark, roles):
    r = roles(player=[player(1), player(2, deleted=True, invited_by=1), player(3, invited_by=1),
                      (4, T0, day(1), None, None, None, "o", None, None, 0.0, 0.0, None)])
    got = {x.player_id: x.n_invited for x in store_of(spark, r).collect()}
    assert got == {1: 2, 3: 0}  # NULL is_deleted is dropped like the reference's NOT is_deleted


def test_participants_edge_cases(spark, roles):
    from paylens.operators.economy import player_game_economy

    def sess(i, parts, winners, bet="10.00"):
        return (i, 1, "g", Decimal(bet) if bet else None, Decimal("20.00"), parts, winners, day(1))
    r = roles(game_session=[
        sess(1, '{"playerId":"5"}', ["5"]),                              # bare object: no rows
        sess(2, 'not json', ["5"]),                                      # broken text: no rows
        sess(3, '[{"playerId":"6"},{"playerId":"6"}]', ["6"]),           # duplicate: counted twice
        sess(4, '[{"playerId":null},{"other":1},{"playerId":"7"}]', None),  # null ids dropped; NULL winners
        sess(5, '[{"playerId":"8"}]', ["8"], bet=None),                  # NULL bet
    ])
    got = {x.player_id: (x.games, x.wagered, x.wins, x.won) for x in player_game_economy(r.game_session).collect()}
    assert got == {6: (2, Decimal("20.00"), 2, Decimal("40.00")),
                   7: (1, Decimal("10.00"), 0, Decimal("0.00")),
                   8: (1, None, 1, Decimal("20.00"))}


def test_null_stake_and_net_fall_to_last_band(spark, roles):
    from paylens.functions.buckets import band_ord, band_ord_ratio
    df = spark.createDataFrame([(None, 1), (Decimal("100.00"), 1)], "w decimal(18,2), g bigint")
    got = [r[0] for r in df.select(band_ord_ratio(F.col("w"), F.col("g"), REF.stake_band)).collect()]
    assert got == [4, 2]
    nets = spark.createDataFrame([(-5000,), (-500,), (500,), (5000,), (None,)], "n int")
    labels = [REF.net_band.labels[r[0] - 1] for r in nets.select(band_ord(F.col("n"), REF.net_band)).collect()]
    assert labels == ["loser", "even", "even", "winner", "big_winner"]


def _lift_store(spark, high_payers, high_n, low_payers, low_n):
    rows = []
    pid = 0
    for n, payers, streak in ((high_n, high_payers, 10), (low_n, low_payers, 1)):
        for i in range(n):
            pid += 1
            rows.append((pid, i < payers, streak))
    return spark.createDataFrame(rows, "player_id bigint, is_payer boolean, max_streak int")


def test_lift_uses_rounded_pcts_and_null_for_empty_low(spark):
    from paylens.config import Lift
    from paylens.operators.behaviour import predictor_lift
    cfg = REF.with_(lifts=(Lift("s", "max_streak >= 7", "max_streak < 7"),
                           Lift("z", "max_streak >= 0", "max_streak < 0")))
    got = {r.feature: r for r in predictor_lift(_lift_store(spark, 5, 1600, 1, 1600), cfg).collect()}
    assert (got["s"].high_pct, got["s"].low_pct, got["s"].lift) == (0.31, 0.06, 5.2)
    assert got["z"].lift is None and got["z"].low_pct is None


@pytest.mark.parametrize("n,sizes", [(7, [1] * 7), (10, [1] * 10), (23, [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]),
                                     (34661, [3467] + [3466] * 9)])
def test_ntile_sizes(multi_partition, n, sizes):
    spark = multi_partition
    from paylens.operators.ranking import ntile
    df = spark.range(n).select(F.col("id"), (F.col("id") % 13).alias("score"))
    t = ntile(df, [F.col("score"), F.col("id")], 10, "tile")
    got = sorted((r.tile, r.c) for r in t.groupBy("tile").agg(F.count("*").alias("c")).collect())
    assert [c for _, c in got] == sizes
    # order is respected: every row of tile k scores <= every row of tile k+1
    bounds = t.groupBy("tile").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).orderBy("tile").collect()
    assert all(a.hi <= b.lo for a, b in zip(bounds, bounds[1:]))


def test_ntile_matches_sql_ntile(multi_partition):
    spark = multi_partition
    from paylens.operators.ranking import ntile
    df = spark.range(1003).select(F.col("id"), ((F.col("id") * 7919) % 97).alias("s"))
    mine = {r.id: r.t for r in ntile(df, [F.col("s"), F.col("id")], 10, "t").collect()}
    df.createOrReplaceTempView("nt")
    ref = {r.id: r.t for r in spark.sql("SELECT id, ntile(10) OVER (ORDER BY s, id) AS t FROM nt").collect()}
    assert mine == ref


def test_auc_ties_and_one_class(spark):
    from paylens.operators.ranking import score_report
    df = spark.createDataFrame([(1, .1, 0), (2, .4, 0), (3, .4, 1), (4, .8, 1)], "k long, s double, y int")
    assert one(score_report(df, "s", "y", "k")).auc == 0.875
    df0 = spark.createDataFrame([(1, .1, 0), (2, .4, 0)], "k long, s double, y int")
    assert one(score_report(df0, "s", "y", "k")).auc is None


def test_percentiles_match_interpolation(spark):
    from paylens.operators.ranking import percentiles_cont
    import numpy as np
    vals = [5, 1, 9, 9, 3, 7, 100, 2, 2, 8, 40]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v long")
    r = one(percentiles_cont(df, F.col("v"), F.col("k"), [(1, 2), (9, 10), (99, 100)], 1, 6))
    for got, q in zip((r.p0, r.p1, r.p2), (.5, .9, .99)):
        assert got == pytest.approx(float(np.percentile(vals, q * 100)), abs=1e-9)


def test_zero_variance_feature_scales_to_zero(spark):
    from paylens.operators import model
    cfg = REF.with_(model_features=("a", "b"))
    m = spark.createDataFrame([(i, 0, i % 2, 3.0, float(i)) for i in range(10)],
                              "player_id long, is_test int, y int, a double, b double")
    mo = model.Moments.of(model.feature_moments(m, cfg))
    assert mo.sd["a"] == 1.0 and mo.mean["a"] == 3.0
    z = model.standardize(m, mo, cfg)
    assert {r.a for r in z.collect()} == {0.0}
    assert mo.sd["b"] == pytest.approx(float(__import__("numpy").std(range(10))))


def test_pii_gate_raises_on_nested_uuid_and_email(spark):
    from paylens.operators.quality import PIIGateError, assert_no_pii, pii_scan
    df = spark.createDataFrame([({"k": "123e4567-e89b-12d3-a456-426614174000"}, "fine")],
                               "m map<string,string>, t string")
    with pytest.raises(PIIGateError, match="uuid"):
        assert_no_pii(df)
    df2 = spark.createDataFrame([("write to a.b@example.com",)], "t string")
    with pytest.raises(PIIGateError, match="email"):
        assert_no_pii(df2)
    clean = spark.createDataFrame([("no personal data",)], "t string")
    assert_no_pii(clean)
    assert {r.kind: r.violations for r in pii_scan(df2, "x").collect()} == {"uuid": 0, "email": 1}


def test_empty_store_gives_null_rates(spark, roles):
    from paylens.operators import growth, headline, social, why_pay
    s = store_of(spark, roles())
    h = one(headline.headline(s))
    assert h.players == 0 and h.payer_pct is None and h.arppu_usd is None
    assert one(why_pay.cosmetics_gap(s)).pct is None
    assert one(social.social_rates(s)).organic_payer_pct is None
    assert one(growth.wagered_share_of_payers(s)).wagered_before_paying_pct is None
    assert one(growth.whale_concentration(s)).median_usd is None


def test_json_room_columns(spark, roles):
    from paylens.operators.features import owned_items
    r = roles(room=[(1, '["a","b"]', '{"x":1,"y":2}'), (1, None, None), (2, '{"not":"array"}', '[1]'),
                    (None, '["z"]', '{}')])
    got = {x.player_id: (x.furniture_cnt, x.wardrobe_cnt) for x in owned_items(r.room).collect()}
    assert got == {1: (2, 2), 2: (None, None)}


def test_exact_rounding_half_away_from_zero(spark):
    from paylens.functions.exact import round_ratio
    df = spark.createDataFrame([(145, 100), (-145, 100), (1, 3), (2, 3), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), 1)).collect()]
    assert got == [1.5, -1.5, 0.3, 0.7, None]


def test_approximate_options_stay_close(spark):
    """Named approximate options: HLL distinct counts and
    percentile_approx track the exact operators."""
    from paylens.operators.growth import whale_concentration
    from paylens.operators.why_pay import product_mix
    from paylens.plans.workspace import workspace
    from tests.conftest import SF001
    ws = workspace(spark, SF001)
    exact = {r.product_id: r.ppl for r in product_mix(ws.roles.pcoin_transaction).collect()}
    approx = {r.product_id: r.ppl for r in product_mix(ws.roles.pcoin_transaction, approx_rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= 0.06 * exact[k] for k in exact)
    e, a = whale_concentration(ws.store).first(), whale_concentration(ws.store, approx_accuracy=100000).first()
    assert a.payers == e.payers and a.max_usd == e.max_usd
    for f in ("median_usd", "p90_usd", "p99_usd"):
        assert abs(a[f] - e[f]) <= 0.05 * abs(e[f])


def test_login_dates_as_json_text(spark):
    from paylens.operators.features import player_base
    df = spark.createDataFrame(
        [(1, T0, day(3), None, None, None, "o", None, False, 1.0, 0.0, '["2025-01-01","2025-01-02"]'),
         (2, T0, day(3), None, None, None, "o", None, False, 1.0, 0.0, None)],
        "player_id bigint, created_at timestamp_ntz, last_seen timestamp_ntz, country_code string, gender string, "
        "language string, acquisition_source string, invited_by bigint, is_deleted boolean, pcoins double, "
        "coins double, login_dates string")
    assert {r.player_id: r.login_days for r in player_base(df).collect()} == {1: 2, 2: 0}


def test_mixed_id_types_and_letter_case(spark, roles):
    """Typed participants with text winners; text keys match whatever their case."""
    from paylens.operators.economy import player_game_economy
    from paylens.operators.features import feature_store
    from paylens.sources.bindings import KEY_COLUMNS, RoleTables
    s = spark.createDataFrame([([1, 2, 1], ["1"], 10, 30)], "participants array<bigint>, winner_ids array<string>, "
                              "bet_amount int, total_pot int")
    got = {r.player_id: (r.games, r.wins) for r in player_game_economy(s).collect()}
    assert got == {1: (2, 2), 2: (1, 0)}
    tables = roles(player=[(1, None, None, "TW", None, None, "ads", None, False, 0.0, 0.0, None)],
                   player_room=[(1, 7)]).as_dict()
    text = lambda df: df.withColumns({c: F.concat(F.lit("Ab-"), F.col(c)) for c in KEY_COLUMNS if c in df.columns})
    tables = {k: text(v) for k, v in tables.items()}
    tables["player_room"] = tables["player_room"].withColumn("player_id", F.upper("player_id"))
    r = feature_store(RoleTables(**tables)).first()
    assert (r.player_id, r.max_streak) == ("ab-1", 7)
