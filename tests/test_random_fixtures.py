"""Brute force on adversarial fixtures: random role tables full of NULLs,
ties, duplicates and odd JSON; the Spark store against plain Python, player by
player, and the game economy against DuckDB (per-element unnesting)."""

import datetime as dt
import json
import random
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import duckdb
import pytest

from paylens.functions.survey import (AGE_BUCKETS, HALF_OFF_INTENT, PAY_STATE_INTENT,
                                      PRICE_FEELING_INTENT, WOULD_PAY_FOR_NONE)
from paylens.operators.features import STORE_COLUMNS

T0 = dt.datetime(2025, 1, 1)

RESPONSES = [
    '{"ageRange":"18-24","priceFeeling":"fair"}', '{"age":"46+","wouldPayFor":["hat","cape"]}',
    '{"ageRange":"","age":"13-17","wouldPayFor":[]}', '{"wouldPayFor":["nothing"],"halfOffWouldTry":"yes"}',
    '{"wouldPayFor":null,"boughtPcoins":"","paymentStatus":"considering"}', '{"boughtPcoins":"once"}',
    '{"priceFeeling":"","halfOffWouldTry":"no","neverBoughtReason":"price"}', '{}',
    '{"ageRange":25,"priceFeeling":"cheap"}', '{"wouldPayFor":"everything"}',
]
PARTICIPANTS = [
    '[{"playerId":"{a}"},{"playerId":"{b}"}]', '[{"playerId":"{a}"},{"playerId":"{a}"}]',
    '[{"playerId":{a}},5,"x",null,{"other":1},{"playerId":"{b}"}]', '{"playerId":"{a}"}', 'not json',
    '[]', '[{"playerId":null},{"playerId":"{b}"}]',
]
FURNITURE = ['[]', '["a"]', '["a","b","c"]', None, '{"x":1}']
WARDROBE = ['{}', '{"a":1}', '{"a":1,"b":[2]}', None, '[1]']


def gen(seed: int):
    r = random.Random(seed)
    n = 40
    pid = lambda: r.choice(list(range(1, n + 1)) + [999])  # noqa: E731 (999 is not a player)
    times = [T0 + dt.timedelta(days=d, microseconds=r.randint(0, 10**6)) for d in range(0, 60, 3)]
    t = lambda: None if r.random() < 0.1 else r.choice(times)  # noqa: E731 (ties are common)
    money = lambda: None if r.random() < 0.1 else Decimal(r.randint(0, 99999)) / 100
    player = [(i, t(), t(), r.choice(["TW", "HK", None]), None, None, r.choice(["ads", "organic"]),
               r.choice([None, None, pid()]), r.choice([False, False, False, True, None]),
               r.choice([None, 1.5, 20.0]), r.choice([None, 3.0]),
               r.choice([None, [], [dt.date(2025, 1, 1), dt.date(2025, 1, 2)]])) for i in range(1, n + 1)]
    survey = [(k, pid(), t(), r.choice(RESPONSES)) for k in range(80)]
    rooms = [(pid(), r.choice([None, 1, 5, 30])) for _ in range(50)]
    room = [(r.choice([None, pid()]), r.choice(FURNITURE), r.choice(WARDROBE)) for _ in range(50)]
    sessions = []
    for k in range(90):
        a, b = pid(), pid()
        parts = r.choice(PARTICIPANTS).replace("{a}", str(a)).replace("{b}", str(b))
        winners = r.choice([None, [str(a)], [str(b)], [str(a), str(b)], []])
        sessions.append((k, r.choice([None, pid(), pid()]), r.choice(["a", "b", "c", None]), money(), money(),
                         parts, winners, t()))
    feed = [(pid(), t()) for _ in range(60)]
    arcade = [(pid(), t()) for _ in range(30)]
    tx = [(k, pid(), r.choice(["p1", "p2", None]), money(), r.choice(["completed", "completed", "refunded"]), t())
          for k in range(60)]
    prime = [(pid(), money(), r.choice(["INITIAL_PURCHASE", "RENEWAL", "CANCELLATION"]), t()) for _ in range(25)]
    return dict(player=player, survey_response=survey, player_room=rooms, room=room, game_session=sessions,
                pet_feeding=feed, arcade_score=arcade, pcoin_transaction=tx, prime_subscription_event=prime)


DDL = {
    "player": ("player_id BIGINT, created_at TIMESTAMP, last_seen TIMESTAMP, country_code VARCHAR, gender VARCHAR, "
               "language VARCHAR, acquisition_source VARCHAR, invited_by BIGINT, is_deleted BOOLEAN, pcoins DOUBLE, "
               "coins DOUBLE, login_dates DATE[]"),
    "survey_response": "survey_id BIGINT, player_id BIGINT, created_at TIMESTAMP, responses VARCHAR",
    "player_room": "player_id BIGINT, current_streak INTEGER",
    "room": "manager_id BIGINT, furniture_objects VARCHAR, wardrobe_items VARCHAR",
    "game_session": ("session_id BIGINT, host_player_id BIGINT, game_type VARCHAR, bet_amount DECIMAL(18,2), "
                     "total_pot DECIMAL(18,2), participants VARCHAR, winner_ids VARCHAR[], created_at TIMESTAMP"),
    "pet_feeding": "player_id BIGINT, created_at TIMESTAMP",
    "arcade_score": "player_id BIGINT, created_at TIMESTAMP",
    "pcoin_transaction": ("tx_id BIGINT, player_id BIGINT, product_id VARCHAR, price DECIMAL(18,2), status VARCHAR, "
                          "created_at TIMESTAMP"),
    "prime_subscription_event": "player_id BIGINT, price DECIMAL(18,2), event_type VARCHAR, created_at TIMESTAMP",
}


JS = "CASE WHEN json_valid({c}) THEN json_type({c}) END"
DAY = 86_400_000_000


def _micros(a, b):
    """Microseconds from a to b."""
    d = b - a
    return (d.days * 86400 + d.seconds) * 10**6 + d.microseconds


def _half_up(num, den, digits):
    """num / den rounded half away from zero."""
    scaled = Fraction(num, den) * 10**digits
    whole = int(abs(scaled) + Fraction(1, 2))
    return float(Fraction(whole if scaled >= 0 else -whole, 10**digits))


def _json(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def _text(v):
    """A JSON value as a database shows it as text; null and absent are None."""
    return v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"))


def _answers(data, pid):
    """The latest response (undated ones first, then newest, then highest id), or None."""
    own = [r for r in data["survey_response"] if r[1] == pid]
    if not own:
        return None
    best = max(own, key=lambda r: (r[2] is None, r[2] or T0, r[0]))
    doc = json.loads(best[3])
    get = lambda k: _text(doc.get(k))
    return {"age": get("ageRange") if get("ageRange") is not None else get("age"), "price_feeling": get("priceFeeling") or None,
            "would": get("wouldPayFor"), "pay_state": get("boughtPcoins") or get("paymentStatus") or None,
            "half_off": get("halfOffWouldTry") or None}


def store_by_hand(data):
    """The feature store, player by player, from the column contract."""
    rows = []
    for (pid, created, seen, country, gender, language, source, inviter, deleted, pcoins, coins, logins) in data["player"]:
        if deleted is not False:
            continue
        of = lambda name, i=0: [r for r in data[name] if r[i] == pid]
        a = _answers(data, pid)
        streaks = [r[1] for r in of("player_room") if r[1] is not None]
        furniture = [0 if r[1] is None else len(_json(r[1])) for r in of("room") if r[1] is None or isinstance(_json(r[1]), list)]
        wardrobe = [0 if r[2] is None else len(_json(r[2])) for r in of("room") if r[2] is None or isinstance(_json(r[2]), dict)]
        hosted = of("game_session", 1)
        games = Counter(r[2] for r in hosted if r[2] is not None)
        bought = [r for r in of("pcoin_transaction", 1) if r[4] == "completed"]
        renewed = [r for r in of("prime_subscription_event") if r[2] in ("INITIAL_PURCHASE", "RENEWAL")]
        money = lambda rows, i: sum((r[i] for r in rows if r[i] is not None), Decimal(0))
        first = min((r[5] for r in bought if r[5] is not None), default=None)
        lag = _half_up(_micros(created, first), DAY, 2) if first is not None and created is not None else None
        row = {
            "player_id": pid, "created_at": created, "last_seen": seen, "country_code": country, "gender": gender,
            "language": language, "acquisition_source": source, "was_invited": inviter is not None,
            "active_days": max(0.0, _micros(created, seen) / DAY) if created and seen else 0.0, "login_days": len(logins or []),
            "age_bucket": AGE_BUCKETS.get((a or {}).get("age") or "", "unknown"), "surveyed": a is not None,
            **{k: (a or {}).get(k) for k in ("price_feeling", "pay_state", "half_off")},
            "stated_intent": bool(a) and (a["price_feeling"] in PRICE_FEELING_INTENT or a["pay_state"] in PAY_STATE_INTENT
                                          or a["half_off"] in HALF_OFF_INTENT
                                          or (a["would"] is not None and a["would"] not in WOULD_PAY_FOR_NONE)),
            "max_streak": max(streaks, default=0), "n_rooms": len(of("player_room")), "furniture_cnt": sum(furniture),
            "wardrobe_cnt": sum(wardrobe), "n_games_hosted": len(hosted), "pcoins_wagered": money(hosted, 3),
            "fav_game": min(games, key=lambda g: (-games[g], g), default=None), "n_feedings": len(of("pet_feeding")),
            "n_arcade": len(of("arcade_score")), "n_invited": sum(r[7] == pid for r in data["player"]),
            "pcoins_balance": pcoins or 0, "coins_balance": coins or 0, "n_purchases": len(bought),
            "pcoin_usd": money(bought, 3), "prime_usd": money(renewed, 1), "lifetime_usd": money(bought, 3) + money(renewed, 1),
            "is_payer": bool(bought or renewed), "is_prime_real": bool(renewed), "first_buy_lag_days": lag}
        rows.append(tuple(row[c] for c in STORE_COLUMNS))
    return rows


ECON_SQL = f"""
WITH elems AS (
  SELECT s.bet_amount, s.total_pot, s.winner_ids, json_extract_string(e.elem, '$.playerId') AS pid
  FROM game_session s, unnest(json_extract(s.participants, '$[*]')) AS e(elem)
  WHERE {JS.format(c='s.participants')} = 'ARRAY')
SELECT CAST(pid AS BIGINT) AS player_id, count(*) AS games, CAST(sum(bet_amount) AS DECIMAL(38,2)) AS wagered,
  count(*) FILTER (WHERE list_contains(winner_ids, pid)) AS wins,
  CAST(COALESCE(sum(total_pot) FILTER (WHERE list_contains(winner_ids, pid)), 0) AS DECIMAL(38,2)) AS won
FROM elems WHERE pid IS NOT NULL GROUP BY 1
"""


def _norm(rows):
    out = []
    for r in rows:
        row = []
        for v in r:
            if isinstance(v, (Decimal, int)) and not isinstance(v, bool):
                v = float(v)
            row.append(v)
        out.append(tuple(row))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_store_and_economy_match_bruteforce(spark, roles, seed):
    from paylens.operators.economy import player_game_economy
    from paylens.operators.features import feature_store
    data = gen(seed)
    r = roles(**data)
    con = duckdb.connect()
    for name, ddl in DDL.items():
        con.execute(f"CREATE TABLE {name} ({ddl})")
        if data[name]:
            marks = ", ".join("?" * len(data[name][0]))
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", data[name])
    econ = player_game_economy(r.game_session)
    got_e = [tuple(x) for x in econ.select("player_id", "games", "wagered", "wins", "won").collect()]
    want_e = con.execute(ECON_SQL).fetchall()
    assert _norm(got_e) == _norm(want_e)
    store = feature_store(r, econ)
    got = [tuple(x) for x in store.select(*STORE_COLUMNS).collect()]
    want = store_by_hand(data)
    assert len(got) == len(want) and _norm(got) == _norm(want)


def test_gathered_sides_give_the_same_store(spark, roles):
    """The workspace's store joins the ten sides at once, with the rows of ten joins, also for null and repeated keys."""
    from paylens.operators.economy import player_game_economy
    from paylens.operators.features import ECONOMY_COLUMNS, feature_store
    data = gen(4)
    data["player"] = [*data["player"], *data["player"][:5], (None, *data["player"][0][1:])]
    r = roles(**data)
    one, ten = (feature_store(r, player_game_economy(r.game_session), gathered=g) for g in (True, False))
    rows = lambda s: _norm([tuple(x) for x in s.select(*STORE_COLUMNS, *ECONOMY_COLUMNS).collect()])
    assert rows(one) == rows(ten) and one.schema == ten.schema
    joins = lambda s: s._jdf.queryExecution().analyzed().toString().count("Join LeftOuter")
    assert (joins(one), joins(ten)) == (1, 10)


# Store-level analyses: Spark operator vs the driver oracle text replayed on the
# same (random) store.
def _store_ops():
    from paylens.operators import (behaviour, extensions, growth, headline, levers, model, payer_dna,
                                   propensity, social, why_pay)
    from paylens.operators.ranking import score_report
    T = ("acquisition_source",)

    def dec(s, c):
        return propensity.holdout_deciles(s, c)

    def hold(s):
        return s.filter(F.col("is_holdout")).select("player_id", "propensity",
                                                     F.col("is_payer").cast("int").alias("y"))
    from pyspark.sql import functions as F
    return {
        "headline": lambda s, c: headline.headline(s),
        "stated_vs_revealed": lambda s, c: headline.stated_vs_revealed(headline.headline(s)),
        "cosmetics_gap": lambda s, c: why_pay.cosmetics_gap(s),
        "payer_archetypes": lambda s, c: why_pay.payer_archetypes(s, c),
        "game_type_pay": lambda s, c: payer_dna.game_type_pay(s),
        "predictor_lift": lambda s, c: behaviour.predictor_lift(s, c),
        "score_deciles": lambda s, c: dec(s, c).select("player_id", "propensity", "decile"),
        "decile_payer_rate": lambda s, c: propensity.decile_payer_rate(dec(s, c)),
        "holdout_summary": lambda s, c: propensity.holdout_summary(dec(s, c), c),
        "target_pool": lambda s, c: growth.target_pool(s, c),
        "target_by_country": lambda s, c: growth.target_by_country(s, c),
        "conversion_moment": lambda s, c: growth.conversion_moment(s),
        "wagered_share_of_payers": lambda s, c: growth.wagered_share_of_payers(s),
        "purchase_freq": lambda s, c: growth.purchase_freq(s, c),
        "one_time_vs_repeat": lambda s, c: growth.one_time_vs_repeat(s, c),
        "whale_concentration": lambda s, c: growth.whale_concentration(s),
        "prime_cross_sell": lambda s, c: growth.prime_cross_sell(s),
        "one_time_share": lambda s, c: growth.one_time_share(s),
        "social_rates": lambda s, c: social.social_rates(s),
        "retention_x_pay": lambda s, c: social.retention_x_pay(s, c),
        "geo": lambda s, c: social.geo(s, c),
        "lever_inputs": lambda s, c: levers.lever_inputs(s, c),
        "levers": lambda s, c: levers.levers(levers.lever_inputs(s, c), c),
        "score_auc": lambda s, c: score_report(hold(s), "propensity", "y", "player_id", c.n_tiles)
        .select("auc", "positives", "negatives"),
        "feature_matrix": lambda s, c: model.feature_matrix(s, c),
        "class_balance": lambda s, c: model.class_balance(model.feature_matrix(s, c), c).select("player_id", "y"),
        "cohort_conversion_7d": lambda s, c: extensions.cohort_conversion_7d(s),
        "headline_by_tenant": lambda s, c: headline.headline(s, by=T),
        "archetypes_by_tenant": lambda s, c: why_pay.payer_archetypes(s, c, by=T),
        "retention_by_tenant": lambda s, c: social.retention_x_pay(s, c, by=T),
        "levers_by_tenant": lambda s, c: levers.levers(levers.lever_inputs(s, c, by=T), c, by=T),
        "lift_by_tenant": lambda s, c: behaviour.predictor_lift(s, c, by=T),
        "deciles_by_tenant": lambda s, c: propensity.holdout_deciles(s, c, by=T).select(*T, "player_id", "propensity", "decile"),
        "whales_by_tenant": lambda s, c: growth.whale_concentration(s, by=T),
        "target_countries_by_tenant": lambda s, c: growth.target_by_country(s, c, by=T),
    }


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("profile, payers", [("reference", "some"), ("fixture", "some"), ("reference", "none")])
def test_store_analyses_match_oracle_on_random_store(spark, roles, seed, profile, payers):
    import os
    import tempfile

    from paylens.config import FIXTURE_PROFILE, REFERENCE_PROFILE
    from paylens.operators.features import feature_store
    from paylens.operators.propensity import with_propensity
    from paylens.plans.oracle import oracle_sql
    from tests.oracle_compare import rows_of
    cfg = REFERENCE_PROFILE if profile == "reference" else FIXTURE_PROFILE
    data = gen(seed)
    if payers == "none":
        data["pcoin_transaction"] = data["prime_subscription_event"] = []
    store = with_propensity(feature_store(roles(**data)), cfg)
    path = os.path.join(tempfile.mkdtemp(prefix="paylens-rstore-"), "store")
    store.write.parquet(path)
    store = spark.read.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW rstore AS SELECT * FROM read_parquet('{path}/*.parquet')")
    sql = oracle_sql(cfg, store_table="rstore")
    for name, op in _store_ops().items():
        df = op(store, cfg)
        a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(sql[name])
        b, bc = rows_of([d[0] for d in cur.description], cur.fetchall())
        assert ac == bc, name
        assert sorted(a, key=repr) == sorted(b, key=repr), name
    if payers == "none":
        assert [r.payers for r in _store_ops()["whale_concentration"](store, cfg).collect()] == [0]
