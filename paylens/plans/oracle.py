"""DuckDB oracle text for every registered query (driver correctness gate).

Each text restates the query over the pre-registered driver views. Rounded
figures use exact integer arithmetic on both sides (see functions/exact.py).
"""

from __future__ import annotations

from fractions import Fraction

from paylens.config import FIXTURE_PROFILE, Config
from paylens.operators.features import STORE_COLUMNS
from paylens.operators.levers import lever_texts
from paylens.plans import sqltext as S
from paylens.plans.oracle_store import BINDINGS, STORE, with_ctes


def _scored(cfg: Config) -> str:
    terms = [f"LEAST(CAST({t.feature} AS DOUBLE) / CAST({t.cap!r} AS DOUBLE), CAST(1 AS DOUBLE))"
             f" * CAST({t.weight!r} AS DOUBLE)" for t in cfg.score_terms]
    score = " + ".join(terms) + (f" + CASE WHEN stated_intent THEN CAST({cfg.intent_weight!r} AS DOUBLE)"
                                 f" ELSE CAST(0 AS DOUBLE) END")
    hold = (f"(CAST(('0x' || substr(md5(CAST(player_id AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" % {cfg.holdout_buckets} = 0)")
    return f"""
scored AS (SELECT *, {score} AS propensity, {hold} AS is_holdout FROM player_features)"""


def _econ() -> str:
    return """
econ_rows AS (
  SELECT p1 AS pid, winner_id, bet_amount, total_pot FROM game_session
  UNION ALL SELECT p2 AS pid, winner_id, bet_amount, total_pot FROM game_session
),
pgs AS (
  SELECT pid AS player_id, count(*) AS games, CAST(sum(bet_amount) AS DECIMAL(38,2)) AS wagered,
         count(*) FILTER (WHERE pid = winner_id) AS wins,
         CAST(COALESCE(sum(total_pot) FILTER (WHERE pid = winner_id), 0) AS DECIMAL(38,2)) AS won
  FROM econ_rows WHERE pid IS NOT NULL GROUP BY pid
)"""


def _deciles(cfg: Config) -> str:
    return f"""
holdout AS (
  SELECT player_id, propensity, is_payer,
         CAST(ntile({cfg.n_tiles}) OVER (ORDER BY propensity, player_id) AS INTEGER) AS decile
  FROM scored WHERE is_holdout
)"""


def oracle_sql(cfg: Config = FIXTURE_PROFILE, store_table: str | None = None) -> dict[str, str]:
    """``store_table``: read the scored store from that table instead of
    deriving it from the driver tables (only store-level texts are then
    meaningful; used to replay the analyses on hand-built stores)."""
    base = ((BINDINGS, STORE, _scored(cfg)) if store_table is None
            else (f"\nscored AS (SELECT * FROM {store_table})",))
    W = lambda sel, *more: with_ctes(*base, *more, select=sel)
    out: dict[str, str] = {}

    # --- F
    out["player_base"] = W("SELECT * FROM profile")
    out["latest_survey"] = W("SELECT * FROM sv")
    out["room_streak"] = W("SELECT player_id, max_streak, n_rooms FROM tally WHERE n_rooms > 0")
    out["owned_items"] = W("SELECT player_id, furniture_cnt, wardrobe_cnt FROM tally WHERE n_managed > 0")
    out["wager_profile"] = W("SELECT player_id, n_games_hosted, pcoins_wagered, fav_game FROM tally LEFT JOIN modal USING (player_id) "
                              "WHERE n_games_hosted > 0")
    out["feed_count"] = W("SELECT player_id, n_feedings FROM tally WHERE n_feedings > 0")
    out["arcade_count"] = W("SELECT player_id, n_arcade FROM tally WHERE n_arcade > 0")
    out["invite_count"] = W("SELECT player_id, n_invited FROM tally WHERE n_invited > 0")
    out["purchases"] = W("SELECT player_id, n_purchases, pcoin_total, first_buy FROM tally WHERE n_purchases > 0")
    out["prime_revenue"] = W("SELECT player_id, prime_total FROM tally WHERE n_renewals > 0")
    out["survey_intent"] = W("SELECT player_id, age_bucket, surveyed, price_feeling, pay_state, half_off, "
                             "stated_intent FROM player_features")
    out["revealed_outcome"] = W("SELECT player_id, n_purchases, pcoin_usd, prime_usd, lifetime_usd, is_payer, "
                                "is_prime_real, first_buy_lag_days FROM player_features")
    out["feature_store"] = W(f"SELECT {', '.join(STORE_COLUMNS)} FROM player_features")

    # --- H, W
    head = f"""SELECT count(*) AS players, {S.count_if('is_payer')} AS payers,
  {S.pct(S.count_if('is_payer'), 'count(*)')} AS payer_pct,
  {S.money_sum('lifetime_usd')} AS total_usd,
  {S.avg_exact('lifetime_usd', 'is_payer', 2, money=True)} AS arppu_usd,
  {S.count_if('surveyed')} AS surveyed,
  {S.rate_pct('is_payer', 'stated_intent')} AS stated_yes_payer_pct,
  {S.rate_pct('is_payer', 'surveyed AND NOT stated_intent')} AS stated_no_payer_pct
FROM scored"""
    out["headline"] = W(head)
    out["stated_vs_revealed"] = W(
        "SELECT stated_yes_payer_pct, stated_no_payer_pct, "
        + S.rr("CAST(round(COALESCE(stated_yes_payer_pct, 0) * 100) AS BIGINT)",
               "CAST(round(COALESCE(stated_no_payer_pct, 0) * 100) AS BIGINT)", 1)
        + f" AS yes_no_ratio FROM ({head})")
    out["product_mix"] = W("""SELECT product_id, count(*) AS tx, count(DISTINCT player_id) AS ppl,
  CAST(sum(price) AS DECIMAL(38,2)) AS usd FROM pcoin_transaction WHERE status = 'completed' GROUP BY product_id""")
    wag = """SELECT game_type, count(*) AS sessions, count(DISTINCT host_player_id) AS hosts,
  CAST(sum(bet_amount) AS DECIMAL(38,2)) AS pcoins_wagered FROM game_session GROUP BY game_type"""
    out["wagering_by_game"] = W(wag)
    owns = "(furniture_cnt > 0 OR wardrobe_cnt > 0)"
    cos_sel = f"""SELECT {S.count_if(owns)} AS players_with_furniture_or_wardrobe,
  count(*) AS total_players, {S.pct(S.count_if(owns), 'count(*)', 1)} AS pct FROM scored"""
    out["cosmetics_gap"] = W(cos_sel)
    arche = (f"CASE WHEN is_prime_real THEN 'prime' WHEN lifetime_usd >= {cfg.whale_usd!r} THEN '{cfg.whale_label}' "
             f"WHEN n_purchases >= {cfg.repeat_min} THEN 'repeat' ELSE 'one_time' END")
    out["payer_archetypes"] = W(f"""SELECT archetype, count(*) AS players, {S.money_sum('lifetime_usd')} AS usd,
  {S.avg_exact('pcoins_wagered', None, 0, money=True)} AS avg_wagered,
  {S.avg_exact('max_streak', None, 1)} AS avg_streak
FROM (SELECT *, {arche} AS archetype FROM scored WHERE is_payer) GROUP BY archetype""")

    # --- D
    E = lambda sel: with_ctes(*base, _econ(), select=sel)
    out["player_game_economy"] = E("SELECT * FROM pgs")
    net = "(won - wagered)"
    loss_sel = f"""SELECT ord, {S.band_label('ord', cfg.net_band)} AS bucket, count(*) AS players,
  {S.rate_pct('f.is_payer')} AS payer_pct
FROM (SELECT player_id, {S.band_ord(net, cfg.net_band)} AS ord FROM pgs) z
JOIN scored f USING (player_id) GROUP BY ord"""
    out["loss_chasing"] = E(loss_sel)
    out["bet_size_lift"] = E(f"""SELECT ord, {S.band_label('ord', cfg.stake_band)} AS bucket, count(*) AS players,
  {S.rate_pct('f.is_payer')} AS payer_pct
FROM (SELECT player_id, {S.band_ord_ratio('wagered', 'games', cfg.stake_band)} AS ord FROM pgs WHERE games > 0) z
JOIN scored f USING (player_id) GROUP BY ord""")
    out["game_type_pay"] = W(f"""SELECT fav_game, count(*) AS players, {S.rate_pct('is_payer')} AS payer_pct
FROM scored WHERE fav_game IS NOT NULL GROUP BY fav_game""")
    win = S.rrs("g.wins * 100", "g.games", 6)
    out["payer_psychology"] = E(f"""SELECT grp, count(*) AS players,
  {S.avg_exact('g.games', None, 0)} AS avg_games,
  {S.rr_wide(f"sum({win})", f"count({win}) * 1000000", 1)} AS win_rate,
  {S.avg_exact('g.wagered', None, 0, money=True)} AS avg_wagered,
  {S.avg_exact('(g.won - g.wagered)', None, 0, money=True)} AS avg_net_pcoins
FROM (SELECT player_id, CASE WHEN lifetime_usd >= {cfg.whale_usd!r} THEN '{cfg.whale_label}'
             ELSE 'regular_payer' END AS grp
      FROM scored WHERE is_payer AND lifetime_usd > 0) f
JOIN pgs g USING (player_id) GROUP BY grp""")
    out["why_never_bought"] = W("""SELECT s.never_bought_reason AS reason, count(*) AS n
FROM survey_response s JOIN scored f ON f.player_id = s.player_id AND NOT f.is_payer
WHERE s.never_bought_reason IS NOT NULL AND s.never_bought_reason <> '' GROUP BY s.never_bought_reason""")

    # --- B
    aggs, rows = [], []
    for i, sig in enumerate(cfg.lifts):
        for side, cond in (("h", sig.high), ("l", sig.low)):
            aggs.append(f"sum(CAST(is_payer AS INTEGER)) FILTER (WHERE {cond}) AS {side}n{i}")
            aggs.append(f"count(CAST(is_payer AS INTEGER)) FILTER (WHERE {cond}) AS {side}d{i}")
        hi, lo = S.rrs(f"hn{i} * 100", f"hd{i}", 2), S.rrs(f"ln{i} * 100", f"ld{i}", 2)
        rows.append(f"SELECT '{sig.name}' AS feature, CAST({hi} AS DOUBLE) / CAST(100 AS DOUBLE) AS high_pct, "
                    f"CAST({lo} AS DOUBLE) / CAST(100 AS DOUBLE) AS low_pct, {S.rr_wide(hi, lo, 1)} AS lift FROM a")
    lift_a = f"\na AS (SELECT {', '.join(aggs)} FROM scored)"
    lift_sel = "\nUNION ALL ".join(rows)
    out["predictor_lift"] = with_ctes(*base, lift_a, select=lift_sel)

    # --- P
    out["propensity_score"] = W("SELECT player_id, propensity FROM scored")
    out["holdout_split"] = W("SELECT player_id, is_holdout FROM scored")
    D = lambda sel: with_ctes(*base, _deciles(cfg), select=sel)
    out["score_deciles"] = D("SELECT player_id, propensity, decile FROM holdout")
    dec_sel = f"SELECT decile, count(*) AS players, {S.rate_pct('is_payer')} AS payer_pct FROM holdout GROUP BY decile"
    out["decile_payer_rate"] = D(dec_sel)
    top = f"decile = {cfg.n_tiles}"
    tp, tn = S.count_if(f"{top} AND is_payer"), S.count_if(top)
    out["holdout_summary"] = D(hold_sel := f"""SELECT count(*) AS holdout_size,
  {S.pct(S.count_if('is_payer'), 'count(*)')} AS holdout_base_payer_pct,
  {S.pct(tp, tn)} AS top_decile_payer_pct,
  {S.rr_wide(f'({tp}) * count(*)', f"({tn}) * ({S.count_if('is_payer')})", 1)} AS top_decile_lift
FROM holdout""")

    # --- C
    tgt = f"(NOT is_payer AND propensity >= CAST({cfg.target_score!r} AS DOUBLE))"
    out["target_pool"] = W(pool_sel := f"""SELECT {S.count_if(tgt)} AS high_propensity_nonpayers,
  {S.count_if('NOT is_payer')} AS total_nonpayers,
  {S.avg_exact('pcoins_wagered', tgt, 0, money=True)} AS avg_wagered,
  {S.avg_exact('max_streak', tgt, 1)} AS avg_streak FROM scored""")
    out["target_by_country"] = W(f"""SELECT country_code, count(*) AS targets FROM scored
WHERE {tgt} AND country_code IS NOT NULL GROUP BY country_code
ORDER BY targets DESC, country_code LIMIT {cfg.top_countries_target}""")
    buyers = "SELECT * FROM scored WHERE is_payer AND first_buy_lag_days IS NOT NULL"
    out["conversion_moment"] = W(cm_sel := S.percentile_select(
        buyers, "CAST(round(first_buy_lag_days * 100) AS BIGINT)", "player_id", [(1, 2)], 100, 1,
        extra=(f"{S.pct(S.count_if('first_buy_lag_days < 1'), 'count(*)', 1)} AS same_day_pct",
               f"{S.pct(S.count_if('first_buy_lag_days < 7'), 'count(*)', 1)} AS within_7d_pct"),
        names=("median_lag_days",)))
    out["wagered_share_of_payers"] = W(wsh_sel := f"""SELECT {S.pct(S.count_if('pcoins_wagered > 0'), 'count(*)', 1)}
  AS wagered_before_paying_pct FROM scored WHERE is_payer""")

    # --- E
    fb = cfg.freq_band
    out["purchase_freq"] = W(pf_sel := f"""SELECT {S.band_label('b', fb)} AS bucket, ord, payers, usd FROM (
  SELECT {S.band_ord('n_purchases', fb)} AS b, min(n_purchases) AS ord, count(*) AS payers,
         {S.money_sum('pcoin_usd')} AS usd
  FROM scored WHERE n_purchases >= 1 GROUP BY b)""")
    out["one_time_vs_repeat"] = W(f"""SELECT CASE WHEN n_purchases >= {cfg.repeat_min} THEN 'repeat' ELSE 'one_time' END AS grp,
  count(*) AS players, {S.avg_exact('pcoins_wagered', None, 0, money=True)} AS avg_wagered,
  {S.avg_exact('max_streak', None, 1)} AS avg_streak, {S.avg_days('active_days', 1)} AS avg_active_days
FROM scored WHERE n_purchases >= 1 GROUP BY grp""")
    whale = S.percentile_select("SELECT * FROM scored WHERE is_payer", "CAST(lifetime_usd * 100 AS BIGINT)",
                                "player_id", [(1, 2), (9, 10), (99, 100)], 100, 2,
                                extra=("max(lifetime_usd) AS max_usd",))
    out["whale_concentration"] = W(f"SELECT n AS payers, p0 AS median_usd, p1 AS p90_usd, p2 AS p99_usd, max_usd "
                                   f"FROM ({whale})")
    cand = "(n_purchases >= 1 AND NOT is_prime_real)"
    out["prime_cross_sell"] = W(pcs_sel := f"""SELECT {S.count_if(cand)} AS pcoin_buyers_not_prime,
  {S.money_sum('lifetime_usd', cand)} AS their_lifetime_usd FROM scored""")
    one, pay = S.count_if("n_purchases = 1"), S.count_if("is_payer")
    out["one_time_share"] = W(f"""SELECT {one} AS one_time_buyers, {pay} AS payers,
  CASE WHEN {pay} > 0 THEN CAST(({one} * 100) // {pay} AS BIGINT) END AS one_time_pct FROM scored""")

    # --- G
    out["social_rates"] = W(f"""SELECT {S.rate_pct('is_payer', 'was_invited')} AS invited_in_payer_pct,
  {S.rate_pct('is_payer', 'NOT was_invited')} AS organic_payer_pct,
  {S.rate_pct('is_payer', 'n_invited > 0')} AS inviter_payer_pct,
  {S.rate_pct('is_payer', 'n_invited = 0')} AS noninviter_payer_pct FROM scored""")
    ab = cfg.active_band
    ret_sel = f"""SELECT {S.band_label('b', ab)} AS bucket, ord, players, payer_pct FROM (
  SELECT {S.band_ord('active_days', ab)} AS b, min(active_days) AS ord, count(*) AS players,
         {S.rate_pct('is_payer')} AS payer_pct FROM scored GROUP BY b)"""
    out["retention_x_pay"] = W(ret_sel)
    out["geo"] = W(f"""SELECT country_code, count(*) AS players, {S.rate_pct('is_payer')} AS payer_pct,
  CAST(round({S.money_sum('lifetime_usd')}, 0) AS DECIMAL(38,0)) AS usd
FROM scored WHERE country_code IS NOT NULL GROUP BY country_code
ORDER BY players DESC, country_code LIMIT {cfg.top_countries_geo}""")

    # --- L
    c = "CAST(lifetime_usd * 100 AS BIGINT)"
    rep = f"n_purchases >= {cfg.repeat_min}"
    inputs = f"""SELECT {S.count_if(tgt)} AS hp_nonpayers, {S.count_if('n_purchases = 1')} AS one_timers,
  {S.count_if(cand)} AS prime_candidates,
  {S.count_if('is_payer')} AS payers, CAST(sum({c}) FILTER (WHERE is_payer) AS BIGINT) AS payer_cents,
  {S.count_if(rep)} AS repeaters, CAST(sum({c}) FILTER (WHERE {rep}) AS BIGINT) AS repeat_cents,
  {S.count_if('n_purchases = 1')} AS onetimers_n,
  CAST(sum({c}) FILTER (WHERE n_purchases = 1) AS BIGINT) AS onetime_cents
FROM scored"""
    out["lever_inputs"] = W(inputs)
    conv, rp = Fraction(str(cfg.convert_rate)), Fraction(str(cfg.repeat_rate))
    prime = Fraction(str(cfg.prime_rate)) * Fraction(str(cfg.prime_price))
    H = lambda x: f"CAST({x} AS HUGEINT)"
    both = "(repeaters > 0 AND onetimers_n > 0)"
    diff = f"({H('repeat_cents')} * onetimers_n - {H('onetime_cents')} * repeaters)"
    sized = [
        ("hp_nonpayers", S.rr_wide(f"{H('hp_nonpayers')} * {conv.numerator} * payer_cents",
                                   f"{H('payers')} * {conv.denominator * 100}", 0)),
        ("one_timers", S.rr_wide(f"CASE WHEN {both} THEN {H('one_timers')} * {rp.numerator} * GREATEST({diff}, 0) ELSE 0 END",
                                 f"CASE WHEN {both} THEN {H('repeaters')} * onetimers_n * {rp.denominator * 100} ELSE 1 END", 0)),
        ("prime_candidates", S.rr_wide(f"{H('prime_candidates')} * {prime.numerator}", str(prime.denominator), 0)),
    ]
    sel = "\nUNION ALL ".join(
        f"SELECT '{name}' AS lever, {pool} AS pool, '{assumption}' AS assumption, {est} AS est_upside_usd FROM li"
        for (name, assumption), (pool, est) in zip(lever_texts(cfg), sized))
    lever_cte = f"\nli AS ({inputs}),\nlv AS ({sel})"
    out["levers"] = with_ctes(*base, lever_cte, select="SELECT * FROM lv")
    out["lever_pct_of_max"] = with_ctes(*base, lever_cte, select=(
        "SELECT *, CAST(100 AS DOUBLE) * CAST(est_upside_usd AS DOUBLE) / "
        "(SELECT max(CAST(est_upside_usd AS DOUBLE)) FROM lv) AS pct_of_max FROM lv"))
    out["wagering_pct_of_max"] = with_ctes(*base, f"\nwg AS ({wag})", select=(
        "SELECT *, CAST(100 AS DOUBLE) * CAST(pcoins_wagered AS DOUBLE) / "
        "(SELECT max(CAST(pcoins_wagered AS DOUBLE)) FROM wg) AS pct_of_max FROM wg"))
    facts = f"""
hd AS ({head}),
lift AS ({lift_sel}),
hs AS ({hold_sel}),
tp AS ({pool_sel}),
cm AS ({cm_sel}),
wsh AS ({wsh_sel}),
cg AS ({cos_sel}),
pf AS ({pf_sel}),
pcs AS ({pcs_sel}),
top AS (SELECT * FROM lv ORDER BY est_upside_usd DESC, lever LIMIT 1)"""
    out["brief_facts"] = with_ctes(*base, _deciles(cfg), lever_cte, lift_a, facts, select="""SELECT
  (SELECT lever FROM top) AS top_lever, (SELECT est_upside_usd FROM top) AS top_usd,
  (SELECT pool FROM top) AS top_pool,
  (SELECT wagered_before_paying_pct FROM wsh) AS wagered_before_pct,
  (SELECT same_day_pct FROM cm) AS same_day_pct, (SELECT pct FROM cg) AS cosmetics_pct,
  (SELECT max(lift) FROM lift WHERE starts_with(feature, 'wagered')) AS wager_lift,
  (SELECT max(lift) FROM lift WHERE starts_with(feature, 'stated intent')) AS intent_lift,
  (SELECT top_decile_payer_pct FROM hs) AS top_decile_pct,
  (SELECT holdout_base_payer_pct FROM hs) AS base_decile_pct,
  (SELECT top_decile_lift FROM hs) AS decile_lift,
  payers, players, payer_pct, total_usd, arppu_usd AS arppu,
  (SELECT high_propensity_nonpayers FROM tp) AS hp_nonpayers,
  (SELECT max(payers) FROM pf WHERE ord = 1) AS one_timers,
  (SELECT pcoin_buyers_not_prime FROM pcs) AS prime_pool
FROM hd""")

    # --- X4: tenant-grouped variants
    tn = "acquisition_source"
    out["archetypes_by_tenant"] = W(f"""SELECT {tn}, archetype, count(*) AS players, {S.money_sum('lifetime_usd')} AS usd,
  {S.avg_exact('pcoins_wagered', None, 0, money=True)} AS avg_wagered,
  {S.avg_exact('max_streak', None, 1)} AS avg_streak
FROM (SELECT *, {arche} AS archetype FROM scored WHERE is_payer) GROUP BY {tn}, archetype""")
    out["retention_by_tenant"] = W(f"""SELECT {tn}, {S.band_label('b', ab)} AS bucket, ord, players, payer_pct FROM (
  SELECT {tn}, {S.band_ord('active_days', ab)} AS b, min(active_days) AS ord, count(*) AS players,
         {S.rate_pct('is_payer')} AS payer_pct FROM scored GROUP BY {tn}, b)""")
    inputs_t = inputs.replace("SELECT ", f"SELECT {tn}, ", 1) + f" GROUP BY {tn}"
    sel_t = "\nUNION ALL ".join(
        f"SELECT {tn}, '{name}' AS lever, {pool} AS pool, '{assumption}' AS assumption, {est} AS est_upside_usd FROM li"
        for (name, assumption), (pool, est) in zip(lever_texts(cfg), sized))
    out["levers_by_tenant"] = with_ctes(*base, f"\nli AS ({inputs_t}),\nlv AS ({sel_t})", select="SELECT * FROM lv")
    rows_t = [r.replace("SELECT ", f"SELECT {tn}, ", 1) for r in rows]
    out["lift_by_tenant"] = with_ctes(*base, f"\na AS (SELECT {tn}, {', '.join(aggs)} FROM scored GROUP BY {tn})",
                                      select="\nUNION ALL ".join(rows_t))

    def of_max(ctes, sel, col):
        return with_ctes(*ctes, f"\nsec AS ({sel})", select=(
            f"SELECT *, CAST(100 AS DOUBLE) * CAST({col} AS DOUBLE) / "
            f"(SELECT max(CAST({col} AS DOUBLE)) FROM sec) AS pct_of_max FROM sec"))
    out["decile_pct_of_max"] = of_max((*base, _deciles(cfg)), dec_sel, "payer_pct")
    out["loss_pct_of_max"] = of_max((*base, _econ()), loss_sel, "payer_pct")
    out["retention_pct_of_max"] = of_max(base, ret_sel, "payer_pct")

    # --- M
    hold = "SELECT player_id, propensity AS s, CAST(is_payer AS INTEGER) AS y FROM scored WHERE is_holdout"
    out["score_auc"] = W(f"""SELECT {S.rr_wide('sum(pos * (2 * (COALESCE(below, 0) + 1) + n - 1)) - sum(pos) * (sum(pos) + 1)',
                                   '2 * sum(pos) * (sum(n) - sum(pos))', 3)} AS auc,
  CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(n) - sum(pos) AS BIGINT) AS negatives
FROM (SELECT s, n, pos, sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
      FROM (SELECT s, count(*) AS n, sum(y) AS pos FROM ({hold}) GROUP BY s))""")
    top_sel = f"""SELECT count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
    count(*) FILTER (WHERE rn <= tot // {cfg.n_tiles}) AS top_n,
    CAST(sum(y) FILTER (WHERE rn <= tot // {cfg.n_tiles}) AS BIGINT) AS top_positives
  FROM (SELECT *, row_number() OVER (ORDER BY s DESC, player_id) AS rn, count(*) OVER () AS tot FROM ({hold}))"""
    out["score_top_decile"] = W(f"""SELECT n, positives, top_n, top_positives,
  {S.pct('positives', 'n')} AS base_rate_pct, {S.pct('top_positives', 'top_n')} AS top_rate_pct,
  {S.rr_wide('top_positives * n', 'top_n * positives', 1)} AS top_lift FROM ({top_sel})""")
    feats = []
    for f in cfg.model_features:
        if f in ("stated_intent", "was_invited", "surveyed"):
            feats.append(f"CAST(CAST({f} AS INTEGER) AS DOUBLE) AS {f}")
        else:
            feats.append(f"CAST({f} AS DOUBLE) AS {f}")
    matrix = (f"SELECT player_id, CAST(is_holdout AS INTEGER) AS is_test, CAST(is_payer AS INTEGER) AS y, "
              f"{', '.join(feats)} FROM scored")
    out["feature_matrix"] = W(matrix)
    mom = "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, {i} AS pos, round(avg({f}), 6) AS mean, "
        f"round(CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE CAST(1 AS DOUBLE) END, 6) AS sd "
        f"FROM m WHERE is_test = 0" for i, f in enumerate(cfg.model_features))
    out["feature_moments"] = with_ctes(*base, f"\nm AS ({matrix})", select=mom)
    out["class_balance"] = with_ctes(*base, f"\nm AS ({matrix})", f"""
cb AS (SELECT count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM m WHERE is_test = 0),
kk AS (SELECT CASE WHEN p > 0 THEN GREATEST(1, n // ({cfg.neg_per_pos} * p)) ELSE 1 END AS k FROM cb),
negs AS (SELECT player_id, row_number() OVER (
           ORDER BY CAST(('0x' || substr(md5(CAST(player_id AS VARCHAR)), 1, 8)) AS BIGINT), player_id) AS rn
         FROM m WHERE is_test = 0 AND y = 0)""", select="""SELECT player_id, y FROM m WHERE is_test = 0 AND y = 1
UNION ALL SELECT player_id, 0 AS y FROM negs, kk WHERE (rn - 1) % k = 0""")
    # --- V
    cd = lambda c: f"CAST(CAST(round({c} * 100) AS BIGINT) AS HUGEINT)"
    micro = f"{cd('l_extendedprice')} * (100 - {cd('l_discount')}) * (100 + {cd('l_tax')})"
    rc_cents = S.rrs(f"sum({micro})", "10000", 0)
    rc = f"CAST(CAST({rc_cents} AS DECIMAL(35,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2))"
    active = ("(SELECT count(DISTINCT user_id) FROM events "
              "WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 28 DAY)")
    out["revenue_reconciliation"] = with_ctes(*base, f"""
rcs AS (SELECT {rc} AS rc FROM lineitem),
dbs AS (SELECT CAST(sum(lifetime_usd) AS DECIMAL(38,2)) AS db FROM scored),
rec AS (SELECT rc, db, CAST(db - rc AS DECIMAL(38,2)) AS diff FROM rcs, dbs)""", select=f"""SELECT rc AS rc_total_revenue_usd,
  db AS db_total_revenue_usd, {active} AS rc_active_users_28d, diff AS diff_usd,
  {S.rr_wide('CAST(diff * 100 AS HUGEINT) * 100', 'CAST(rc * 100 AS HUGEINT)', 2)} AS diff_pct,
  abs({S.rr_wide('CAST(diff * 100 AS HUGEINT) * 100', 'CAST(rc * 100 AS HUGEINT)', 2)}) <= 5.0 AS within_tolerance,
  CASE WHEN within_tolerance THEN 'database revenue agrees with the second source within 5.0 %'
       WHEN NOT within_tolerance THEN 'database revenue differs from the second source by more than 5.0 %'
       ELSE 'one of the totals is missing' END AS note
FROM rec""")
    from paylens.operators.quality import PII_PATTERNS
    from paylens.plans.registry import PII_SOURCES
    pii = []
    for t, cols in PII_SOURCES:
        for c in cols:
            for kind, rx in PII_PATTERNS:
                pii.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{kind}' AS kind, "
                           f"count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) AS violations FROM {t}")
    out["pii_scan"] = "\nUNION ALL ".join(pii)

    # --- X
    out["wagered_before_first_buy"] = f"""WITH
fb AS (SELECT user_id AS player_id, min(ts) AS first_buy FROM events
       WHERE event_type = 'purchase' AND value >= 150 GROUP BY user_id),
fw AS (SELECT user_id AS player_id, min(ts) AS first_wager FROM events
       WHERE event_type <> 'purchase' AND user_id IS NOT NULL GROUP BY user_id)
SELECT count(*) AS payers, {S.count_if('fw.first_wager < fb.first_buy')} AS wagered_before,
  {S.pct(S.count_if('fw.first_wager < fb.first_buy'), 'count(*)', 1)} AS wagered_before_pct
FROM fb LEFT JOIN fw USING (player_id)"""
    out["guarded_target_pool"] = E(f"""SELECT {S.count_if(tgt)} AS targets,
  {S.count_if(f"{tgt} AND age_bucket = 'under_18'")} AS minors_excluded,
  {S.count_if(f"{tgt} AND age_bucket <> 'under_18'")} AS guarded_targets,
  {S.count_if(f"{tgt} AND age_bucket <> 'under_18' AND (won - wagered) < {cfg.loss_flag_net!r}")} AS heavy_loss_flagged
FROM scored LEFT JOIN pgs USING (player_id)""")
    out["headline_by_tenant"] = W(head.replace("FROM scored", "FROM scored GROUP BY acquisition_source")
                                  .replace("SELECT count(*) AS players", "SELECT acquisition_source, count(*) AS players"))
    conv = S.count_if("first_buy_lag_days < 7")
    out["cohort_conversion_7d"] = W(f"""SELECT CAST(date_trunc('month', created_at) AS DATE) AS period_start,
  GROUPING(CAST(date_trunc('month', created_at) AS DATE)) = 1 AS is_total,
  count(*) AS new_customers, {conv} AS conversions_7d, {S.pct(conv, 'count(*)')} AS rate_pct
FROM scored GROUP BY ROLLUP (CAST(date_trunc('month', created_at) AS DATE))""")
    out["monthly_purchases"] = W("""SELECT CAST(date_trunc('month', created_at) AS DATE) AS period_start,
  count(*) AS purchases, CAST(sum(price) AS DECIMAL(38,2)) AS usd
FROM pcoin_transaction WHERE status = 'completed' GROUP BY period_start""")
    win_start = "((SELECT max(created_at) FROM pcoin_transaction) - INTERVAL 28 DAY)"
    recent = (f"(SELECT COALESCE(sum(CAST(price * 100 AS BIGINT)), 0) FROM pcoin_transaction "
              f"WHERE status = 'completed' AND created_at > {win_start})")
    out["arpu"] = W(f"""SELECT players, total_usd, arpu_lifetime_usd, active_users_28d,
  CAST(CAST({recent} AS DECIMAL(35,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2)) AS revenue_28d_usd,
  {S.rr_wide(recent, 'active_users_28d * 100', 3)} AS arpu_28d_usd
FROM (SELECT count(*) AS players, {S.money_sum('lifetime_usd')} AS total_usd,
  {S.rr_wide('sum(CAST(lifetime_usd * 100 AS BIGINT))', 'count(*) * 100', 3)} AS arpu_lifetime_usd,
  {S.count_if(f'last_seen > {win_start}')} AS active_users_28d FROM scored)""")
    out.update(_grouped(cfg, W, base, tgt, loss_sel=loss_sel))
    out.update(_model(cfg, W, base, matrix))
    out.update(_fitted(cfg, base, matrix))
    out.update(_streams())
    out.update(_sketches(W))
    out["revenue_document"] = f"SELECT {rc} AS revenue_usd, {active} AS active_users_28d FROM lineitem"
    out["store_view_sql"] = with_ctes(*base, _econ(), select="""SELECT country_code, count(*) AS players,
  count(*) FILTER (WHERE is_payer) AS payers, CAST(sum(games) AS BIGINT) AS games, CAST(sum(lifetime_usd) AS DECIMAL(38,2)) AS usd
FROM scored LEFT JOIN pgs USING (player_id) GROUP BY country_code""")
    for file, rows in (("feature_matrix_csv", "feature_matrix"), ("insights_file", "headline"), ("model_report_file", "model_coefficients")):
        out[file] = out[rows]  # what is written reads back as it was
    out["incremental_player_activity"] = """SELECT user_id, count(*) AS events,
  count(*) FILTER (WHERE event_type = 'purchase' AND value >= 150) AS purchases,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase' AND value >= 150) AS DECIMAL(38,2)) AS purchase_usd,
  min(ts) FILTER (WHERE event_type = 'purchase' AND value >= 150) AS first_purchase,
  max(ts) FILTER (WHERE event_type = 'purchase' AND value >= 150) AS last_purchase,
  count(*) FILTER (WHERE event_type <> 'purchase') AS wagers,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type <> 'purchase') AS DECIMAL(38,2)) AS wagered
FROM events GROUP BY user_id"""
    out["insights_bundle"] = _insights(cfg, out)
    return out


def _insights(cfg: Config, texts: dict[str, str]) -> str:
    """Every section of the insights document as (section, position, key, number, text) rows."""
    from paylens.operators.bundle import SECTIONS
    parts = []
    for s in SECTIONS:
        if s.query:
            source = f"({texts[s.query]})"
        else:  # the score weights are configuration
            weights = [*((t.feature, t.weight) for t in cfg.score_terms), ("stated_intent", cfg.intent_weight)]
            source = "(VALUES " + ", ".join(f"('{f}', {w})" for f, w in weights) + ") AS w(feature, weight)"
        order = ", ".join(f"{o} NULLS FIRST" if isinstance(o, str) else f"{o[0]} DESC NULLS LAST" for o in s.order)
        position = f"row_number() OVER (ORDER BY {order}) - 1" if order else "0"
        cells = ", ".join(
            "{" + f"'key': '{c}', 'number': " + ("CAST(NULL AS DOUBLE)" if c in s.texts else f"CAST({c} AS DOUBLE)")
            + ", 'text': " + (f"CAST({c} AS VARCHAR)" if c in s.texts else "CAST(NULL AS VARCHAR)") + "}" for c in s.columns)
        parts.append(f"SELECT '{s.path}' AS section, CAST(position AS INTEGER) AS position, e.key AS key, e.number AS number, "
                     f"e.text AS text FROM (SELECT position, unnest([{cells}]) AS e FROM "
                     f"(SELECT *, {position} AS position FROM {source}))")
    return "\nUNION ALL ".join(parts)


def _grouped(cfg: Config, W, base, tgt: str, loss_sel: str) -> dict[str, str]:
    """The same analyses per tenant, where ranks, tops and maxima restart per group."""
    tn, out = "acquisition_source", {}
    out["deciles_by_tenant"] = W(f"""SELECT {tn}, player_id, propensity,
  CAST(ntile({cfg.n_tiles}) OVER (PARTITION BY {tn} ORDER BY propensity, player_id) AS INTEGER) AS decile
FROM scored WHERE is_holdout""")
    payer = "SELECT *, CAST(lifetime_usd * 100 AS HUGEINT) AS v FROM scored WHERE is_payer"
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY {tn} ORDER BY v, player_id) AS rn, "
              f"count(*) OVER (PARTITION BY {tn}) AS n FROM ({payer})")
    picks, outs = [], []
    for i, (a, b, name) in enumerate(((1, 2, "median_usd"), (9, 10, "p90_usd"), (99, 100, "p99_usd"))):
        lo = f"((n - 1) * {a} // {b} + 1)"
        picks += [f"max(v) FILTER (WHERE rn = {lo}) AS lo{i}", f"max(v) FILTER (WHERE rn = LEAST({lo} + 1, n)) AS hi{i}",
                  f"max((n - 1) * {a} % {b}) AS f{i}"]
        outs.append(f"{S.rr_wide(f'(lo{i} * {b} + (hi{i} - lo{i}) * f{i})', str(b * 100), 2)} AS {name}")
    out["whales_by_tenant"] = W(f"""SELECT {tn}, payers, {', '.join(outs)}, max_usd FROM (
  SELECT {tn}, count(*) AS payers, max(lifetime_usd) AS max_usd, {', '.join(picks)} FROM ({ranked}) GROUP BY {tn})""")
    out["target_countries_by_tenant"] = W(f"""SELECT {tn}, country_code, targets FROM (
  SELECT {tn}, country_code, count(*) AS targets,
         row_number() OVER (PARTITION BY {tn} ORDER BY count(*) DESC, country_code) AS place
  FROM scored WHERE {tgt} AND country_code IS NOT NULL GROUP BY {tn}, country_code) WHERE place <= {cfg.top_countries_target}""")
    ab = cfg.active_band
    out["retention_pct_of_max_by_tenant"] = W(f"""SELECT *, CAST(100 AS DOUBLE) * payer_pct / max(payer_pct) OVER (PARTITION BY {tn})
  AS pct_of_max FROM (SELECT {tn}, {S.band_label('b', ab)} AS bucket, ord, players, payer_pct FROM (
    SELECT {tn}, {S.band_ord('active_days', ab)} AS b, min(active_days) AS ord, count(*) AS players,
           {S.rate_pct('is_payer')} AS payer_pct FROM scored GROUP BY {tn}, b))""")
    return out


def _sketches(W) -> dict[str, str]:
    """What the sketches must say: counts that are exact at this size, quantiles inside their bound."""
    tn = "acquisition_source"
    done = "SELECT *, CAST(date_trunc('month', created_at) AS DATE) AS period_start FROM pcoin_transaction WHERE status = 'completed'"
    return {
        "whales_from_sketches": W(f"""SELECT {tn}, count(*) AS payers, max(lifetime_usd) AS max_usd, true AS median_within,
  true AS p90_within, true AS p99_within FROM scored WHERE is_payer GROUP BY {tn}"""),
        "buyers_from_sketches": W(f"""SELECT product_id, count(*) AS n, count(DISTINCT player_id) AS people FROM ({done})
WHERE player_id IS NOT NULL GROUP BY product_id"""),
        "monthly_buyer_overlap": W(f"""SELECT a.period_start, count(*) AS buyers, count(b.player_id) AS returning,
  count(*) - count(b.player_id) AS others
FROM (SELECT DISTINCT period_start, player_id FROM ({done}) WHERE player_id IS NOT NULL) a
LEFT JOIN (SELECT DISTINCT period_start, player_id FROM ({done})) b
  ON b.player_id = a.player_id AND CAST(b.period_start + INTERVAL 1 MONTH AS DATE) = a.period_start
GROUP BY a.period_start"""),
        "scored_store_bucketed": W("SELECT player_id, is_payer, lifetime_usd, n_games_hosted, propensity, is_holdout FROM scored")}


def _streams() -> dict[str, str]:
    """What the streams must equal, over all events at once."""
    live = "SELECT * FROM events WHERE event_id + 1 NOT IN (SELECT event_id FROM events WHERE event_type = 'error')"
    money = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2))"
    return {"incremental_player_profile": f"""WITH live AS ({live}),
games AS (SELECT user_id AS player_id, count(*) AS n_games_hosted, {money} AS pcoins_wagered FROM live GROUP BY user_id),
modes AS (SELECT user_id AS player_id, first(event_type ORDER BY times DESC, event_type) AS fav_game
          FROM (SELECT user_id, event_type, count(*) AS times FROM live WHERE event_type IS NOT NULL GROUP BY ALL) GROUP BY user_id),
surveys AS (SELECT user_id AS player_id, event_id AS survey_id, props AS responses FROM live WHERE event_type = 'view'
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1),
buys AS (SELECT user_id AS player_id, count(*) AS n_purchases, {money} AS pcoin_usd, min(ts) AS first_buy FROM live
         WHERE event_type = 'purchase' AND CAST(value AS DECIMAL(18,2)) >= 150 GROUP BY user_id)
SELECT * FROM games LEFT JOIN modes USING (player_id) LEFT JOIN surveys USING (player_id) LEFT JOIN buys USING (player_id)""",
            "incremental_play_sessions": f"""WITH marked AS (
  SELECT user_id, ts, value, COALESCE(ts > lag(ts) OVER w + INTERVAL 30 MINUTE, true) AS fresh
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nr FROM marked)
SELECT user_id AS player_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
       {money} AS amount FROM numbered GROUP BY user_id, nr"""}


def _fitted(cfg: Config, base, matrix: str, steps: int = 12) -> dict[str, str]:
    """M4, M6-M8: Newton's method in SQL. A step sums gradient and Hessian over
    the training rows into an augmented matrix, which is then eliminated
    column by column (one recursion per column)."""
    names, d = cfg.model_features, len(cfg.model_features) + 1
    moments = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS s_{f}" for f in names)
    x = ", ".join([f"({f} - m_{f}) / s_{f}" for f in names] + ["CAST(1 AS DOUBLE)"])
    ridge = [cfg.reg_param] * (d - 1) + [0.0]
    rows = ", ".join("[" + ", ".join(
        [f"avg(p * (1 - p) * x[{i + 1}] * x[{j + 1}])" + (f" + {ridge[i]!r}" if i == j else "") for j in range(d)]
        + [f"avg((p - y) * x[{i + 1}]) + {ridge[i]!r} * any_value(w[{i + 1}])"]) + "]" for i in range(d))
    ctes = [*base, f"m AS ({matrix})", f"mom AS (SELECT {moments} FROM m WHERE is_test = 0)",
            "cb AS (SELECT count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM m WHERE is_test = 0)",
            f"kk AS (SELECT p, n, CASE WHEN p > 0 THEN GREATEST(1, n // ({cfg.neg_per_pos} * p)) ELSE 1 END AS k FROM cb)",
            """negs AS (SELECT player_id, row_number() OVER (
  ORDER BY CAST(('0x' || substr(md5(CAST(player_id AS VARCHAR)), 1, 8)) AS BIGINT), player_id) AS rn
  FROM m WHERE is_test = 0 AND y = 0)""",
            f"zs AS MATERIALIZED (SELECT player_id, is_test, CAST(y AS DOUBLE) AS y, [{x}] AS x FROM m, mom)",
            """tr AS MATERIALIZED (SELECT y, x FROM zs WHERE is_test = 0 AND (y = 1 OR player_id IN (
  SELECT player_id FROM negs, kk WHERE (rn - 1) % k = 0)))""",
            f"w0 AS MATERIALIZED (SELECT [{', '.join(['CAST(0 AS DOUBLE)'] * d)}] AS w)"]
    for k in range(1, steps + 1):
        ctes += [f"p{k} AS MATERIALIZED (SELECT x, y, w, 1 / (1 + exp(-list_dot_product(x, w))) AS p FROM tr, w{k - 1})",
                 f"a{k} AS MATERIALIZED (SELECT [{rows}] AS h FROM p{k})",
                 f"""e{k}(i, h) AS (SELECT CAST(1 AS BIGINT), h FROM a{k} UNION ALL SELECT i + 1, list_transform(h, lambda r, j:
  CASE WHEN j = i THEN list_transform(r, lambda v, c: v / h[i][i])
       ELSE list_transform(r, lambda v, c: v - r[i] * h[i][c] / h[i][i]) END) FROM e{k} WHERE i <= {d})""",
                 f"w{k} AS MATERIALIZED (SELECT list_transform(w, lambda v, j: v - h[j][{d + 1}]) AS w FROM e{k}, w{k - 1} WHERE i = {d + 1})"]

    def text(*more: str, select: str) -> str:
        return with_ctes(*ctes, *more, select=select).replace("WITH", "WITH RECURSIVE", 1)
    out = {"model_coefficients": text(select="\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, round(w[{i + 1}], 3) + 0.0 AS coef, round(exp(w[{i + 1}]), 2) AS odds_per_sd FROM w{steps}"
        for i, f in enumerate(names)))}
    z = "list_dot_product(x, w)"
    clipped = f"CASE WHEN {z} < -30 THEN 1e-13 WHEN {z} > 30 THEN 1 ELSE 1 / (1 + exp(-{z})) END"
    out["model_report"] = text(
        f"hold AS MATERIALIZED (SELECT player_id, CAST(y AS BIGINT) AS y, {clipped} AS s FROM zs, w{steps} WHERE is_test = 1)",
        """areas AS (SELECT s, n, pos, sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
  FROM (SELECT s, count(*) AS n, sum(y) AS pos FROM hold GROUP BY s))""",
        f"""tops AS (SELECT count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, count(*) FILTER (WHERE rn <= tot // {cfg.n_tiles}) AS top_n,
  CAST(sum(y) FILTER (WHERE rn <= tot // {cfg.n_tiles}) AS BIGINT) AS top_positives
  FROM (SELECT *, row_number() OVER (ORDER BY s DESC, player_id) AS rn, count(*) OVER () AS tot FROM hold))""",
        f"""area AS (SELECT {S.rr_wide('sum(pos * (2 * (COALESCE(below, 0) + 1) + n - 1)) - sum(pos) * (sum(pos) + 1)',
                                    '2 * sum(pos) * (sum(n) - sum(pos))', 3)} AS test_auc FROM areas)""",
        select=f"""SELECT 'logistic regression (Newton, L2 on weights)' AS model, kk.p + (kk.n + k - 1) // k AS train_rows, tops.n AS test_rows,
  'trained on ' || kk.p || ' payers + ' || ((kk.n + k - 1) // k) || ' sampled non-payers' AS class_balance, test_auc,
  {S.pct('positives', 'tops.n')} AS test_base_rate_pct, {S.pct('top_positives', 'top_n')} AS top_decile_rate_pct,
  {S.rr_wide('top_positives * tops.n', 'top_n * positives', 1)} AS top_decile_lift,
  'Coefficients are per +1 SD of the feature; odds_per_sd > 1 means the feature raises the odds of paying.' AS note
FROM kk, tops, area""")
    return out


def _model(cfg: Config, W, base, matrix: str) -> dict[str, str]:
    """M4/M8: the fitted point has no gradient. M5: scores under a fixed coefficient vector."""
    from paylens.operators.model import CHECK_COEFFICIENTS, CHECK_INTERCEPT, SIGMOID_CLIP
    out = {"model_gradient": "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(0 AS DOUBLE) AS gradient" for f in (*cfg.model_features, "intercept"))}
    moments = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS s_{f}"
                        for f in cfg.model_features)
    z = " + ".join([f"CAST({CHECK_INTERCEPT!r} AS DOUBLE)"] + [
        f"(({f} - m_{f}) / s_{f}) * CAST({CHECK_COEFFICIENTS[f]!r} AS DOUBLE)" for f in cfg.model_features])
    out["model_scores"] = with_ctes(*base, f"\nm AS ({matrix})", f"\nmom AS (SELECT {moments} FROM m WHERE is_test = 0)", select=f"""
SELECT player_id, y, round(CASE WHEN z < -{SIGMOID_CLIP} THEN 1e-13 WHEN z > {SIGMOID_CLIP} THEN 1 ELSE 1 / (1 + exp(-z)) END, 6) AS score
FROM (SELECT player_id, y, {z} AS z FROM m, mom WHERE is_test = 1)""")
    return out
