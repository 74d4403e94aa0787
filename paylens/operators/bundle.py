"""V3 insights bundle and V4 brief facts.

The bundle is a report: every section is an aggregate whose rows are bands,
levers, products, games, reasons or countries. ``insights_rows`` returns all
of it as rows of any number. ``insights_document`` renders the same sections
as one nested JSON document in the published shape; there a section's rows
meet in one JSON array, so its contract is that products, game types and
stated reasons are report-sized lists (thousands, not millions).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS, OBJECT, MERGE, SCALAR, MAP = "rows", "object", "merge", "scalar", "map"


@dataclass(frozen=True)
class Section:
    """One part of the document. ``shape``: an array of rows, one object, an
    object merged into its parent, one value, or a key -> value map."""
    path: str
    query: str
    shape: str
    columns: tuple[str, ...]
    order: tuple = ()
    texts: tuple[str, ...] = ()

    @property
    def parent(self) -> str:
        return self.path.split(".")[0]

    @property
    def name(self) -> str:
        return self.path.split(".")[-1]


def _s(path, query, shape, columns, order=(), texts=()):
    return Section(path, query, shape, tuple(columns.split()), tuple(order), tuple(texts.split()) if texts else ())


# Names and nesting of the published document.
SECTIONS = (
    _s("headline", "headline", OBJECT, "players payers payer_pct total_usd arppu_usd surveyed stated_yes_payer_pct "
       "stated_no_payer_pct"),
    _s("why_pay.product_mix", "product_mix", ROWS, "product_id tx ppl usd", [("usd", "desc"), "product_id"], "product_id"),
    _s("why_pay.wagering_by_game", "wagering_by_game", ROWS, "game_type sessions hosts pcoins_wagered",
       [("sessions", "desc"), "game_type"], "game_type"),
    _s("why_pay.cosmetics_gap", "cosmetics_gap", OBJECT, "players_with_furniture_or_wardrobe total_players pct"),
    _s("why_pay.payer_archetypes", "payer_archetypes", ROWS, "archetype players usd avg_wagered avg_streak",
       [("usd", "desc"), "archetype"], "archetype"),
    _s("payer_dna.loss_chasing", "loss_chasing", ROWS, "ord bucket players payer_pct", ["ord"], "bucket"),
    _s("payer_dna.bet_size_lift", "bet_size_lift", ROWS, "ord bucket players payer_pct", ["ord"], "bucket"),
    _s("payer_dna.game_type_pay", "game_type_pay", ROWS, "fav_game players payer_pct", [("payer_pct", "desc"), "fav_game"],
       "fav_game"),
    _s("payer_dna.payer_psychology", "payer_psychology", ROWS, "grp players avg_games win_rate avg_wagered avg_net_pcoins",
       ["grp"], "grp"),
    _s("payer_dna.why_never_bought", "why_never_bought", ROWS, "reason n", [("n", "desc"), "reason"], "reason"),
    _s("behavior_diff.predictor_lift", "predictor_lift", ROWS, "feature high_pct low_pct lift", [("lift", "desc"), "feature"],
       "feature"),
    _s("propensity.decile_payer_rate", "decile_payer_rate", ROWS, "decile players payer_pct", ["decile"]),
    _s("propensity.summary", "holdout_summary", MERGE, "holdout_size holdout_base_payer_pct top_decile_payer_pct "
       "top_decile_lift"),
    _s("propensity.weights", "", MAP, "feature weight", ["feature"], "feature"),
    _s("convert_more.target_pool", "target_pool", OBJECT, "high_propensity_nonpayers total_nonpayers avg_wagered avg_streak"),
    _s("convert_more.target_by_country", "target_by_country", ROWS, "country_code targets", [("targets", "desc"), "country_code"],
       "country_code"),
    _s("convert_more.conversion_moment", "conversion_moment", OBJECT, "same_day_pct within_7d_pct median_lag_days"),
    _s("convert_more.wagered_before_paying_pct", "wagered_share_of_payers", SCALAR, "wagered_before_paying_pct"),
    _s("expand_more.purchase_freq", "purchase_freq", ROWS, "bucket ord payers usd", ["ord"], "bucket"),
    _s("expand_more.one_time_vs_repeat", "one_time_vs_repeat", ROWS, "grp players avg_wagered avg_streak avg_active_days",
       ["grp"], "grp"),
    _s("expand_more.whale_concentration", "whale_concentration", OBJECT, "payers median_usd p90_usd p99_usd max_usd"),
    _s("expand_more.prime_cross_sell", "prime_cross_sell", OBJECT, "pcoin_buyers_not_prime their_lifetime_usd"),
    _s("social_retention_geo.social", "social_rates", OBJECT, "invited_in_payer_pct organic_payer_pct inviter_payer_pct "
       "noninviter_payer_pct"),
    _s("social_retention_geo.retention_x_pay", "retention_x_pay", ROWS, "bucket ord players payer_pct", ["ord"], "bucket"),
    _s("social_retention_geo.geo", "geo", ROWS, "country_code players payer_pct usd", [("players", "desc"), "country_code"],
       "country_code"),
    _s("diagnostic.levers", "levers", ROWS, "lever pool assumption est_upside_usd", [("est_upside_usd", "desc"), "lever"],
       "lever assumption"),
    _s("revenuecat_validation", "revenue_reconciliation", OBJECT, "rc_total_revenue_usd db_total_revenue_usd "
       "rc_active_users_28d diff_usd diff_pct within_tolerance note", [], "note"),
)
MODEL = "model"   # stands between the levers and the validation


def _order_columns(order) -> list[Column]:
    cols = [(o, "asc") if isinstance(o, str) else o for o in order]
    return [F.col(n).desc_nulls_last() if d == "desc" else F.col(n).asc_nulls_first() for n, d in cols]


def insights_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """V3 as rows: section, position in its order, key, number or text.
    ``frames``: section path -> analysis result."""
    parts = []
    for s in SECTIONS:
        df = frames[s.path].select(*s.columns)
        position = F.row_number().over(Window.orderBy(*_order_columns(s.order))) - 1 if s.order else F.lit(0)
        cells = F.array(*[F.struct(
            F.lit(c).alias("key"),
            (F.lit(None) if c in s.texts else F.col(c)).cast("double").alias("number"),
            (F.col(c) if c in s.texts else F.lit(None)).cast("string").alias("text")) for c in s.columns])
        parts.append(df.withColumn("position", position.cast("int"))
                     .select(F.lit(s.path).alias("section"), "position", F.inline(cells)))
    return reduce(DataFrame.unionByName, parts)


def _sort_key(order) -> Column:
    """Ascending struct key for ``sort_array``: (col, "desc") pairs, numbers
    descending by negation with NULLs last, anything else ascending."""
    parts = []
    for i, o in enumerate(order):
        name, direction = (o, "asc") if isinstance(o, str) else o
        c = F.col(name)
        if direction == "desc":
            parts += [c.isNull().alias(f"n{i}"), (-c).alias(f"k{i}")]
        else:
            parts.append(c.alias(f"k{i}"))
    return F.struct(*parts) if parts else F.struct(F.lit(0).alias("k"))


_KEEP_NULLS = {"ignoreNullFields": "false"}


def _member(s: Section, df: DataFrame, pos: int) -> DataFrame:
    """One section as text of its parent object: pos, parent, member."""
    row = F.struct(*[F.col(c) for c in s.columns])
    rows = F.transform(F.sort_array(F.collect_list(F.struct(_sort_key(s.order).alias("o"), row.alias("r")))), lambda x: x["r"])
    one = df.agg(rows.alias("rows"))
    first = F.try_element_at("rows", F.lit(1))
    name = F.lit(f'"{s.name}":')
    text = {
        ROWS: F.concat(name, F.to_json("rows", _KEEP_NULLS)),
        OBJECT: F.concat(name, F.coalesce(F.to_json(first, _KEEP_NULLS), F.lit("{}"))),
        MERGE: F.coalesce(F.regexp_replace(F.to_json(first, _KEEP_NULLS), r"^\{|\}$", ""), F.lit("")),
        SCALAR: F.concat(name, F.coalesce(first[s.columns[0]].cast("string"), F.lit("null"))),
        MAP: F.concat(name, F.to_json(F.map_from_entries("rows"))) if s.shape == MAP else F.lit(""),
    }[s.shape]
    return one.select(F.lit(pos).alias("pos"), F.lit(s.parent).alias("parent"), text.alias("member"),
                      F.lit("." in s.path).alias("nested"))


def insights_members(frames: dict[str, DataFrame]) -> DataFrame:
    """Each section as a member of its parent object, one row per section."""
    return reduce(DataFrame.unionByName, [_member(s, frames[s.path], 2 * i) for i, s in enumerate(SECTIONS)])


def insights_document(members: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """V3 as one JSON document (column ``document``) from ``insights_members``.
    ``model``: the model report, one row and column of JSON text."""
    parts = [members]
    if model is not None:
        after = 2 * [s.path for s in SECTIONS].index("diagnostic.levers") + 1
        value = F.col(model.columns[0])
        parts.append(model.select(F.lit(after).alias("pos"), F.lit(MODEL).alias("parent"),
                                  F.concat(F.lit(f'"{MODEL}":'), value).alias("member"), F.lit(False).alias("nested")))
    members = reduce(DataFrame.unionByName, parts)
    ordered = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["t"]), ",")
    groups = members.filter("member <> ''").groupBy("parent").agg(
        F.min("pos").alias("pos"), F.max("nested").alias("nested"),
        ordered(F.struct("pos", F.col("member").alias("t"))).alias("body"))
    text = F.when(F.col("nested"), F.concat(F.lit('"'), F.col("parent"), F.lit('":{'), F.col("body"), F.lit("}"))).otherwise(
        F.col("body"))
    return groups.agg(F.concat(F.lit("{"), ordered(F.struct("pos", text.alias("t"))), F.lit("}")).alias("document"))


def brief_facts(head: DataFrame, lever_table: DataFrame, wager_share: DataFrame, moment: DataFrame,
                cosmetics: DataFrame, lift: DataFrame, holdout: DataFrame, pool: DataFrame,
                freq: DataFrame, cross_sell: DataFrame) -> DataFrame:
    """V4: the numbers a written brief needs, as one row of scalar subqueries
    (field names and their order are fixed values)."""
    top = lever_table.orderBy(F.col("est_upside_usd").desc(), F.col("lever")).limit(1)
    lift_of = lambda prefix: lift.filter(F.col("feature").startswith(prefix)).select(F.max("lift")).scalar()
    return head.select(
        top.select(F.first("lever")).scalar().alias("top_lever"),
        top.select(F.first("est_upside_usd")).scalar().alias("top_usd"),
        top.select(F.first("pool")).scalar().alias("top_pool"),
        wager_share.select(F.first("wagered_before_paying_pct")).scalar().alias("wagered_before_pct"),
        moment.select(F.first("same_day_pct")).scalar().alias("same_day_pct"),
        cosmetics.select(F.first("pct")).scalar().alias("cosmetics_pct"),
        lift_of("wagered").alias("wager_lift"),
        lift_of("stated intent").alias("intent_lift"),
        holdout.select(F.first("top_decile_payer_pct")).scalar().alias("top_decile_pct"),
        holdout.select(F.first("holdout_base_payer_pct")).scalar().alias("base_decile_pct"),
        holdout.select(F.first("top_decile_lift")).scalar().alias("decile_lift"),
        "payers", "players", "payer_pct", "total_usd", F.col("arppu_usd").alias("arppu"),
        pool.select(F.first("high_propensity_nonpayers")).scalar().alias("hp_nonpayers"),
        freq.filter(F.col("ord") == 1).select(F.max("payers")).scalar().alias("one_timers"),
        cross_sell.select(F.first("pcoin_buyers_not_prime")).scalar().alias("prime_pool"))
