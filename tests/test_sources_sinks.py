"""S2 JSON document source, S6 CSV export, S7/S8 gated documents."""

import json
import os
import tempfile

import pytest

from tests.conftest import SF001


def test_revenue_document_reconciles(spark):
    from paylens.operators.quality import revenue_reconciliation
    from paylens.plans.workspace import workspace
    from paylens.sources.revenue import read_revenue_document
    d = tempfile.mkdtemp(prefix="paylens-doc-")
    path = os.path.join(d, "revenue.json")
    with open(path, "w") as f:
        json.dump({"overview_28d": {"active_users_28d": 157, "mrr_usd": 4},
                   "revenue_total": {"revenue_usd": 500000000.25, "revenue_type": "gross"}}, f, indent=2)
    doc = read_revenue_document(spark, path)
    ws = workspace(spark, SF001)
    r = revenue_reconciliation(doc, ws.store).first()
    total = ws.store.agg({"lifetime_usd": "sum"}).first()[0]
    assert r.rc_active_users_28d == 157 and r.db_total_revenue_usd == total
    assert r.diff_usd == total - r.rc_total_revenue_usd and r.within_tolerance


def test_csv_export_and_gated_documents(spark):
    from paylens.operators import model
    from paylens.operators.quality import PIIGateError
    from paylens.plans.workspace import workspace
    from paylens.sources import sinks
    ws = workspace(spark, SF001)
    d = tempfile.mkdtemp(prefix="paylens-out-")
    m = model.feature_matrix(ws.store, ws.cfg)
    sinks.export_csv(m, os.path.join(d, "matrix"))
    back = spark.read.option("header", True).csv(os.path.join(d, "matrix"))
    assert back.count() == m.count() and back.columns == m.columns
    bad = spark.createDataFrame([("mail me: x.y@example.org",)], "value string")
    with pytest.raises(PIIGateError):
        sinks.write_document(bad, os.path.join(d, "bad"))
    assert not os.path.exists(os.path.join(d, "bad"))
    good = spark.createDataFrame([('{"a": 1}',)], "value string")
    for _ in range(2):  # a later run replaces the file
        sinks.publish({os.path.join(d, "good.json"): good, os.path.join(d, "rows"): spark.range(3)})
        assert json.load(open(os.path.join(d, "good.json"))) == {"a": 1} and spark.read.json(os.path.join(d, "rows")).count() == 3
    with pytest.raises(PIIGateError, match="email"):  # one bad document holds back all
        sinks.publish({os.path.join(d, "other.json"): good, os.path.join(d, "bad"): bad})
    assert not os.path.exists(os.path.join(d, "other.json")) and not [n for n in os.listdir(d) if "staging" in n]


def test_views_serve_spark_sql(spark):
    """The store as a temp view answers the same question in SQL."""
    from paylens.operators.headline import headline
    from paylens.plans.workspace import workspace
    ws = workspace(spark, SF001)
    assert "player_features" in ws.register_views()
    via_sql = spark.sql("""
        SELECT count(*) AS players, count_if(is_payer) AS payers,
               CAST(sum(lifetime_usd) AS decimal(38,2)) AS total_usd
        FROM player_features""").first()
    h = headline(ws.store).first()
    assert (via_sql.players, via_sql.payers, via_sql.total_usd) == (h.players, h.payers, h.total_usd)
    econ = spark.sql("SELECT count(*) AS n, sum(games) AS g FROM pgs").first()
    assert econ.n == ws.economy.count() and econ.g > 0


def test_store_sink_partitioned_by_tenant(spark):
    """X4 sink: the store written with one folder per tenant reads back whole."""
    from paylens.plans.workspace import workspace
    from paylens.sources.sinks import write_store
    ws = workspace(spark, SF001)
    path = os.path.join(tempfile.mkdtemp(prefix="paylens-tenant-"), "store")
    write_store(ws.store, path, partition_by="acquisition_source")
    tenants = sorted(d for d in os.listdir(path) if d.startswith("acquisition_source="))
    assert len(tenants) == ws.store.select("acquisition_source").distinct().count()
    back = spark.read.parquet(path)
    assert back.count() == ws.store.count()
    one = tenants[0].split("=", 1)[1]
    assert back.filter(f"acquisition_source = '{one}'").count() == \
        ws.store.filter(f"acquisition_source = '{one}'").count()


def test_gate_blocks_every_write(spark):
    """A personal-data-shaped value reaching any document stops the run
    before a single output is written."""
    from pyspark.sql import functions as F

    from paylens.operators.quality import PIIGateError
    from paylens.plans.run import run_all
    from paylens.plans.workspace import Workspace
    from paylens.sources.bindings import bind_fixture_tables
    from tests.conftest import SF0001
    ws = Workspace(spark, SF0001)
    roles = bind_fixture_tables(ws.tables)
    # half the players get an email as country: it becomes the top country of
    # the geo section (a single player would not make the top-10 report)
    roles.player = roles.player.withColumn(
        "country_code", F.when(F.col("player_id") % 2 == 0, F.lit("someone@example.com"))
        .otherwise(F.col("country_code")))
    ws.__dict__["roles"] = roles
    out = os.path.join(tempfile.mkdtemp(prefix="paylens-gate-"), "out")
    with pytest.raises(PIIGateError, match="email"):
        run_all(spark, SF0001, out, ws=ws)
    assert not os.path.exists(out)


def test_role_tables_read_back_give_the_same_store(spark):
    """S1 production path: one folder per role, read back, same store."""
    from paylens.operators.features import STORE_COLUMNS, feature_store
    from paylens.sources.bindings import ROLES, bind_fixture_tables
    from paylens.sources.tables import Tables, read_role_tables
    from tests.conftest import SF0001
    roles = bind_fixture_tables(Tables(spark, SF0001))
    root = os.path.join(tempfile.mkdtemp(prefix="paylens-roles-"), "roles")
    for name, df in roles.as_dict().items():
        df.write.parquet(os.path.join(root, name))
    back = read_role_tables(spark, root)
    assert set(back.as_dict()) == set(ROLES)
    a = feature_store(roles).select(*STORE_COLUMNS)
    b = feature_store(back).select(*STORE_COLUMNS)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_variant_role_tables_give_the_same_store(spark, tmp_path):
    """The semi-structured columns as VARIANT, written and read back: same store, economy and barriers."""
    from pyspark.sql import functions as F

    from paylens.operators.economy import player_game_economy
    from paylens.operators.features import STORE_COLUMNS, feature_store
    from paylens.operators.payer_dna import why_never_bought
    from paylens.sources.bindings import ROLES, bind_fixture_tables
    from paylens.sources.tables import Tables, read_role_tables
    from tests.conftest import SF0001
    roles = bind_fixture_tables(Tables(spark, SF0001))
    nested = {"survey_response": ("responses",), "room": ("furniture_objects", "wardrobe_items"), "game_session": ("participants", "winner_ids")}
    for name, df in roles.as_dict().items():
        for c in nested.get(name, ()):
            text = F.col(c) if df.schema[c].dataType.simpleString() == "string" else F.to_json(c)
            df = df.withColumn(c, F.try_parse_json(text))
        if name == "game_session":     # participants as objects, as the source has them
            ids = F.transform(F.from_json(F.to_json("participants"), "array<bigint>"), lambda i: F.struct(i.cast("string").alias("playerId")))
            df = df.withColumn("participants", F.try_parse_json(F.to_json(ids)))
        df.write.parquet(str(tmp_path / name))
    back = read_role_tables(spark, str(tmp_path))
    assert back.survey_response.schema["responses"].dataType.simpleString() == "variant" and set(back.as_dict()) == set(ROLES)
    a, b = (feature_store(r).select(*STORE_COLUMNS) for r in (roles, back))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    a, b = (player_game_economy(r.game_session) for r in (roles, back))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    store = feature_store(roles)
    a, b = (why_never_bought(r.survey_response, store) for r in (roles, back))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) != []


def test_variant_helpers_read_odd_documents_as_text_does(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from paylens.functions import json as J
    docs = ['[1, "a", null, {"playerId": 7}, {"playerId": "x"}, {"other": 1}]', "[]", "{}", '{"a": 1, "b": null, "c": ["x"], "d": {"e": 2}, "f": "t"}',
            "3", '"text"', "null", None, '[{"playerId": null}]']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, t string").withColumn("v", F.try_parse_json("t"))
    text, var = T.StringType(), T.VariantType()
    for name, fn in (("len", J.array_len), ("ids", J.participant_ids),
                     ("fields", lambda c, d: J.object_fields(c, d, ("a", "b", "c", "d", "f", "g")))):
        rows = df.select("i", "t", fn(F.col("t"), text).alias("x"), fn(F.col("v"), var).alias("y")).collect()
        for r in rows:
            x, y = (tuple(v) if isinstance(v, tuple) else v for v in (r["x"], r["y"]))
            if name == "fields":                        # a value that is no object has no fields either way
                x, y = x or (None,) * 6, y or (None,) * 6
            assert x == y, (name, r["t"], x, y)


def test_player_rows_never_reach_the_published_folder(spark):
    """An email in one player's row that no aggregate shows: the documents
    are clean and are written; the row itself is in no published file."""
    from pyspark.sql import functions as F

    from paylens.plans.run import run_all
    from paylens.plans.workspace import Workspace
    from paylens.sources.bindings import bind_fixture_tables
    from tests.conftest import SF0001
    ws = Workspace(spark, SF0001)
    roles = bind_fixture_tables(ws.tables)
    roles.player = roles.player.withColumn("gender", F.when(F.col("player_id") == 1, F.lit("a.b@example.org")))
    ws = Workspace(spark, SF0001, roles=roles)
    out = os.path.join(tempfile.mkdtemp(prefix="paylens-private-"), "out")
    run_all(spark, SF0001, out, ws=ws)
    texts = "".join(open(os.path.join(d, f), errors="replace").read() for d, _, names in os.walk(out) for f in names)
    assert "headline" in texts and "example.org" not in texts
    ws.release()


def test_roles_subset_and_jdbc_shape(spark, tmp_path):
    """Roles left out are empty tables; explicit schemas need no inference."""
    from paylens.sources.bindings import ROLES
    from paylens.sources.tables import read_role_tables
    spark.createDataFrame([(1, 5)], "player_id bigint, current_streak int").write.parquet(str(tmp_path / "player_room"))
    back = read_role_tables(spark, str(tmp_path), roles=["player_room"])
    assert back.player_room.count() == 1 and back.player.count() == 0 and set(back.as_dict()) == set(ROLES)
    with pytest.raises(ValueError, match="unknown"):
        read_role_tables(spark, str(tmp_path), roles=["nope"])


@pytest.mark.parametrize("external, stored", [("1e20", "3e16"), ("3e16", "1e20"), ("100", "104"), ("0", "5")])
def test_reconciliation_of_very_large_totals(spark, external, stored):
    from decimal import Decimal
    from paylens.operators.quality import revenue_reconciliation
    ext, own = int(float(external)), int(float(stored))
    src = spark.createDataFrame([(Decimal(ext), 1)], "revenue_usd decimal(38,2), active_users_28d bigint")
    store = spark.createDataFrame([(Decimal(own),)], "lifetime_usd decimal(38,2)")
    r = revenue_reconciliation(src, store).first()
    assert r.diff_usd == own - ext
    if ext:
        assert r.diff_pct == pytest.approx(100 * (own - ext) / ext, abs=0.006)
    else:
        assert r.diff_pct is None


def test_pii_scan_pattern_is_equal_and_linear(spark):
    import random
    import re
    import time

    from paylens.operators.quality import EMAIL_PATTERN, pii_scan
    r = random.Random(2)
    texts = ["".join(r.choice("ab.@-_% \n1") for _ in range(r.randint(0, 14))) for _ in range(3000)]
    piece = lambda chars: "".join(r.choice(chars) for _ in range(r.randint(0, 4)))
    texts += [piece("ab \n%") + r.choice(["@", "@", "%@", " @"]) + piece("ab.-_") + r.choice([".", "", ".."]) + piece("abc1")
              for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {row.kind: row.violations for row in pii_scan(df, "x").collect()}
    found = sum(bool(re.search(EMAIL_PATTERN, t)) for t in texts)
    assert got["email"] == found and 100 < found < len(texts)
    long = spark.createDataFrame([("w" * 1_000_000 + " @",)], "t string")
    pii_scan(long, "x").collect()
    t0 = time.time()
    assert {row.violations for row in pii_scan(long, "x").collect()} == {0}
    assert time.time() - t0 < 2
