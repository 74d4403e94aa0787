"""Operators that SQL expresses, against DuckDB; more of the same under weak hashes."""

import re

import pytest

from paylens.llm import decontam, gracededup
from paylens.llm.registry import ORACLES, QUERIES
from tests.conftest import SF001
from tests.oracle_compare import duck, rows_of


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF001)
    cur = duck(SF001).execute(ORACLES[name])
    got, names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want, want_names = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert names == want_names and len(got) == len(want) > 0
    assert sorted(got, key=repr) == sorted(want, key=repr)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("hasher", [gracededup.content_hash, lambda sha: 7, lambda sha: sha[0]])
def test_colliding_hashes_never_merge_texts(spark, hasher):
    texts = ["a b", "ab", "a\tb ", "b a", None, "", "c" * 5000, "c" * 5000, "d"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in gracededup.exact_groups(docs, hasher, block_bytes=64, table_bytes=100).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if normal(u) == normal(t)]
        keep = min(same, key=lambda j: (-len(texts[j] or ""), j))
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (keep, len(same), i == keep)
    kept = gracededup.drop_exact_copies(docs, hasher, block_bytes=64, table_bytes=100)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in got if got[i]["kept"])


def test_short_items_and_overlaps(spark):
    docs = spark.createDataFrame([(1, "A b c d e f g h i j k l"), (2, "x y"), (3, "b c d e f g h i j k"), (4, "Y! x, y")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(10, "a b c d e f g h i j k"), (9, "Y"), (11, "x y"), (12, "--")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontam.contamination(docs, items).collect()}
    assert got == {1: (12, 11, 1), 2: (2, 2, 2), 3: (10, 10, 1), 4: (3, 3, 2)}
    none = decontam.contamination(docs, items.filter("false")).collect()
    assert all(not r["contaminated"] and r["n_words"] > 0 for r in none) and len(none) == 4


def test_decontamination_has_no_python(spark):
    from paylens.llm.common import table
    df = decontam.contamination(table(spark, SF001, "documents"), table(spark, SF001, "benchmark"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
