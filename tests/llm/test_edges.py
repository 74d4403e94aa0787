"""Every operator on nulls, empty and long texts, ties, repeats, clashing names and no rows."""

import pytest

from paylens.llm import (binslack, ctw, dartminhash, decontam, divergence, gracededup, hilbert, importance, linededup, ordinal,
                         rollups, toxgrammar)
import corpus_pipeline

ITEMS = [(1, "sat on the mat"), (2, None), (3, ""), (None, "cat sat"), (1, "sat on the mat")]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (7, 0, 1), (9, None, None), (None, 1, 1), (77, 1, 0)],
                                 "doc_id long, quality int, toxic int")


PER_ROW = {
    "hilbert": lambda s, d: hilbert.assign(d),
    "ordinal": lambda s, d: ordinal.quality(d, ordinal.fit(d, ordinal.graded(labels(s)), 3)),
    "decontam": lambda s, d: decontam.contamination(d, items(s)),
    "minhash": lambda s, d: dartminhash.near_duplicate_classes(d),
    "ctw": lambda s, d: ctw.log_scores(d, depth=3),
    "toxicity": lambda s, d: toxgrammar.scores(d, toxgrammar.fit(d, labels(s))),
    "grace": lambda s, d: gracededup.exact_groups(d),
    "importance": lambda s, d: importance.resample(d, items(s)),
    "importance_trigrams": lambda s, d: importance.resample(d, items(s), n=3, min_words=1, percent=100),
    "lines": lambda s, d: linededup.dedup_lines(d, with_text=True),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(spark, odd_docs, no_docs, name):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in PER_ROW[name](spark, odd_docs).collect())
    assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in odd_docs.select("doc_id").collect())
    assert PER_ROW[name](spark, no_docs).collect() == []


def test_audit_of_odd_groups(spark, odd_docs, no_docs):
    """Null lang and source are groups named ''; no kept terms: pairs of 0; one source: no pairs."""
    rows = [tuple(r) for r in divergence.audit(odd_docs).collect()]
    assert sorted(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1), ("fr", "", "pair", "a", 0, 1),
                            ("fr", "a", "pair", "", 0, 1)]
    low = divergence.audit(odd_docs, min_docs=1, top=2)
    # all terms of fr come from one group, whose shares are the lang's own
    assert {(r["lang"], r["source"]) for r in low.filter("part = 'term'").collect()} == {("en", "a"), ("en", "b")}
    assert divergence.audit(no_docs).collect() == []


def test_packing_and_rollups(spark, odd_docs, no_docs):
    pieces = binslack.pack(odd_docs).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] == 1) == 1 and {p["doc_id"] for p in pieces} >= {2, None}
    assert binslack.pack(no_docs).collect() == [] and rollups.corpus_rollup(no_docs).collect() == []
    totals = {(r["source"], r["lang"]): r["distinct_documents"] for r in rollups.corpus_rollup(odd_docs).collect()}
    # doc 1 (null) and doc 2 (empty) are one text: 1 stays; 0 is repeated; 3 and 4 are copies
    assert totals[(None, None)] == 1 and totals[("b", "en")] == 1 and sum(totals.values()) == 8


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("stage", ["exact_dedup", "near_dedup", "toxicity", "decontamination"])
def test_stages_keep_columns(spark, odd_docs, no_docs, tmp_path, stage):
    items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    out = STAGES[stage](spark, odd_docs, str(tmp_path))
    assert out.columns == odd_docs.columns
    rows = [tuple(r) for r in out.collect()]
    assert set(rows) <= {tuple(r) for r in odd_docs.collect()}
    ids = sorted((r[0] for r in rows), key=lambda v: (v is None, v or 0))
    expected = {"exact_dedup": [3, 6, 7, 8, 9, None],     # 9 and 6 (blanks among the empty texts) have the most code points of their groups
                "near_dedup": [0, 1, 2, 3, 6, 7, 8, None],
                "toxicity": [0, 0, 1, 2, 3, 4, 6, 7, 8, 9, None],
                "decontamination": [1, 2, 3, 4, 6, 7, 8, None]}[stage]
    assert ids == expected
    assert STAGES[stage](spark, no_docs, str(tmp_path)).collect() == []
