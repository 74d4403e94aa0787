"""The operators' queries (spark, sf_dir) -> DataFrame and their DuckDB SQL."""

from __future__ import annotations

from paylens.llm import (binslack, ctw, dartminhash, decontam, divergence, gracededup, hilbert, importance, linededup, ordinal,
                         rollups, toxgrammar, warc)
from paylens.llm.common import table


def op1_hilbert_sharding(spark, sf_dir):
    return hilbert.assign(table(spark, sf_dir, "documents"))


def op2_token_rollups(spark, sf_dir):
    return rollups.corpus_rollup(table(spark, sf_dir, "documents"))


def op3_ordinal_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return ordinal.quality(docs, ordinal.fit(docs, ordinal.graded(table(spark, sf_dir, "labels")), grades=3))


def op4_warc_source(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_benchmark_decontamination(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_dart_minhash(spark, sf_dir):
    return dartminhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op7_context_tree_weighting(spark, sf_dir):
    return ctw.log_scores(table(spark, sf_dir, "documents"))


def op8_toxicity_grammar(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxgrammar.scores(docs, toxgrammar.fit(docs, table(spark, sf_dir, "labels")))


def op9_grace_dedup(spark, sf_dir):
    return gracededup.exact_groups(table(spark, sf_dir, "documents"))


def op10_bin_slack_packing(spark, sf_dir):
    return binslack.pack(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark, sf_dir):
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_hilbert_sharding, op2_token_rollups, op3_ordinal_quality, op4_warc_source, op5_benchmark_decontamination,
    op6_dart_minhash, op7_context_tree_weighting, op8_toxicity_grammar, op9_grace_dedup, op10_bin_slack_packing,
    op11_importance_resampling, op12_source_divergence, op13_line_dedup)}
ORACLES = {"op5_benchmark_decontamination": decontam.ORACLE, "op9_grace_dedup": gracededup.ORACLE,
           "op11_importance_resampling": importance.ORACLE, "op12_source_divergence": divergence.ORACLE,
           "op13_line_dedup": linededup.ORACLE}
