"""Source divergence audit: how the word use of sources differs, by language.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased. A
language keeps the terms that occur in at least ``min_docs`` of its
documents (V of them). A group, (lang, source) or a whole lang, gives each
kept term, with ``count`` occurrences in it and N kept occurrences in all,

    p = 1 + floor(scale * (count + 2) / (N + 2 V))      scale = 10^9

and two groups diverge by f = floor((p - q)^2 / (p + q)) per term: a
triangular discrimination in whole numbers, so every figure is exact.

Jobs. Tasks count by Arrow kernels: ascii_lower, split_pattern_regex,
dictionary_encode, then hash group_by over (document, term) and over
(lang, source, term); only these partial counts are shuffled. The merged
counts become one row per kept (lang, term) with its sources' counts. Those
rows are dealt over tasks as shards; a shard's counts are a matrix of terms
by sources, from which numpy sums f for all pairs of sources of the lang
(each pair once) and keeps the ``top`` terms of each group. Sums and tops of
the shards are merged and ranked.

The driver holds one row per (lang, source) with its N and V: the result's
own pairs are the square of that.

Edge cases: null text, lang and source count as ''; repeated rows are
documents of their own; groups without terms take part in pairs; a language
without kept terms has pairs of value 0 and no terms; a language with one
source has no pairs; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.arrowwords import NOT_LETTER, encoded_words, text_slices
from paylens.llm.common import materialise

MIN_DOCS, TOP, SCALE_STEPS = 10, 10, 3      # the scale is 1000 ** SCALE_STEPS
CELLS = 1 << 20                             # counts of a shard's matrix held at once


def _partial_counts(batches):
    """lang, source, term, n, docs of a task's texts."""
    for batch in batches:
        for part in text_slices(batch):
            of, index, terms = encoded_words(part.column("text"), NOT_LETTER)
            if not len(of):
                continue
            seen = pa.table({"doc": of, "term": index}).group_by(["doc", "term"]).aggregate([([], "count_all")])
            group = {c: part.column(c).dictionary_encode() for c in ("lang", "source")}
            at = {c: pc.take(g.indices, seen.column("doc")) for c, g in group.items()}
            by = pa.table({"lang": at["lang"], "source": at["source"], "term": seen.column("term"), "n": seen.column("count_all")})
            made = by.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ([], "count_all")])
            yield pa.RecordBatch.from_arrays(
                [*(pc.take(group[c].dictionary, made.column(c)).combine_chunks() for c in ("lang", "source")),
                 pc.take(terms, made.column("term")).combine_chunks().cast(pa.string()),
                 made.column("n_sum").combine_chunks().cast(pa.int64()), made.column("count_all").combine_chunks()],
                ["lang", "source", "term", "n", "docs"])


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total and the array ``by`` of (source, n): terms in at least ``min_docs`` documents of the lang."""
    partial = _named(docs).mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    cells = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                              F.collect_list(F.struct("source", "n")).alias("by"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", "total", "by"))


def shares(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (n + 2 v)), digit group by digit group so that no product leaves 64 bits."""
    rest, whole, out = count + 2, n + 2 * v, 0
    for k in range(SCALE_STEPS):
        digit, rest = np.divmod(rest if k == 0 else rest * 1000, whole)
        out = out * 1000 + digit
    last, _ = np.divmod(rest * 1000, whole)
    return 1 + out * 1000 + last


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _shards(groups: dict, top: int):
    """Pair sums (kind 0: a, b are sources) and each group's best terms (kind 1) of a task's terms."""
    def run(batches):
        sums = {lang: np.zeros((len(g["sources"]), len(g["sources"])), np.int64) for lang, g in groups.items()}
        best = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            spans = {}
            for i, lang in enumerate(langs):
                spans.setdefault(lang, []).append(i)
            for lang, own in spans.items():
                g = groups[lang]
                width = len(g["sources"])
                step = max(1, CELLS // width)
                for a in range(0, len(own), step):
                    rows = batch.take(pa.array(own[a: a + step]))
                    by = rows.column("by")
                    cell, of = by.flatten(), pc.list_parent_indices(by).to_numpy()
                    where = np.array([g["place"][s] for s in cell.field("source").to_pylist()])
                    count = np.zeros((rows.num_rows, width), np.int64)
                    count[of, where] = cell.field("n").to_numpy()
                    p = shares(count, g["n"], g["v"])
                    for i in range(width - 1):
                        sums[lang][i, i + 1:] += divergence(p[:, i: i + 1], p[:, i + 1:]).sum(axis=0)
                    q = shares(rows.column("total").to_numpy(), g["n"].sum(), g["v"])[:, None]
                    f = np.where((count > 0) & (p > q), divergence(p, q), -1)
                    terms = rows.column("term").to_pylist()
                    for i in range(width):
                        column = f[:, i]
                        able = np.flatnonzero(column >= 0)
                        if len(able) > top:       # ties at the last place stay for the exact order below
                            able = able[column[able] >= np.partition(column[able], -top)[-top]]
                        held = best.get((lang, i), []) + [(-int(column[k]), terms[k].encode(), terms[k]) for k in able]
                        best[lang, i] = sorted(held)[:top]
        for lang, g in groups.items():
            a, b = np.nonzero(np.triu(sums[lang], 1))
            names = np.array(g["sources"], object)
            yield _rows(0, lang, names[a], names[b], sums[lang][a, b])
        for (lang, i), held in best.items():
            yield _rows(1, lang, [groups[lang]["sources"][i]] * len(held), [t for _, _, t in held], [-v for v, _, _ in held])
    return run


def _rows(kind: int, lang: str, a, b, value) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.int32()), pa.array([lang] * len(a), pa.string()),
                                       pa.array(list(a), pa.string()), pa.array(list(b), pa.string()),
                                       pa.array(list(map(int, value)), pa.int64())], ["kind", "lang", "source", "item", "value"])


def _groups(named: DataFrame, kept: DataFrame) -> dict:
    """Per lang: V, and its sources in order with their N. One row per (lang, source) comes to the driver."""
    held = kept.select("lang", F.explode("by").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(
        F.sum("c.n").alias("n"))
    rows = named.select("lang", "source").distinct().join(held, ["lang", "source"], "left").collect()
    size = {r["lang"]: r["v"] for r in kept.groupBy("lang").agg(F.count("*").alias("v")).collect()}
    out = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["source"])):
        g = out.setdefault(r["lang"], {"v": size.get(r["lang"], 0), "sources": [], "n": [], "place": {}})
        g["place"][r["source"]] = len(g["sources"])
        g["sources"].append(r["source"])
        g["n"].append(r["n"] or 0)
    for g in out.values():
        g["n"] = np.array(g["n"], np.int64)
    return out


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    spark, named = docs.sparkSession, _named(docs)
    kept = materialise(kept_terms(docs, min_docs), "divergence-terms")
    groups = _groups(named, kept)
    parts = materialise(kept.mapInArrow(_shards(groups, top), "kind int, lang string, source string, item string, value long"),
                        "divergence-parts")
    found = parts.filter("kind = 0").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    found = found.unionByName(found.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    names = spark.createDataFrame([(lang, s) for lang, g in groups.items() for s in g["sources"]], "lang string, source string")
    pairs = (names.join(names.withColumnRenamed("source", "item"), "lang").filter("source <> item")
             .join(found, ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")))
    terms = parts.filter("kind = 1").select("lang", "source", F.lit("term").alias("part"), "item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = lambda rows: rows.withColumn("rank", place.cast("int"))
    return ranked(pairs).unionByName(ranked(terms).filter(F.col("rank") <= top))


ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, rid, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
cell AS (SELECT lang, source, term, count(*) AS c FROM t GROUP BY lang, source, term),
size AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
own AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN (cell JOIN kept USING (lang, term)) USING (lang, source)
        GROUP BY g.lang, g.source),
p AS (
  SELECT own.lang, own.source, term, coalesce(c, 0) AS c,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 2) // (own.n + 2 * v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (total + 2) // (size.n + 2 * v) AS q
  FROM own JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN cell USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 10
"""
