"""Toxicity scores from a weighted finite-state pattern grammar.

Five small transducers read the words of a clause (clauses end at
``. ! ? ; :`` and line ends):

* insult: a trie of learned word and word-beginning arcs, each with its
  log-odds weight;
* threat: verbs of a fixed list;
* target: a pronoun of address holds for the next four words, and for the
  four before it (a second transducer, run from the right: "kill you");
* negation: a negator holds for the next three words;
* reported speech: a verb of saying or a quotation mark holds to the end of
  the clause.

Those that read from the left compose to one deterministic transducer over
word classes; the right context is set beside it. On an insult or threat they emit a symbol (kind, negated, targeted, reported) with
the arc's weight, so "not stupid", "you are stupid" and 'said "stupid"' are
different matches. A document's features are the log of 1 plus the summed
weights per symbol; a logistic model on these 16 numbers gives the score.

The trie and the model are learned from at most ``max_rows`` labelled rows
of each class outside the held-out fold (smallest hashes of the id), the
only bound here; every whole text is scored. In the model a sampled row
weighs its class's training labels over its sampled ones, so the prior is
the labels' own at every size. Arcs are tested and weighed by the rates
within each class, which the sample sizes do not shift.

Edge cases: null, empty and wordless texts have no match and get the
model's base score; rows with a null label or without a document are not
learned from, a repeated id counts once; without toxic rows the trie is
empty and all scores are the base score; repeated rows are scored alike; an
empty table gives no rows; extra columns are ignored by ``scores`` and kept
by ``drop_toxic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import held_out, materialise, one_text, tidy
from paylens.llm.words import U, _LOWER, _powers, counted, mix, slices, words

# Fixed word lists (English, German, French, Spanish).
TARGETS = ("you your yours yourself he him she her they them du dich dir dein deine ihr euch er sie "
           "tu toi te ton ta vous votre il elle ils tú ti tu usted ustedes él ella ellos").split()
NEGATORS = "not no never none nor isn aren don doesn nicht kein keine nie ne pas jamais non nunca tampoco".split()
REPORTERS = ("said says say told called calls wrote writes quoted sagte sagt nannte schrieb dit disait écrit appelle "
             "dijo dice llamó escribió").split()
THREATS = "kill hurt destroy beat shoot stab töten umbringen verletzen tuer frapper détruire matar golpear destruir".split()
TARGET_SCOPE, NEGATION_SCOPE = 4, 3

PREFIXES = (4, 5, 6, 7)          # bytes of a word's beginning that an arc may spell
OTHER, TARGET, NEGATOR, REPORTER, THREAT, INSULT, CLAUSE = range(7)
SYMBOLS = 16                     # threat, negated, targeted, reported
MAX_ROWS, MAX_WEIGHT = 10_000, 6.0
MIN_RATIO = 5.0                  # share of toxic rows with an arc over that of clean ones; weak arcs weigh little
MIN_EVIDENCE = 10.0              # log likelihood ratio of an arc; chance passes it about 4 times in a million arcs
THRESHOLD, FOLDS = 0.3, 4


def countdown(trigger: int, scope: int) -> dict:
    """A transducer whose flag holds for ``scope`` words after its trigger."""
    return {(s, c): scope if c == trigger else 0 if c == CLAUSE else max(0, s - 1)
            for s in range(scope + 1) for c in range(7)}


def latch(trigger: int) -> dict:
    """A transducer whose flag holds from its trigger to the end of the clause."""
    return {(s, c): 1 if c == trigger else 0 if c == CLAUSE else s for s in (0, 1) for c in range(7)}


def compose(machines: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The product machine: next state and emitted symbol (-1: none) per (state, class)."""
    states, todo, step, emit = {(0,) * len(machines): 0}, [(0,) * len(machines)], [], []
    while todo:
        s = todo.pop(0)
        row, out = [], []
        for c in range(7):
            n = tuple(m[(q, c)] for m, q in zip(machines, s))
            if n not in states:
                states[n] = len(states)
                todo.append(n)
            row.append(states[n])
            flags = sum((q > 0) << k for k, q in enumerate(s))
            out.append(flags + 8 * (c == THREAT) if c in (THREAT, INSULT) else -1)
        step.append(row)
        emit.append(out)
    return np.array(step), np.array(emit)


TARGETED = 2                     # the target's flag in an emitted symbol
STEP, EMIT = compose([countdown(NEGATOR, NEGATION_SCOPE), countdown(TARGET, TARGET_SCOPE), latch(REPORTER)])


@dataclass
class Grammar:
    arcs: np.ndarray       # sorted hashes of insult words and word beginnings
    weights: np.ndarray
    model: np.ndarray      # bias, then one weight per symbol


def _hashes(raw, off):
    """Words with the hashes of their whole and of their beginnings (0: none)."""
    start, end, doc, h = words(raw, off)
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum((_LOWER[raw].astype(U) + U(1)) * up[:len(raw)], out=sums[1:])
    heads = []
    for n in PREFIXES:
        long = end - start > n
        at = np.where(long, start + n, start)
        heads.append(np.where(long, mix((sums[at] - sums[start]) * down[start] + U(n * 0xA24BAED4963EE407 % 2 ** 64)), U(0)))
    return start, end, doc, h, heads


def word_hashes(listed: list[str]) -> np.ndarray:
    out = []
    for w in listed:
        b = np.frombuffer(w.encode(), np.uint8)
        out.append(words(b, np.array([0, len(b)]))[3][0])
    return np.unique(np.array(out, U))


def _within(h: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(h), bool)
    return listed[np.minimum(np.searchsorted(listed, h), len(listed) - 1)] == h


_CLASSES: list = []


def _word_classes() -> list[tuple[int, np.ndarray]]:
    if not _CLASSES:
        _CLASSES.extend((c, word_hashes(w)) for c, w in
                        ((TARGET, TARGETS), (NEGATOR, NEGATORS), (REPORTER, REPORTERS), (THREAT, THREATS)))
    return _CLASSES


_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?;:\n\r")] = True


def _target_ahead(kind: np.ndarray, clause: np.ndarray) -> np.ndarray:
    """Words that a target follows in their clause within its scope (the countdown, run from the right)."""
    out = np.zeros(len(kind), bool)
    for gap in range(1, TARGET_SCOPE + 1):
        if len(kind) > gap:
            out[:-gap] |= (kind[gap:] == TARGET) & (clause[gap:] == clause[:-gap])
    return out


def matches(texts, grammar: Grammar):
    """Per matched word: document, symbol, weight, start and end byte."""
    out = []
    for i, j, raw, off in slices(texts):
        if not len(raw):
            continue
        start, end, doc, h, heads = _hashes(raw, off)
        kind, weight = np.zeros(len(h), np.int64), np.zeros(len(h))
        for c, listed in _word_classes():
            kind[_within(h, listed)] = c
        weight[kind == THREAT] = 1.0
        if len(grammar.arcs):
            for x in (h, *heads):
                hit = _within(x, grammar.arcs)
                kind[hit] = INSULT
                weight[hit] = np.maximum(weight[hit], grammar.weights[np.searchsorted(grammar.arcs, x[hit])])
        found = np.flatnonzero((kind == INSULT) | (kind == THREAT))
        if not len(found):
            continue
        ends = np.concatenate([[0], np.cumsum(_ENDS[raw])])
        clause = ends[start] + doc * (int(ends[-1]) + 1)  # a clause never runs over two documents
        inner = start > off[doc]          # the byte before a text's first word is another text's
        quoted = np.zeros(len(h), bool)
        quoted[inner] = raw[start[inner] - 1] == 0x22
        ahead = _target_ahead(kind, clause)
        first = np.searchsorted(clause, clause[found])
        done = -1
        for k, a in zip(found.tolist(), first.tolist()):
            if a != done:               # a new clause: start over
                state, pos, done = 0, a, a
            while pos <= k:
                if quoted[pos]:
                    state = STEP[state, REPORTER]
                if pos == k:
                    symbol = int(EMIT[state, kind[k]]) | (TARGETED if ahead[k] else 0)
                    out.append((i + int(doc[k]), symbol, float(weight[k]),
                                int(start[k] - off[doc[k]]), int(end[k] - off[doc[k]])))
                state = STEP[state, kind[pos]]
                pos += 1
    return out


def features(texts, grammar: Grammar) -> np.ndarray:
    x = np.zeros((len(texts), SYMBOLS))
    for doc, symbol, weight, _, _ in matches(texts, grammar):
        x[doc, symbol] += weight
    return np.log1p(x)


def probability(x: np.ndarray, model: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model[0] + x @ model[1:], -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[DataFrame, dict[int, float]]:
    """At most ``max_rows`` labelled training documents of each class, and per
    class the training labels that one sampled label stands for."""
    known = labels.filter(F.col("toxic").isin(0, 1)).filter(~held_out(FOLDS)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    known = materialise(known, "tox-known")
    each = {r["toxic"]: r["n"] / min(r["n"], max_rows) for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = [known.filter(F.col("toxic") == t).orderBy(*order).limit(max_rows) for t in (0, 1)]
    picked = materialise(picked[0].unionByName(picked[1]).coalesce(1), "tox-picked")
    return materialise(one_text(docs, picked, "toxic"), "tox-sample"), each


def _arc_counts(batches):
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for i, j, raw, off in slices(batch.column("text")):
            if not len(raw):
                continue
            _, _, doc, h, heads = _hashes(raw, off)
            d = np.concatenate([doc] * (1 + len(heads)))
            x = np.concatenate([h, *heads])
            d, x, _ = counted(d[x > 0], x[x > 0])
            bad = toxic[i:j][d] == 1
            arcs, inverse = np.unique(x, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(arcs.view(np.int64)),
                pa.array(np.bincount(inverse, weights=bad, minlength=len(arcs)).astype(np.int64)),
                pa.array(np.bincount(inverse, weights=~bad, minlength=len(arcs)).astype(np.int64))], ["arc", "bad", "good"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Grammar:
    """Learn arcs and model from at most ``2 max_rows`` labelled documents. Every arc that
    passes is taken: each needs its evidence in those rows, which bounds their number."""
    sample, each = _sample(docs, labels, max_rows)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        base = -4.0 if not bad else 4.0
        return Grammar(np.zeros(0, U), np.zeros(0), np.concatenate([[base], np.zeros(SYMBOLS)]))
    odds = F.expr(f"((bad + 0.5D) / {bad + 1}) / ((good + 0.5D) / {good + 1})")
    share = bad / (bad + good)
    evidence = F.expr(f"bad * ln(greatest(bad, 0.5D) / ((bad + good) * {share}D)) + "
                      f"good * ln(greatest(good, 0.5D) / ((bad + good) * {1 - share}D))")
    arcs = (sample.mapInArrow(tidy(_arc_counts), "arc long, bad long, good long").groupBy("arc")
            .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .withColumn("odds", odds).filter(evidence >= MIN_EVIDENCE)
            .filter(F.col("bad") * good >= MIN_RATIO * bad * F.col("good"))
            .select("arc", F.log("odds").alias("w")).collect())
    h = np.array([r["arc"] for r in arcs], np.int64).view(U)
    order = np.argsort(h)
    grammar = Grammar(h[order], np.minimum(np.array([r["w"] for r in arcs]), MAX_WEIGHT)[order], np.zeros(SYMBOLS + 1))

    def rows(batches):
        for batch in batches:
            x = features(batch.column("text"), grammar)
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(list(x))], ["y", "x"])
    made = sample.mapInArrow(rows, "y int, x array<double>").groupBy("y", "x").agg(F.count("*").alias("n")).collect()
    x = np.array([r["x"] for r in made])
    y, n = np.array([r["y"] for r in made], float), np.array([r["n"] * each[r["y"]] for r in made], float)
    grammar.model = _logistic(x, y, n)
    return grammar


def _logistic(x, y, n, ridge: float = 0.05, turns: int = 50) -> np.ndarray:
    """Newton's method for ridge logistic regression with row counts ``n``."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, keep = np.zeros(x.shape[1]), np.concatenate([[1e-6], np.full(x.shape[1] - 1, ridge)]) * np.sqrt(n.sum())
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (p - y)) + keep * w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(keep), g)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _scorer(grammar: Grammar):
    def run(batches):
        for batch in batches:
            x = features(batch.column("text"), grammar)
            own = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*own, pa.array(probability(x, grammar.model)),
                                              pa.array((x > 0).sum(axis=1).astype(np.int64))],
                                             [*[c for c in batch.schema.names if c != "text"], "score", "patterns"])
    return run


def scores(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, patterns (kinds of matches)."""
    narrow = docs.select("doc_id", F.coalesce(held_out(FOLDS), F.lit(False)).alias("held_out"),
                         F.col("text").cast("string").alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], narrow.schema["held_out"], T.StructField("score", T.DoubleType()),
                           T.StructField("patterns", T.LongType())])
    return narrow.mapInArrow(tidy(_scorer(grammar)), schema).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "patterns")


def spans(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Matched words: doc_id, symbol flags, weight and byte span in the text."""
    def run(batches):
        for batch in batches:
            found = matches(batch.column("text"), grammar)
            cols = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), *[pa.array([s >> k & 1 == 1 for s in cols[1]],
                 pa.bool_()) for k in range(4)], pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.int64())],
                ["doc_id", "negated", "targeted", "reported", "threat", "weight", "start", "end"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, negated boolean, targeted boolean, reported boolean, threat boolean, weight double, "
             "start long, end long")


def drop_toxic(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all their columns."""
    def run(batches):
        for batch in batches:
            p = probability(features(batch.column("text").cast(pa.string()), grammar), grammar.model)
            yield batch.filter(pa.array(p < threshold))
    return docs.mapInArrow(tidy(run), docs.schema)
