"""Text quality by ordinal cumulative-link regression on graded ratings.

A rating is a grade 0 < 1 < ... < G. One weight vector over hashed text
features is shared by all grades, s = w.x, and ordered thresholds cut the
latent scale: P(grade <= k) = sigmoid(theta_k - s). The tail probabilities
P(grade >= k) and their sum, the expected grade, serve selection.

Features (2^``bits`` hashed buckets, log counts, unit length per text):
visible words, their last three bytes (punctuation and case junk shows
there), their first five bytes, and words that repeat the one before.

Fitting uses at most ``max_rows`` labelled rows per grade outside the
held-out fold (smallest hashes of the id), the only bound here. Their
features stay in a table; a step of the optimiser (L-BFGS) is one job whose
tasks return the loss and gradient of their rows, one vector each, so what
the driver gets does not depend on the texts' lengths. Every whole text is
scored.

Edge cases: null and empty texts have no features and get the thresholds'
own probabilities; rows with a null grade or without a document are not
learned from, a repeated id counts once; grades without rows leave their
threshold at its start; with fewer than two grades the model is flat;
repeated rows are scored alike; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import held_out, materialise, one_text
from paylens.llm.words import U, VISIBLE, _LOWER, _powers, counted, mix, slices, words

BITS, MAX_ROWS, FOLDS, RIDGE, TURNS, KEEP = 15, 3000, 5, 1e-5, 60, 0.5
MEMORY, FIT_TASKS = 10, 8        # steps that L-BFGS looks back on; tasks that sum the gradient


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray      # ascending, one per grade above 0

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. (columns)."""
        return 1 / (1 + np.exp(-np.clip(s[:, None] - self.thresholds[None, :], -35, 35)))


def features(raw: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of the texts of a slice."""
    n = len(off) - 1
    start, end, doc, h = words(raw, off, VISIBLE)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum((_LOWER[raw].astype(U) + U(1)) * up[:len(raw)], out=sums[1:])
    tail, head = np.maximum(end - 3, start), np.minimum(start + 5, end)
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1]))
    x = np.concatenate([h, mix((sums[end] - sums[tail]) * down[tail] ^ U(0x51)),
                        mix((sums[head] - sums[start]) * down[start] ^ U(0x52)), np.full(len(again), 0x53, U)])
    d, bucket, count = counted(np.concatenate([doc, doc, doc, doc[again]]), mix(x) >> U(64 - bits))
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(d, weights=value * value, minlength=n))
    return d, bucket.astype(np.int64), value / norm[d]


def thresholds(p: np.ndarray, size: int) -> np.ndarray:
    """Ordered thresholds: the first, then each the one before plus the exponential of a step."""
    return p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1:]))])


def loss_and_gradient(p: np.ndarray, doc, bucket, value, grade: np.ndarray, weight: np.ndarray, bits: int) -> tuple[float, np.ndarray]:
    """Negative log likelihood of rows (by grade, ``weight`` each) and its gradient in ``p``:
    2^``bits`` weights, first threshold, log steps."""
    n, size, grades = len(grade), 1 << bits, len(weight)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    theta, each = np.concatenate([[-np.inf], thresholds(p, size), [np.inf]]), weight[grade]
    s = np.bincount(doc, weights=p[bucket] * value, minlength=n)
    up, lo = sig(theta[grade + 1] - s), sig(theta[grade] - s)
    inside = np.maximum(up - lo, 1e-12)
    d_up, d_lo = up * (1 - up) / inside * each, lo * (1 - lo) / inside * each
    g = np.zeros(len(p))
    g[:size] = np.bincount(bucket, weights=(d_up - d_lo)[doc] * value, minlength=size)
    by = np.bincount(grade + 1, weights=-d_up, minlength=grades + 1)[1:grades] \
        + np.bincount(grade, weights=d_lo, minlength=grades + 1)[1:grades]
    later = np.cumsum(by[::-1])[::-1]                     # a step moves its threshold and all later ones
    g[size], g[size + 1:] = later[0], later[1:] * np.exp(p[size + 1:])
    return float(-(np.log(inside) * each).sum()), g


def minimise(evaluate, p: np.ndarray, turns: int = TURNS, memory: int = MEMORY) -> np.ndarray:
    """L-BFGS with backtracking; ``evaluate`` gives loss and gradient at a point."""
    f, g = evaluate(p)
    past = []
    for _ in range(turns):
        q, back = g.copy(), []
        for s, y in reversed(past):
            a = (s @ q) / (s @ y)
            q -= a * y
            back.append(a)
        if past:
            s, y = past[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1e-12, np.abs(g).max())
        for (s, y), a in zip(past, reversed(back)):
            q += s * (a - (y @ q) / (s @ y))
        slope, step = -(g @ q), 1.0
        if slope > -1e-12:
            break
        while True:
            new = p - step * q
            fn, gn = evaluate(new)
            if fn <= f + 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        if fn >= f:
            break
        s, y = new - p, gn - g
        if s @ y > 1e-14:
            past = [*past, (s, y)][-memory:]
        done = f - fn < 1e-7 * max(1.0, abs(f))
        p, f, g = new, fn, gn
        if done:
            break
    return p


def fit_rows(doc, bucket, value, grade: np.ndarray, grades: int, bits: int = BITS, ridge: float = RIDGE) -> Ordinal:
    """The same fit of rows in memory."""
    each, size = np.bincount(grade, minlength=grades), 1 << bits
    weight = 1 / np.maximum(each, 1) / max(1, (each > 0).sum())
    start = np.zeros(size + grades - 1)
    start[size] = -(grades - 2) / 2

    def evaluate(p):
        f, g = loss_and_gradient(p, doc, bucket, value, grade, weight, bits)
        g[:size] += ridge * p[:size]
        return f + ridge * float(p[:size] @ p[:size]) / 2, g
    p = minimise(evaluate, start)
    return Ordinal(p[:size].copy(), thresholds(p, size))


def fit(docs: DataFrame, ratings: DataFrame, grades: int, max_rows: int = MAX_ROWS, bits: int = BITS, ridge: float = RIDGE) -> Ordinal:
    """``ratings``: doc_id, grade (0 .. grades - 1; others are not learned from). Rows weigh alike per grade."""
    known = ratings.filter(F.col("grade").between(0, grades - 1)).filter(~held_out(FOLDS)).groupBy("doc_id").agg(
        F.min("grade").cast("int").alias("grade"))
    picked = [known.filter(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for g in range(grades)]
    sample = picked[0]
    for p in picked[1:]:
        sample = sample.unionByName(p)
    sample = materialise(sample.coalesce(1), "ordinal-picked")

    def rows(batches):
        for b in batches:
            grade = b.column("grade").to_numpy()
            for i, j, raw, off in slices(b.column("text")):
                d, bucket, value = features(raw, off, bits)
                cuts = pa.array(np.searchsorted(d, np.arange(j - i + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grade[i:j].astype(np.int32)), pa.ListArray.from_arrays(cuts, pa.array(bucket.astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(value.astype(np.float32)))], ["grade", "bucket", "value"])
    made = one_text(docs, sample, "grade").repartition(FIT_TASKS, F.xxhash64("text")).mapInArrow(
        rows, "grade int, bucket array<int>, value array<float>")
    made = materialise(made, "ordinal-features")
    each = np.zeros(grades)
    for r in made.groupBy("grade").agg(F.count("*").alias("n")).collect():  # one row per grade
        each[r["grade"]] = r["n"]
    size = 1 << bits
    start = np.zeros(size + grades - 1)
    start[size] = -(grades - 2) / 2
    if (each > 0).sum() < 2:
        return Ordinal(np.zeros(size), np.arange(grades - 1) - (grades - 2) / 2)
    weight = 1 / np.maximum(each, 1) / (each > 0).sum()

    def evaluate(p):
        def part(batches):
            loss, total = 0.0, np.zeros(len(p))
            for b in batches:
                grade, lists = b.column("grade").to_numpy().astype(np.int64), b.column("bucket")
                doc = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))
                f, g = loss_and_gradient(p, doc, lists.flatten().to_numpy().astype(np.int64),
                                         b.column("value").flatten().to_numpy().astype(float), grade, weight, bits)
                loss, total = loss + f, total + g
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([total.tobytes()], pa.binary())], ["loss", "gradient"])
        parts = made.mapInArrow(part, "loss double, gradient binary").collect()    # one vector per task
        g = sum(np.frombuffer(r["gradient"]) for r in parts)
        g[:size] += ridge * p[:size]
        return sum(r["loss"] for r in parts) + ridge * float(p[:size] @ p[:size]) / 2, g
    p = minimise(evaluate, start)
    return Ordinal(p[:size].copy(), thresholds(p, size))


def quality(docs: DataFrame, model: Ordinal, keep: float = KEEP) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, expected_grade, p_ge_1 .. p_ge_G and
    kept (P(grade >= 1) >= ``keep``)."""
    bits, grades = len(model.weights).bit_length() - 1, len(model.thresholds) + 1
    names = ["expected_grade", *[f"p_ge_{k}" for k in range(1, grades)]]

    def run(batches):
        for b in batches:
            for i, j, raw, off in slices(b.column("text")):
                d, bucket, value = features(raw, off, bits)
                tails = model.tails(np.bincount(d, weights=model.weights[bucket] * value, minlength=j - i))
                own = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("held_out"), pa.array(tails.sum(axis=1)),
                     *[pa.array(np.ascontiguousarray(t)) for t in tails.T]], ["doc_id", "held_out", *names])
    narrow = docs.select("doc_id", held_out(FOLDS).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], narrow.schema["held_out"],
                           *[T.StructField(c, T.DoubleType()) for c in names]])
    return narrow.mapInArrow(run, schema).withColumn("kept", F.col("p_ge_1") >= keep)


def graded(labels: DataFrame) -> DataFrame:
    """Grades from quality and toxicity labels: 0 junk, 1 sound but toxic, 2 sound."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade")).filter("grade IS NOT NULL")
