"""Target-distribution importance resampling over hashed n-gram features.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
Features are all runs of 1 to ``n`` consecutive words joined by one space,
repeats counted; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo
``buckets``. With S features in the raw corpus (s in the bucket) and T in
the target texts (t in it), a bucket's gain is

    floor(1000 * ln(((t+1) * (S+buckets)) / ((s+1) * (T+buckets))))

and a document's weight is the floored mean of its features' gains (none:
0). A Gumbel draw from the document's id is added; of the documents with at
least ``min_words`` words the ``percent`` % with the highest sums are drawn,
which is sampling without replacement in proportion to exp(weight / 1000).

Kernels, inside tasks: ascii_lower, split_pattern_regex, list_flatten and
dictionary_encode give every word a dictionary index; indices shifted by
one, two, ... give n-grams as index tuples; each distinct one of a slice is
hashed once (a CRC goes on from its shorter gram's); take brings the gains
back to the features and a segment reduction sums them by document.

The corpus statistics are one row per bucket (a fixed bound); they are the
only thing the driver holds. Ranks come from a range sort with per-partition
offsets, no global window.

Edge cases: null text has no words; null ids draw with an empty id and sort
last among ties; repeated rows are features twice and are ranked each; no
target texts or no documents leave the formula defined (T or S is 0); an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.arrowwords import NOT_ALNUM, encoded_words, text_slices
from paylens.llm.common import drop_scratch, materialise
from paylens.operators.ranking import global_row_number

N, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, "2024"


def features(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, bucket) of every feature, by gram length and place, and words per text."""
    of, index, words = encoded_words(texts, NOT_ALNUM)
    spelled = [w.encode() for w in words.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in spelled], np.int64)
    doc, bucket = [of], [crc[index] % buckets]
    gram, at, sums = index.astype(np.int64), np.arange(len(index)), crc
    for _ in range(2, n + 1):
        last = at + 1                                        # the word that each gram grows by
        ok = (last < len(of)) & (of[np.minimum(last, len(of) - 1)] == of[at]) if len(of) else np.zeros(0, bool)
        start, last, gram = at[ok], last[ok], gram[ok]
        pair = gram * len(spelled) + index[last]
        distinct, gram = np.unique(pair, return_inverse=True)
        head, tail = np.divmod(distinct, max(len(spelled), 1))
        sums = np.array([zlib.crc32(b" " + spelled[t], int(sums[h])) for h, t in zip(head.tolist(), tail.tolist())], np.int64)
        doc.append(of[start])
        bucket.append(sums[gram] % buckets if len(gram) else np.zeros(0, np.int64))
        at = last
    return np.concatenate(doc), np.concatenate(bucket), np.bincount(of, minlength=len(texts))


def _counter(n: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                total += np.bincount(features(part.column("text"), n, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, n: int = N, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of ``texts`` (column text)."""
    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counter(n, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    k, s, t = len(raw), raw.astype(float), target.astype(float)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + k)) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _weigher(n: int, gain: np.ndarray, arrow: pa.Schema):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                doc, bucket, words = features(part.column("text"), n, len(gain))
                size = np.bincount(doc, minlength=part.num_rows)
                order = np.argsort(doc, kind="stable")
                each = np.concatenate([gain.take(bucket[order]), [0]])
                total = np.add.reduceat(each, np.concatenate([[0], np.cumsum(size)[:-1]])) if part.num_rows else size
                weight = np.floor_divide(np.where(size > 0, total, 0), np.maximum(size, 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(arrow.field("doc_id").type), pa.array(size),
                                                  pa.array(weight), pa.array(words.astype(np.int64))], schema=arrow)
    return run


def weights(docs: DataFrame, gain: np.ndarray, n: int = N) -> DataFrame:
    """doc_id, n_features, weight and n_words of every row of ``docs``."""
    arrow = pa.schema([docs.limit(0).toArrow().schema.field("doc_id"), ("n_features", pa.int64()), ("weight", pa.int64()),
                       ("n_words", pa.int64())])
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_features long, weight long, n_words long")])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_weigher(n, gain, arrow), schema)


def draw_score(seed: str = SEED):
    """weight plus the document's Gumbel draw, in thousandths."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def resample(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank (null: not drawn)."""
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    scored = materialise(weights(docs, gain, n).withColumn("score", draw_score(seed)), "dsir-scores")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    ranked = global_row_number(scored.filter(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(out).unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")).select(out))


def _words(table: str) -> str:
    return (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM " + table)


ORACLE = f"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('documents')}),
i AS (SELECT {_words('benchmark')}),
dw AS (SELECT rid, unnest(w) AS f FROM d),
iw AS (SELECT unnest(w) AS f FROM i),
bucket AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(f)), lambda k:
      ('0x' || substr(hex(encode(f)), CAST(2 * k + 1 AS INTEGER), 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS b
  FROM (SELECT f FROM dw UNION SELECT f FROM iw), crc),
raw AS (SELECT b, count(*) AS s FROM dw JOIN bucket USING (f) GROUP BY b),
goal AS (SELECT b, count(*) AS t FROM iw JOIN bucket USING (f) GROUP BY b),
sums AS (SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM iw) AS t_all),
gain AS (
  SELECT b, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE)
    / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM raw FULL JOIN goal USING (b), sums),
weighed AS (SELECT rid, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM dw JOIN bucket USING (f) JOIN gain USING (b) GROUP BY rid),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, len(w) AS n_words,
    coalesce(CASE WHEN g >= 0 THEN g // n ELSE -((-g + n - 1) // n) END, 0) AS weight,
    (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM d LEFT JOIN weighed USING (rid)),
placed AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM placed WHERE n_words >= 20)
SELECT placed.doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN r <= n * 10 // 100 THEN r END AS rank
FROM placed LEFT JOIN ranked USING (doc_id)
"""
