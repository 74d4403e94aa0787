"""Benchmark decontamination as a prefix-filtered set join (built-in functions only).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. An
item's windows are its runs of ten words (an item of fewer words, but not
none, is one window). A window is the set of its positioned three-word
shingles (shorter windows have one shingle of all their words); a document
contains a window when all of them stand at their places.

1. One pass over the documents keeps the positions whose shingle occurs in
   the benchmark at all (64-bit hash join against the distinct benchmark
   shingles, then compared word by word). The planner broadcasts that
   list only below its size threshold and shuffles otherwise.
2. Shingles are ordered by their count in the documents. For full
   containment the necessary prefix of a window is its single rarest
   shingle, so only that one is joined; a window with a shingle that
   occurs nowhere is dropped.
3. Position bound: the prefix shingle fixes where the window starts.
   Length bound: the window must end inside the document.
4. Exact verification: every shingle of the window at its place.

Hit words are counted as the union of intervals per document, so copies of
a passage cost their occurrences, never pairs.

Edge cases: null or wordless texts have no words and no hits; null item ids
are not listed; repeated items and documents are rows of their own (a
repeated item id counts once); empty tables give no hits or no rows; extra
columns are ignored by ``contamination`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import free_name, materialise, release_shuffles

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 3


def words_of(text: str | Column) -> Column:
    body = F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))
    lowered = F.translate(body, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _windows(items: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(window, item_id) and the windows' shingles (window, len, n, off, k, w1, w2, w3)."""
    own = (items.select(F.col("item_id"), words_of("text").alias("w")).filter(F.size("w") > 0)
           .select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("at"))
           .select("item_id", F.slice("w", F.col("at") + 1, F.lit(window)).alias("w")))
    own = materialise(own.distinct(), "decon-windows")
    ids = materialise(own.select("w").distinct().withColumn("window", F.monotonically_increasing_id()), "decon-ids")
    size = F.size("w")
    k = F.least(size, F.lit(shingle))
    parts = (ids.select("window", "w", size.alias("len"), k.alias("k"), (size - k + 1).alias("n"))
             .withColumn("off", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .select("window", "len", "n", "off", "k",
                     *[F.when(F.col("k") >= j, F.try_element_at("w", F.col("off") + j)).alias(f"w{j}")
                       for j in range(1, shingle + 1)]))
    members = own.join(ids, "w").select("window", "item_id")
    return materialise(members, "decon-members"), materialise(parts, "decon-shingles")


def _key(k: int, shingle: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.col(f"w{j}") for j in range(1, k + 1)])


def _positions(docs: DataFrame, shingles: DataFrame, window: int, shingle: int) -> DataFrame:
    """Per document a head row (pos 0 or null) and the positions whose shingle is
    in the benchmark: rid, doc_id, n_words, head, pos, k, w1..., sid."""
    sizes = sorted(r[0] for r in shingles.select("k").distinct().collect())  # at most ``shingle`` values
    names = [f"w{j}" for j in range(1, shingle + 1)]
    keyed = [F.when(F.col("k") == k, _key(k, shingle)) for k in sizes]
    listed = (shingles.select("k", *names).distinct()
              .withColumn("sid", F.monotonically_increasing_id())
              .withColumn("key", F.coalesce(*keyed, F.lit(None).cast("long"))))
    listed = materialise(listed, "decon-listed")
    probe = materialise(listed.select("key").distinct(), "decon-probe")
    tokens = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", words_of("text").alias("w"))
    zipped = F.arrays_zip(*[(F.col("w") if j == 0 else F.slice("w", j + 1, F.greatest(F.size("w"), F.lit(1)))).alias(f"w{j + 1}")
                            for j in range(shingle)])
    rows = tokens.select("rid", "doc_id", F.size("w").alias("n_words"), F.posexplode_outer(zipped).alias("pos", "z"))
    rows = rows.select("rid", "doc_id", "n_words", "pos", *[F.col("z").getField(n).alias(n) for n in names])
    if len(sizes) == 1:
        rows = rows.withColumn("k", F.lit(sizes[0])).withColumn("key", _key(sizes[0], shingle))
    else:
        each = [F.struct(F.lit(k).alias("k"), _key(k, shingle).alias("key")) for k in sizes]
        each = each or [F.struct(F.lit(0).alias("k"), F.lit(None).cast("long").alias("key"))]
        rows = rows.withColumn("e", F.explode(F.array(*each))).select("*", "e.k", "e.key").drop("e")
    head = (F.coalesce(F.col("pos"), F.lit(0)) == 0) & (F.col("k") == (sizes[0] if sizes else 0))
    found = (rows.withColumn("head", head).join(probe.withColumn("there", F.lit(True)), "key", "left")
             .filter(F.col("head") | F.col("there")))
    found = materialise(found.select("rid", "doc_id", "n_words", "head", "pos", "k",
                                     *[F.when(F.col("k") >= j, F.col(f"w{j}")).alias(f"w{j}")
                                       for j in range(1, shingle + 1)], "key", "there"), "decon-found")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}")) for c in ("k", *names)]
    cond = F.col("f.key") == F.col("l.key")
    for s in same:
        cond = cond & s
    exact = found.filter("there").alias("f").join(listed.alias("l"), cond).select("f.rid", "f.n_words", "f.pos", "l.sid")
    heads = found.filter("head").select("rid", "doc_id", "n_words")
    return heads, materialise(exact, "decon-positions"), listed


def _occurrences(docs: DataFrame, items: DataFrame, window: int, shingle: int):
    """Heads (rid, doc_id, n_words), occurrences (rid, window, start, len), members (window, item_id)."""
    members, parts = _windows(items, window, shingle)
    heads, found, listed = _positions(docs, parts, window, shingle)
    names = ["k", *[f"w{j}" for j in range(1, shingle + 1)]]
    cond = None
    for n in names:
        eq = F.col(f"p.{n}").eqNullSafe(F.col(f"l.{n}"))
        cond = eq if cond is None else cond & eq
    spots = parts.alias("p").join(listed.alias("l"), cond).select("p.window", "p.len", "p.n", "p.off", "l.sid")
    counts = found.groupBy("sid").agg(F.count("*").alias("seen"))
    spots = materialise(spots.join(counts, "sid", "left"), "decon-spots")
    prefix = (spots.groupBy("window", "len", "n")
              .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), F.col("off"), F.col("sid"))).alias("p"))
              .filter("p.seen > 0").select("window", "len", "n", F.col("p.off").alias("off"), F.col("p.sid").alias("sid")))
    prefix = materialise(prefix, "decon-prefix")
    candidates = (found.join(prefix, "sid").withColumn("start", F.col("pos") - F.col("off"))
                  .filter("start >= 0 AND start + len <= n_words").select("rid", "window", "len", "n", "start"))
    wanted = (candidates.join(spots.select("window", "off", "sid"), "window")
              .select("rid", "window", "len", "n", "start", (F.col("start") + F.col("off")).alias("pos"), "sid"))
    hits = (wanted.join(found.select("rid", "pos", "sid"), ["rid", "pos", "sid"])
            .groupBy("rid", "window", "len", "n", "start").agg(F.count("*").alias("ok")).filter("ok = n"))
    return heads, materialise(hits.select("rid", "window", "start", "len"), "decon-hits"), members


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    heads, hits, members = _occurrences(docs, items, window, shingle)
    span = hits.select("rid", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    before = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.col("start"))
    covered = (span.select("rid", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reach)).alias("new"))
               .groupBy("rid").agg(F.sum("new").alias("n_hit")))
    listed = (hits.select("rid", "window").distinct().join(members, "window").groupBy("rid")
              .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return heads.join(covered, "rid", "left").join(listed, "rid", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns."""
    key = free_name(docs.columns, "text_key")
    release_shuffles(docs.sparkSession)      # an earlier operator's files are not read again
    # 32 bytes a contaminated text: as long as the planner can broadcast them, no text is shuffled
    keyed = docs.withColumn(key, F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)))
    heads, hits, _ = _occurrences(keyed.select(F.col(key).alias("doc_id"), "text"), items, window, shingle)
    dirty = heads.join(hits.select("rid").distinct(), "rid", "left_semi").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(materialise(dirty, "decon-dirty"), key, "left_anti").select(docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wi AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, p + 1, p + 10), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0)),
runs AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s + 1, s + n), ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS s
        FROM d, (SELECT DISTINCT n FROM wi) WHERE len(w) >= n)),
hit AS (SELECT rid, s, wi.n AS n, item_id FROM runs JOIN wi ON runs.win = wi.win AND runs.n = wi.n),
cover AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
own AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN own USING (rid)
"""
