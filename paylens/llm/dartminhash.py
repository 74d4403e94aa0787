"""Near-duplicate classes by DartMinHash signatures and banded joining.

A document is the weighted set of its five-word shingles (lower-cased
letter/digit words). Similarity is the weighted Jaccard similarity: a
shingle weighs as often as it occurs (``weighting="count"``, the default) or
1 (``"set"``, the plain Jaccard similarity). Two texts of similarity 0.8 or
more are linked, and classes are the connected components of links.

Signatures. Every element owns a half-plane weight x rank, cut into regions
of area one. A hash of (element, region) gives the region's number of darts
(Poisson(1)) and each dart's weight position, rank and coordinate, so all
documents throw the same darts. A document keeps the darts below the
element's weight and, per coordinate, the earliest rank. Only ranks up to
k(ln k + 2)/|x| are thrown; a document with an empty coordinate doubles its
range. Cost is O(|x| + k log k), and two documents agree on a coordinate
with probability equal to their weighted Jaccard similarity.

Joining. ``bands`` bands of four coordinates: a pair of similarity 0.8
meets in at least one of 32 buckets with probability 1 - 5e-8. Buckets are
never expanded into all pairs:

* each bucket has one leader (its smallest text). A text is compared with the
  smallest of its leaders, then, in buckets where the links so far leave
  several classes, with the next smallest leader outside its class, one a
  round for ``ROUNDS`` rounds, so a round verifies at most one pair a text;
  those at the threshold are linked, and components give the classes;
* only buckets that still hold several classes go on. There a text drops out
  if shingles that occur in another class make up less than the threshold
  of it, since no text outside its class can then be similar enough (texts
  that share a passage and little else end here, without any pair);
* what stays of a bucket is dealt into blocks of about ``block`` texts or
  ``block_shingles`` shingles, whichever is less, and each pair of blocks is
  one task's group of shingle hashes (no texts travel): it counts the
  overlaps as a matrix product over their shared shingles and returns at
  most one link per text, so no pairs are emitted however many there are.

So no link between texts that share a bucket is lost for the classes.
Every link is verified on the full shingle sets. Equal word sequences are
collapsed first (128-bit hash), so copies cost nothing here.

Edge cases: null text, empty text and text without words form a class of
their own row each; documents of one to four words have one shingle of all
their words; null ids are ignored when a class takes its smallest id;
repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import drop_scratch, free_name, give_back, materialise, release_shuffles, tidy
from paylens.llm.components import components
from paylens.llm.words import U, counted, flat, mix, shingles, slices, words, _powers

K, ROWS_PER_BAND = 128, 4
THRESHOLD = 0.8
BLOCK = 1024                     # texts per block in the comparison of what one leader leaves open
BLOCK_SHINGLES = 1 << 19         # shingles per block: bounds a group where texts are long
STEP_DARTS = 1 << 18             # darts thrown at once: bounds a worker however many documents a slice holds
ROUNDS = 2                       # further leaders a text meets one after the other; the blocks compare what they leave
COLUMNS = 8192                   # shingles per step of a block's overlap matrix
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(14)])


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0 ** -53


def darts(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int = K) -> np.ndarray:
    """Signatures (n_docs x k): the earliest dart's rank per coordinate; documents
    without elements get infinity. ``doc`` is sorted; weights are positive."""
    sig = np.full(n_docs * k, np.inf)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    reach = np.zeros(n_docs)
    np.divide(k * (math.log(k) + 2), total, out=reach, where=total > 0)
    todo = total > 0
    while todo.any():
        use = np.flatnonzero(todo[doc])
        load = np.cumsum(1 + reach[doc[use]] * np.maximum(weight[use], 1))   # slabs and darts to expect
        cuts = np.searchsorted(load, np.arange(STEP_DARTS, load[-1], STEP_DARTS))
        for own in np.split(use, cuts):
            _throw(sig, doc[own], element[own], weight[own], reach, k)
        todo &= np.isinf(sig.reshape(n_docs, k)).any(axis=1)
        reach[todo] *= 2
    return sig.reshape(n_docs, k)


def _throw(sig: np.ndarray, d: np.ndarray, e: np.ndarray, w: np.ndarray, reach: np.ndarray, k: int) -> None:
    """Lower ``sig`` to the ranks of these elements' darts below their weights and their documents' reach."""
    if len(d):
        level, low, width = 0, 0.0, 1.0
        while len(d):  # weight intervals [0,1), [1,2), [2,4), [4,8) ...; slabs of height 1/width
            slabs = np.ceil(reach[d] * width).astype(np.int64)
            of = np.repeat(np.arange(len(d)), slabs)
            slab = np.arange(len(of)) - np.repeat(np.cumsum(slabs) - slabs, slabs)
            region = mix(mix(e[of] + U(level + 1)) + slab.astype(U))
            n = np.searchsorted(_POISSON, _unit(region), side="right")
            dart_of = np.repeat(np.arange(len(of)), n)
            number = np.arange(len(dart_of)) - np.repeat(np.cumsum(n) - n, n)
            first = mix(region[dart_of] ^ mix(number.astype(U) + U(0x5851F42D4C957F2D)))
            owner = of[dart_of]
            rank = (slab[dart_of] + _unit(mix(first))) / width
            at = low + width * ((first >> U(16)) & U(0xFFFFFF)).astype(np.float64) * 2.0 ** -24
            hit = (at < w[owner]) & (rank < reach[d[owner]])
            key = d[owner[hit]] * k + (first[hit] % U(k)).astype(np.int64)
            np.minimum.at(sig, key, rank[hit])
            low, width, level = (1.0, 1.0, 1) if level == 0 else (2 * low, 2 * width, level + 1)
            more = w > low
            d, e, w = d[more], e[more], w[more]


def band_keys(sig: np.ndarray, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """One 64-bit bucket key per band; the band's number is part of the key."""
    bits = np.ascontiguousarray(sig).view(U)
    keys = np.zeros((len(sig), sig.shape[1] // rows), U)
    keys += np.arange(keys.shape[1], dtype=U) * U(0x9E3779B97F4A7C15)
    for r in range(rows):
        keys = mix(keys ^ bits[:, r::rows])
    return keys


def _sequence_hash(doc, h, n_docs):
    """128 bits of each document's word sequence."""
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    up, down = _powers(max(len(h), 1))
    out = []
    for salt in (0x1F83D9AB, 0x5BE0CD19):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(h ^ U(salt)) * up[:len(h)], dtype=U)])
        out.append(mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(U)))
    return out


def _elements(raw, off, weighting: str):
    """(document, shingle hash, weight) and the words they come from."""
    n = len(off) - 1
    _, _, doc, h = words(raw, off)
    d, x, count = counted(*shingles(doc, h, n))
    return doc, h, d, x, (count.astype(np.float64) if weighting == "count" else np.ones(len(x)))


def _sketcher(k: int, weighting: str, arrow: pa.Schema):
    def run(batches):
        for batch in batches:
            for i, j, raw, off in slices(batch.column("text")):
                doc, h, d, x, w = _elements(raw, off, weighting)
                n = j - i
                sizes = np.bincount(d, weights=w, minlength=n)
                empty = sizes == 0
                keys = band_keys(darts(d, x, w, n, k)).view(np.int64)
                hi, lo = (s.view(np.int64) for s in _sequence_hash(doc, h, n))
                per = keys.shape[1]
                offsets = pa.array(np.arange(n + 1) * per, pa.int32())
                made = {"hi": pa.array(hi, mask=empty), "lo": pa.array(lo, mask=empty), "size": pa.array(sizes),
                        "bands": pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))}
                own = batch.slice(i, n)
                yield pa.RecordBatch.from_arrays(
                    [(made[f.name] if f.name in made else own.column(f.name)).cast(f.type) for f in arrow], schema=arrow)
    return run


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a row number, whose column name is returned."""
    rid = free_name(docs.columns, "rid")
    return materialise(docs.withColumn(rid, F.monotonically_increasing_id()), "dart-rows"), rid


def _sketches(rows: DataFrame, rid: str, k: int, weighting: str) -> tuple[DataFrame, DataFrame]:
    """(rid, id, hi, lo, size, bands) and (rid, text) of numbered rows; only number and text go through Python."""
    texts = rows.select(F.col(f"`{rid}`").alias("rid"), F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    arrow = pa.schema([("rid", pa.int64()), texts.limit(0).toArrow().schema.field("id"), ("hi", pa.int64()), ("lo", pa.int64()),
                       ("size", pa.float64()), ("bands", pa.list_(pa.int64()))])
    schema = T.StructType([T.StructField("rid", T.LongType()), texts.schema["id"], *T.StructType.fromDDL(
        "hi long, lo long, size double, bands array<long>")])
    return materialise(texts.mapInArrow(tidy(_sketcher(k, weighting, arrow)), schema), "dart-sketches"), texts.select("rid", "text")


def _similarity(weighting: str, limit: int = 4 << 20):
    """Verified similarity of each row's two texts on the full shingle sets."""
    def run(batches):
        for batch in batches:
            a, b = flat(batch.column("text_a")), flat(batch.column("text_b"))
            load = (a[1] - a[1][0]) + (b[1] - b[1][0])
            out, i, n = [], 0, batch.num_rows
            while i < n:
                j = max(i + 1, int(np.searchsorted(load, load[i] + limit, side="right")) - 1)
                sides = []
                for raw, off in (a, b):
                    _, _, d, x, w = _elements(raw[off[i]: off[j]], off[i: j + 1] - off[i], weighting)
                    sides.append((d, x, w))
                d, x, w = (np.concatenate(v) for v in zip(*sides))
                order = np.lexsort((x, d))
                d, x, w = d[order], x[order], w[order]
                same = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
                common = np.bincount(d[1:][same], weights=np.minimum(w[1:], w[:-1])[same], minlength=j - i)
                total = np.bincount(d, weights=w, minlength=j - i) - common
                out.append(np.divide(common, total, out=np.zeros(j - i), where=total > 0))
                i = j
            sim = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim)], ["a", "b", "sim"])
    return run


def _element_lists(weighting: str):
    """(rid, root, hs, ws): the weighted shingles of each text, as two lists."""
    def run(batches):
        for batch in batches:
            for i, j, raw, off in slices(batch.column("text")):
                _, _, d, x, w = _elements(raw, off, weighting)
                cuts = pa.array(np.searchsorted(d, np.arange(j - i + 1)), pa.int32())
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [own.column("rid"), own.column("root"), pa.ListArray.from_arrays(cuts, pa.array(x.view(np.int64))),
                     pa.ListArray.from_arrays(cuts, pa.array(w.astype(np.int64)))], ["rid", "root", "hs", "ws"])
    return run


def _block_links(threshold: float):
    """Links between the texts of one block pair (or block) that are in different
    classes: each text that has any, with a text it is connected to."""
    def run(table: pa.Table) -> pa.Table:
        rid, root = (table.column(c).to_numpy() for c in ("rid", "root"))
        n, hashes = len(rid), table.column("hs").combine_chunks()
        x = hashes.flatten().to_numpy().view(U)
        times = table.column("ws").combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(n), np.diff(hashes.offsets.to_numpy()))
        if (times > 1).any():                          # a weight of 3 is three unit elements
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            doc, x = np.repeat(doc, times), mix(np.repeat(x, times) + nth.astype(U))
        _, column, seen = np.unique(x, return_inverse=True, return_counts=True)
        size = np.bincount(doc, minlength=n).astype(np.float32)
        use = seen[column] > 1                         # other columns overlap with nothing
        doc, column = doc[use], np.unique(column[use], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        doc, column = doc[order], column[order]
        overlap, part = np.zeros((n, n), np.float32), None
        width = int(column[-1]) + 1 if len(column) else 0
        for c in range(0, width, COLUMNS):
            lo, hi = np.searchsorted(column, [c, c + COLUMNS])
            part = np.zeros((n, min(COLUMNS, width - c)), np.float32)
            part[doc[lo:hi], column[lo:hi] - c] = 1
            overlap += part @ part.T
        linked = overlap >= np.float32(threshold - 1e-6) * (size[:, None] + size[None, :] - overlap)
        linked &= (overlap > 0) & (root[:, None] != root[None, :])
        label = np.arange(n)
        while True:                                    # smallest index in reach
            new = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
            new = new[new]
            if (new == label).all():
                break
            label = new
        at = np.flatnonzero(label != np.arange(n))
        if n > 256:
            del overlap, linked, part, doc, column, x
            give_back()
        return pa.table({"a": pa.array(rid[at], pa.int64()), "b": pa.array(rid[label[at]], pa.int64())})
    return run


def _mixed(members: DataFrame) -> DataFrame:
    """Members (rid, size, root, key, leader, leader_size) of buckets that hold more than one
    class, with the bucket's texts and shingles and its leader's class (null: the leader is gone)."""
    mixed = members.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.max(F.when(F.col("rid") == F.col("leader"), F.col("root"))).alias("leader_root")).filter("lo <> hi")
    return members.join(mixed.select("key", "n", "shingles", "leader_root"), "key").select(*_MEMBER, "n", "shingles", "leader_root")


_MEMBER = ("rid", "size", "root", "key", "leader", "leader_size")


def _links(sketches: DataFrame, all_texts: DataFrame, reps: DataFrame, threshold: float, block: int, weighting: str) -> DataFrame:
    """Verified links (a, b) between representatives: enough of them that every
    pair at or over the threshold that shares a bucket is in one component."""
    slack = 1e-9
    own = sketches.join(reps.select(F.col("rep").alias("rid")), "rid", "left_semi")
    rows = own.select("rid", "size", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("size", "rid")).alias("l")).filter("n > 1")
    members = materialise(rows.join(shared.select("key", "l"), "key").select(
        "rid", "size", "key", F.col("l.rid").alias("leader"), F.col("l.size").alias("leader_size")), "dart-members")
    texts = materialise(own.select("rid", "size").join(members.select("rid").distinct(), "rid", "left_semi")
                        .join(all_texts, "rid"), "dart-texts")
    release_shuffles(sketches.sparkSession)

    def verified(pairs: DataFrame) -> DataFrame:
        both = (pairs.select("a", "b").distinct()
                .join(texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
                .join(texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b"))
        sims = both.mapInArrow(tidy(_similarity(weighting)), "a long, b long, sim double")
        return materialise(sims.filter(F.col("sim") >= threshold).select("a", "b"), "dart-links")

    def may_reach(a, b):
        return F.least(a, b) >= F.lit(threshold - slack) * F.greatest(a, b)

    def opened(rows: DataFrame, links: DataFrame) -> DataFrame:
        """Rows in buckets of several classes under the links found so far."""
        roots = components(links).withColumnRenamed("node", "rid")
        rooted = rows.drop("root").join(roots, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
        return materialise(_mixed(rooted.select(*_MEMBER)), "dart-open")

    def able(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The open rows without the texts that cannot be linked out of their class; and the texts' shingles."""
        some = open_.select("rid", "root").distinct().join(texts.select("rid", "text"), "rid").select("rid", "root", "text")
        lists = materialise(some.mapInArrow(tidy(_element_lists(weighting)), "rid long, root long, hs array<long>, ws array<long>"),
                            "dart-elements")
        elements = lists.select("rid", "root", F.explode(F.arrays_zip("hs", "ws")).alias("e")).select(
            "rid", "root", F.col("e.hs").alias("h"), F.col("e.ws").alias("w"))
        across = elements.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("h")
        common = elements.join(across, "h", "left_semi").groupBy("rid").agg(F.sum("w").alias("common"))
        kept = common.join(texts.select("rid", "size"), "rid").filter(
            F.col("common") >= F.lit(threshold - slack) * F.col("size")).select("rid")
        return materialise(_mixed(open_.select(*_MEMBER).join(kept, "rid", "left_semi")), "dart-open"), lists

    def nearest(rows: DataFrame, met: DataFrame | None) -> DataFrame:
        """(a, b): each text's smallest leader that it has not met: one row per text, whatever its buckets."""
        reach = rows.filter("rid <> leader").filter(may_reach(F.col("size"), F.col("leader_size")))
        to = F.struct("leader_size", "leader")
        if met is None:
            best = reach.groupBy(F.col("rid").alias("a")).agg(F.min(to).alias("to"))
        else:                                              # at most one leader a band: the array is short
            each = reach.groupBy(F.col("rid").alias("a")).agg(F.collect_set(to).alias("all"))
            seen = met.groupBy("a").agg(F.collect_set("b").alias("seen"))
            fresh = F.filter("all", lambda x: ~F.array_contains(F.coalesce("seen", F.array().cast("array<long>")), x["leader"]))
            best = each.join(seen, "a", "left").select("a", F.array_min(fresh).alias("to")).filter("to IS NOT NULL")
        return materialise(best.select("a", F.col("to.leader").alias("b")), "dart-pairs")

    # a text meets the smallest of its leaders first; what that settles needs no other leader
    met = nearest(members, None)
    links, gone = verified(met), [members, texts, met]
    open_ = opened(members, links)
    for _ in range(ROUNDS):
        pairs = nearest(open_.filter("root <> leader_root"), met)
        gone += [pairs, open_]
        if pairs.isEmpty():
            break
        met, links = met.unionByName(pairs), links.unionByName(verified(pairs))
        release_shuffles(sketches.sparkSession)
        open_ = opened(open_, links)
    open_, lists = able(open_)
    release_shuffles(sketches.sparkSession)

    # what is left is compared across classes, block against block
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(block), F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
    own_block = F.pmod(F.xxhash64("rid", "key"), blocks).cast("int")
    placed = (open_.select("key", "rid", "root", blocks.alias("blocks"), own_block.alias("own"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "rid", "root", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")))
    full = placed.join(lists.select("rid", "hs", "ws"), "rid")
    more = full.groupBy("key", "one", "two").applyInArrow(_block_links(threshold), "a long, b long")
    found = materialise(links.unionByName(materialise(more.distinct(), "dart-links")).distinct(), "dart-links")
    for done in (*gone, open_, lists):
        drop_scratch(sketches.sparkSession, done)
    return found


def _classes(sketches: DataFrame, texts: DataFrame, threshold: float, block: int, weighting: str) -> DataFrame:
    """(hi, lo) -> class_id, class_size, keep_rid for texts with words."""
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    reps = materialise(sketches.filter("hi is not null").groupBy("hi", "lo").agg(
        F.min("rid").alias("rep"), best.alias("best"), F.count("*").alias("n")), "dart-reps")
    roots = components(_links(sketches, texts, reps, threshold, block, weighting))
    placed = (reps.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
              .withColumn("root", F.coalesce("root", "rep")))
    total = placed.groupBy("root").agg(F.min("best").alias("keep"), F.sum("n").alias("class_size"))
    return placed.select("hi", "lo", "root").join(total, "root").select(
        "hi", "lo", F.col("keep.id").alias("class_id"), "class_size", F.col("keep.rid").alias("keep_rid"))


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, weighting: str = "count",
                           block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest id of its class), class_size."""
    rows, rid = _numbered(docs.select("doc_id", "text"))
    sk, texts = _sketches(rows, rid, k, weighting)
    classes = _classes(sk, texts, threshold, block, weighting)
    with_words = (sk.filter("hi is not null").select("id", "hi", "lo").join(classes, ["hi", "lo"])
                  .select(F.col("id").alias("doc_id"), "class_id", "class_size"))
    without = sk.filter("hi is null").select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"),
                                             F.lit(1).cast("long").alias("class_size"))
    return with_words.unionByName(without)


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, weighting: str = "count",
                     block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay (one per class, the smallest id), with all their columns."""
    release_shuffles(docs.sparkSession)      # an earlier operator's files are not read again
    rows, rid = _numbered(docs)
    sk, texts = _sketches(rows, rid, k, weighting)
    classes = _classes(sk, texts, threshold, block, weighting).filter("class_size > 1")
    gone = materialise(sk.filter("hi is not null").select("rid", "hi", "lo").join(classes, ["hi", "lo"])
                       .filter("rid <> keep_rid").select(F.col("rid").alias(rid)), "dart-gone")
    return rows.join(gone, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
