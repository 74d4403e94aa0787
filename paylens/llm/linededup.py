"""Line deduplication with two Bloom filters.

A text is split at line feeds (null and empty: one empty line). A line's key
is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
lower-cased. Keys of at least ``min_chars`` code points that occur in two
documents or more lose all their lines except in the smallest doc_id that
holds them; the other lines stay, joined by line feeds.

1. Filters. Each task hashes its lines (numpy over whole slices) and sets
   two bits a key in the filter *once*; keys that it meets in two documents
   also in the filter *twice*. It hands on the set bits in chunks of 2^16.
   A chunk's parts from all tasks are merged in one stream: a bit that two
   tasks set enters *twice*. A line in a third of all documents costs one
   part per task here, and no part is larger than its task's distinct keys.
2. Suspects. *Twice* has ``filter_bits`` bits whatever the corpus (32 MB) and
   is broadcast. Lines with both bits in it are suspected repeats; no repeat
   is missed. A fuller filter suspects more lines and never changes the
   result.
3. Confirmation. Only suspects are shuffled, as one record per key and slice
   (the key's SHA-256, its documents and lines), so a hot line costs one
   record per slice and not one per document. Records of a key give its
   smallest doc_id and whether there is another; the lines elsewhere go back
   to their rows, and only rows with a suspect carry their text along.

Edge cases: rows of one doc_id are one document, and so are all rows with a
null id, which sorts last; a key repeated inside one document only is kept;
repeated rows are treated alike; very long lines count by their whole
content; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import materialise
from paylens.llm.words import U, VISIBLE, _LOWER, mix, slices, span_hashes

MIN_CHARS, FILTER_BITS = 10, 28
CHUNK = 16                          # bits of a position inside its chunk
DENSE = 1 << (CHUNK - 3)            # bytes of a whole chunk; fewer set bits are sent as 16-bit offsets
_BLANK = b" \t\n\x0b\x0c\r"


def lines(raw: np.ndarray, off: np.ndarray):
    """(document, start, end, key start, key end) of every line of a slice; blank keys are empty."""
    n = len(off) - 1
    breaks = np.flatnonzero(raw == 10)
    doc_of = np.searchsorted(off, breaks, side="right") - 1
    count = np.bincount(doc_of, minlength=n) + 1
    doc = np.repeat(np.arange(n), count)
    first = np.cumsum(count) - count
    start, end = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    start[first], end[first + count - 1] = off[:-1], off[1:]
    at = np.arange(len(breaks)) + doc_of                     # the line that each break ends
    end[at], start[at + 1] = breaks, breaks + 1
    seen = np.flatnonzero(VISIBLE[raw])
    a, b = np.searchsorted(seen, start), np.searchsorted(seen, end)
    some = a < b
    left, right = start.copy(), start.copy()
    left[some], right[some] = seen[a[some]], seen[b[some] - 1] + 1
    return doc, start, end, left, right


def long_keys(raw: np.ndarray, left: np.ndarray, right: np.ndarray, min_chars: int) -> np.ndarray:
    """Lines whose key has at least ``min_chars`` code points."""
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return np.flatnonzero(points[right] - points[left] >= min_chars)


def positions(h: np.ndarray, filter_bits: int) -> np.ndarray:
    """The two bits of each hash (columns)."""
    shift = U(64 - filter_bits)
    return np.stack([h >> shift, mix(h ^ U(0x6A09E667F3BCC909)) >> shift], axis=1).astype(np.int64)


def _set(bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))


def _part_filters(min_chars: int, filter_bits: int):
    """chunk, once, twice: a task's set bits, by chunk."""
    def run(batches):
        once, twice = (np.zeros(1 << (filter_bits - 3), np.uint8) for _ in range(2))
        for batch in batches:
            ids = batch.column("doc_id").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for i, j, raw, off in slices(batch.column("text")):
                doc, _, _, left, right = lines(raw, off)
                own = long_keys(raw, left, right, min_chars)
                h, who = span_hashes(raw, left[own], right[own]), ids[i:j][doc[own]]
                order = np.lexsort((who, h))
                h, who = h[order], who[order]
                new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
                other = np.flatnonzero(~new[1:] & (who[1:] != who[:-1])) + 1 if len(h) else np.zeros(0, int)
                at = positions(h[new], filter_bits)
                # a key of an earlier slice, or one that looks like it, is met again
                known = ((once[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
                _set(twice, at[known].ravel())
                _set(twice, positions(h[other], filter_bits).ravel())
                _set(once, at.ravel())
        yield from _chunks(once, twice)
    return run


def _pack(at: np.ndarray) -> bytes:
    """Set bits of a chunk (16-bit offsets): the offsets, or all its bits where that is no longer."""
    if 2 * len(at) < DENSE:
        return at.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK, bool)
    bits[at] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _unpack(part: bytes) -> np.ndarray:
    if len(part) < DENSE:
        return np.frombuffer(part, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(part, np.uint8), bitorder="little"))


def _chunks(once: np.ndarray, twice: np.ndarray):
    for base in range(0, len(once), 1 << 19):                # 64 chunks of 8 KB at a time
        made = {}
        for name, bits in (("once", once), ("twice", twice)):
            at = np.flatnonzero(np.unpackbits(bits[base: base + (1 << 19)], bitorder="little")) + base * 8
            cut = np.flatnonzero(np.diff(at >> CHUNK)) + 1 if len(at) else []
            for part in np.split(at, cut) if len(at) else []:
                made.setdefault(int(part[0] >> CHUNK), {})[name] = _pack(part & 0xFFFF)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), *(
                pa.array([v.get(c, b"") for v in made.values()], pa.binary()) for c in ("once", "twice"))], ["chunk", "once", "twice"])


def _merge_chunks(batches):
    """chunk, twice: the bits that two tasks set, or one of them twice (rows come sorted by chunk)."""
    now, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_pack(np.flatnonzero(twice))], pa.binary())],
                                          ["chunk", "twice"])
    for batch in batches:
        for chunk, a, b in zip(*(batch.column(c).to_pylist() for c in ("chunk", "once", "twice"))):
            if chunk != now:
                if now is not None:
                    yield done()
                now, once, twice = chunk, np.zeros(1 << CHUNK, bool), np.zeros(1 << CHUNK, bool)
            at = _unpack(a)
            twice[at[once[at]]] = True
            once[at] = True
            twice[_unpack(b)] = True
    if now is not None:
        yield done()


def twice_filter(docs: DataFrame, min_chars: int = MIN_CHARS, filter_bits: int = FILTER_BITS) -> bytes:
    """The filter of keys seen in two documents or more, as packed bits (2^``filter_bits`` of them)."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = rows.mapInArrow(_part_filters(min_chars, filter_bits), "chunk int, once binary, twice binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merge_chunks, "chunk int, twice binary")
    bits = np.zeros(1 << (filter_bits - 3), np.uint8)
    made = merged.toArrow()  # at most 2^filter_bits bits
    for chunk, part in zip(made.column("chunk").to_pylist(), made.column("twice").to_pylist()):
        _set(bits, _unpack(part) + (chunk << CHUNK))
    return bits.tobytes()


def _suspects(min_chars: int, filter_bits: int, twice, arrow: pa.Schema):
    """Rows (rid, doc_id, n_lines, whole_sha, text where a line is suspected) and, per
    suspected key of a slice, a record (key, ids, rids, at)."""
    def run(batches):
        bits = np.frombuffer(twice.value, np.uint8)
        pid, seq = TaskContext.get().partitionId(), 0
        id_type = arrow.field("doc_id").type
        for batch in batches:
            for i, j, raw, off in slices(batch.column("text")):
                n, buf = j - i, memoryview(raw)
                doc, _, _, left, right = lines(raw, off)
                count = np.bincount(doc, minlength=n)
                first = np.cumsum(count) - count
                own = long_keys(raw, left, right, min_chars)
                h = span_hashes(raw, left[own], right[own])
                at = positions(h, filter_bits)
                hit = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
                own, h = own[hit], h[hit]
                ids, rid = batch.column("doc_id").slice(i, n).cast(id_type), np.arange(n) + ((pid << 33) + seq)
                seq += n
                held = np.bincount(doc[own], minlength=n) > 0
                cuts = off.tolist()
                sha = [hashlib.sha256(buf[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
                texts = batch.column("text").slice(i, n).cast(pa.string())
                made = {"rid": pa.array(rid), "doc_id": ids, "n_lines": pa.array(count), "whole_sha": pa.array(sha),
                        "text": _where(held, texts)}
                yield _batch(made, n, arrow)
                # equal hashes of a slice are told apart by their keys' digests
                where, spans = {}, zip(own.tolist(), left[own].tolist(), right[own].tolist())
                for line, a, b in spans:
                    where.setdefault(hashlib.sha256(bytes(buf[a:b]).translate(_LOWER_BYTES)).digest(), []).append(line)
                if where:
                    size = np.array([len(v) for v in where.values()])
                    line = np.concatenate([np.array(v) for v in where.values()])
                    cut = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                    of = doc[line]
                    yield _batch({"key": pa.array(list(where), pa.binary()),
                                  "ids": pa.ListArray.from_arrays(cut, ids.take(pa.array(of))),
                                  "rids": pa.ListArray.from_arrays(cut, pa.array(rid[of])),
                                  "at": pa.ListArray.from_arrays(cut, pa.array(line - first[of]))}, len(size), arrow)
    return run


_LOWER_BYTES = bytes(_LOWER)


def _where(held: np.ndarray, texts: pa.Array) -> pa.Array:
    return texts.take(pa.array(np.arange(len(held)), mask=~held))


def _batch(made: dict, n: int, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([made[f.name].cast(f.type) if f.name in made else pa.nulls(n, f.type) for f in arrow], schema=arrow)


def _kept_text(text: str | None, drops) -> str:
    gone = set(drops)
    return "\n".join(t for k, t in enumerate((text or "").split("\n")) if k not in gone)


def _shortened(arrow: pa.Schema, with_text: bool):
    def run(batches):
        for b in batches:
            texts = [_kept_text(t, d) for t, d in zip(b.column("text").to_pylist(), b.column("drops").to_pylist())]
            made = {"rid": b.column("rid"), "doc_id": b.column("doc_id"), "n_lines": b.column("n_lines"),
                    "n_dropped": pa.array([len(d) for d in b.column("drops").to_pylist()]),
                    "kept_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                    **({"kept_text": pa.array(texts)} if with_text else {})}
            yield _batch(made, b.num_rows, arrow)
    return run


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, filter_bits: int = FILTER_BITS, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256 (, kept_text: null where nothing is dropped)."""
    spark, id_field = docs.sparkSession, docs.schema["doc_id"]
    arrow_id = docs.limit(0).toArrow().schema.field("doc_id").type
    twice = spark.sparkContext.broadcast(twice_filter(docs, min_chars, filter_bits))
    arrow = pa.schema([("rid", pa.int64()), ("doc_id", arrow_id), ("n_lines", pa.int64()), ("whole_sha", pa.string()),
                       ("text", pa.string()), ("key", pa.binary()), ("ids", pa.list_(arrow_id)), ("rids", pa.list_(pa.int64())),
                       ("at", pa.list_(pa.int64()))])
    ids = T.StructField("ids", T.ArrayType(id_field.dataType))
    schema = T.StructType([T.StructField("rid", T.LongType()), id_field, *T.StructType.fromDDL("n_lines long, whole_sha string, text string, key binary"),
                           ids, *T.StructType.fromDDL("rids array<long>, at array<long>")])
    found = materialise(docs.select("doc_id", F.col("text").cast("string").alias("text"))
                        .mapInArrow(_suspects(min_chars, filter_bits, twice, arrow), schema), "lines-found")
    rows, records = found.filter("key IS NULL"), found.filter("key IS NOT NULL").select("key", "ids", "rids", "at")
    # a key's smallest document, and whether it is in any other (a null id sorts last)
    some = F.exists("ids", lambda x: x.isNull())
    by_key = records.groupBy("key").agg(F.min(F.array_min("ids")).alias("first"), F.max(F.array_max("ids")).alias("last"),
                                        F.max(some.cast("int")).alias("unnamed"))
    repeated = by_key.filter((F.col("first") < F.col("last")) | (F.col("first").isNotNull() & (F.col("unnamed") == 1)))
    lost = (records.join(repeated.select("key", "first"), "key")
            .select("first", F.explode(F.arrays_zip("ids", "rids", "at")).alias("l"))
            .filter(~F.col("l.ids").eqNullSafe(F.col("first"))).groupBy(F.col("l.rids").alias("rid"))
            .agg(F.collect_list("l.at").alias("drops")))
    lost = materialise(lost, "lines-lost")
    out = [("rid", pa.int64()), ("doc_id", arrow_id), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
    kinds = T.StructType([T.StructField("rid", T.LongType()), id_field, *T.StructType.fromDDL("n_lines long, n_dropped long, kept_sha256 string")])
    if with_text:
        out, kinds = out + [("kept_text", pa.string())], T.StructType([*kinds, T.StructField("kept_text", T.StringType())])
    changed = rows.select("rid", "doc_id", "n_lines", "text").join(lost.hint("merge"), "rid").mapInArrow(_shortened(pa.schema(out), with_text), kinds)
    same = rows.select("rid", "doc_id", "n_lines", "whole_sha").join(lost.select("rid"), "rid", "left_anti").select(
        "rid", "doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), F.col("whole_sha").alias("kept_sha256"),
        *([F.lit(None).cast("string").alias("kept_text")] if with_text else []))
    return changed.unionByName(same).drop("rid")


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (
  SELECT doc_id, pos, l[pos] AS line, translate(regexp_replace(l[pos], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM d)),
again AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.doc_id, pos, line, coalesce(l.doc_id <> again.first, false) AS gone FROM l LEFT JOIN again USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
