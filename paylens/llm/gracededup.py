"""Exact deduplication by Grace hashing.

Texts are equal when identical after deleting white space
``[\\x20\\x09-\\x0D]``. Of equal texts the row with the most code points in
the original text stays, then the smallest ``doc_id`` (null ids last).

1. Each task removes the copies inside blocks of its own input with an
   open-addressing table that compares complete content. A block's rows of
   one text become one record (with the ids of its rows), so a text that
   makes up a third of all rows costs one record per block, not per row.
2. A hash with records from more than ``fan`` blocks is merged first, in
   groups of about ``fan`` records (hash and salt), level by level, so a
   text of a third of all rows reaches no task more than ``fan`` times or so.
3. The records are written to the shared folder and partitioned by leading
   bits of a 64-bit content hash. Partitions whose distinct content exceeds
   ``table_bytes`` are written out again and split by further bits, level
   by level, until each bucket fits one table (a bucket of a single text
   cannot be split and needs none).
4. A task reads its buckets one after another (Spark's shuffle files are
   the spill files, sorted by bucket) into an open-addressing table and
   compares complete content, so equal hashes never merge different texts.
5. Group results return to the rows through the records' unique ids: no
   join key is hot (a merged record has at most about ``fan`` records below it).

Nulls and edge cases: a null text counts as empty and all empty or blank
texts form one group; null ids sort last; a repeated row is a copy like any
other (exactly one row per group is kept); an empty table gives no rows;
extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import materialise, tidy
from paylens.llm.words import flat

BLANK = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 32 << 20   # input rows deduplicated together before the shuffle
TABLE_BYTES = 32 << 20   # distinct content that one open-addressing table may hold
LEVEL_BITS = 4           # fan-out of 16 per recursion level
MAX_BITS = 60
FAN = 8                  # records of one hash that meet in one task


class OpenTable:
    """Open addressing with linear probing; equality is complete content."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find_or_add(self, h: int, content: bytes) -> int:
        mask, slots = len(self.slots) - 1, self.slots
        i = h & mask
        while (k := slots[i]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                return k
            i = (i + 1) & mask
        k = slots[i] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return k

    def _grow(self):
        mask = 2 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for k, h in enumerate(self.hashes):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = k
        self.slots = slots


def content_hash(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _rank(n_points: int, doc_id) -> tuple:
    """Smaller is better: most code points, then smallest id, null ids last."""
    return (-n_points, doc_id is None, doc_id if doc_id is not None else 0)


def _contents(texts) -> tuple[list[bytes], np.ndarray]:
    """Normalised content and code points of each text."""
    raw, off = flat(texts)
    buf, cuts = memoryview(raw), off.tolist()
    points = pc.fill_null(pc.utf8_length(texts.cast(pa.large_string())), 0)
    return [bytes(buf[a:b]).translate(None, BLANK) for a, b in zip(cuts, cuts[1:])], points.to_numpy()


def _blocks(batches, limit: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        for i in range(0, b.num_rows, 2000):
            part = b.slice(i, 2000)
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _local_records(schema: pa.Schema, hasher, limit: int):
    def run(batches):
        pid, seq = TaskContext.get().partitionId(), 0
        for block in _blocks(batches, limit):
            contents, points = _contents(block.column("text"))
            ids = block.column("id").to_pylist()
            table, members, shas = OpenTable(), [], []
            for i, content in enumerate(contents):
                sha = hashlib.sha256(content).digest()
                k = table.find_or_add(hasher(sha), content)
                if k == len(members):
                    members.append([i])
                    shas.append(sha)
                else:
                    members[k].append(i)
            best = [min(range(len(m)), key=lambda j, m=m: _rank(points[m[j]], ids[m[j]])) for m in members]
            rows = [m[j] for m, j in zip(members, best)]
            taken = block.take(rows)
            out = {"rep_id": [(pid << 33) + seq + k for k in range(len(members))],
                   "h": [_signed(h) for h in table.hashes], "sha": shas, "bytes": [len(c) for c in table.contents],
                   "points": points[rows], "best_id": [ids[i] for i in rows], "best_at": best,
                   "size": [len(m) for m in members], "members": [[ids[i] for i in m] for m in members]}
            seq += len(members)
            cols = [taken.column("row").combine_chunks() if f.name == "row" else
                    taken.column("text").combine_chunks() if f.name == "text" else out[f.name] for f in schema]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                                              for c, f in zip(cols, schema)], schema=schema)
    return run


def _merge_buckets(schema: pa.Schema, hasher, with_rows: bool):
    """Per bucket: one table; emit for every record its group's result."""
    def emit(reps, groups):
        where = {"rep_id": [], "keep_rep": [], "keep_at": [], "keep_id": [], "group_size": []}
        for rep, k in reps:
            g = groups[k]
            for name, v in zip(where, (rep, g[1], g[2], g[3], g[4])):
                where[name].append(v)
        arrays = [pa.array(where[f.name], f.type) for f in schema if f.name != "row"]
        if with_rows:
            kept = {g[1]: g[5] for g in groups}
            parts = [kept.get(rep) for rep, _ in reps]
            chunks = [p if p is not None else pa.nulls(1, schema.field("row").type) for p in parts]
            arrays.append(pa.concat_arrays([c.cast(schema.field("row").type) for c in chunks]))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches):
        bucket, table, groups, reps = None, None, [], []
        for b in batches:
            rows = b.column("row") if with_rows else None
            texts = b.column("text") if rows is None else rows.field("text")
            contents, _ = _contents(texts.cast(pa.string()))
            cols = [b.column(c).to_pylist() for c in ("bits", "prefix", "sha", "rep_id", "points", "best_id", "best_at",
                                                      "size")]
            for i, (bits, prefix, sha, rep, points, best_id, at, size) in enumerate(zip(*cols)):
                if (bits, prefix) != bucket:
                    if reps:
                        yield emit(reps, groups)
                    bucket, table, groups, reps = (bits, prefix), OpenTable(), [], []
                rank = (*_rank(points, best_id), rep)
                k = table.find_or_add(hasher(sha), contents[i])
                own = [rank, rep, at, best_id, size, rows.take(pa.array([i])) if rows is not None else None]
                if k == len(groups):
                    groups.append(own)
                else:
                    own[4] += groups[k][4]
                    if rank < groups[k][0]:
                        groups[k] = own
                    else:
                        groups[k][4] = own[4]
                reps.append((rep, k))
        if reps:
            yield emit(reps, groups)
    return run


def _merge_salted(schema: pa.Schema, hasher):
    """Per (h, salt): records of equal content become one, that of the best row;
    the others are returned as rep_id and parent (the one they went into)."""
    payload = "row" if "row" in schema.names else "text"
    plain = [f for f in schema.names if f not in (payload, "parent")]

    def emit(groups):
        out = {name: [] for name in schema.names}
        for own in groups:
            best = min(own, key=lambda r: (*_rank(r["points"], r["best_id"]), r["rep_id"]))
            for r in own:
                first = r is best
                for name in plain:
                    out[name].append(r[name] if first or name == "rep_id" else None)
                if first:
                    out["size"][-1] = sum(m["size"] for m in own)
                out["parent"].append(None if first else best["rep_id"])
                out[payload].append(r[payload] if first else None)
        kind = schema.field(payload).type
        blobs = pa.concat_arrays([p.cast(kind) if p is not None else pa.nulls(1, kind) for p in out[payload]])
        return pa.RecordBatch.from_arrays([blobs if f.name == payload else pa.array(out[f.name], f.type) for f in schema], schema=schema)

    def run(batches):
        now, table, groups = None, None, []
        for b in batches:
            texts = b.column("text") if payload == "text" else b.column("row").field("text")
            contents, _ = _contents(texts.cast(pa.string()))
            cols = {c: b.column(c).to_pylist() for c in (*plain, "salt")}
            for i, content in enumerate(contents):
                if (cols["h"][i], cols["salt"][i]) != now:
                    if groups:
                        yield emit(groups)
                    now, table, groups = (cols["h"][i], cols["salt"][i]), OpenTable(), []
                k = table.find_or_add(hasher(cols["sha"][i]), content)
                if k == len(groups):
                    groups.append([])
                groups[k].append({**{c: cols[c][i] for c in plain}, payload: b.column(payload).slice(i, 1)})
        if groups:
            yield emit(groups)
    return run


def _premerged(records: DataFrame, arrow: pa.Schema, hasher, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """Records with at most about ``fan`` of one content, and per level the
    (rep_id, parent) of those that went into another. Different contents of
    one hash do not shrink: a level that merges nothing is the last."""
    links = []
    while True:
        many = records.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > fan).select(
            "h", F.ceil(F.col("n") / fan).cast("int").alias("salts"))
        many = materialise(many, "grace-many")
        if many.isEmpty():
            return records, links
        salted = (records.join(many, "h").withColumn("salt", F.pmod(F.xxhash64("rep_id"), "salts").cast("int")).drop("salts")
                  .repartition("h", "salt").sortWithinPartitions("h", "salt"))
        out = arrow.append(pa.field("parent", pa.int64()))
        schema = T.StructType([*records.schema, T.StructField("parent", T.LongType())])
        met = materialise(salted.select(*records.columns, "salt").mapInArrow(tidy(_merge_salted(out, hasher)), schema), "grace-met")
        gone = met.filter("parent IS NOT NULL").select("rep_id", "parent")
        if gone.isEmpty():
            return records, links
        links.append(gone)
        records = records.join(many, "h", "left_anti").select(records.columns).unionByName(
            met.filter("parent IS NULL").select(records.columns))


def _schemas(docs: DataFrame, fields: list[str]) -> tuple[T.StructType, pa.Schema]:
    """Spark and Arrow schema of record fields; ``id`` takes the type of
    ``doc_id`` and ``row`` that of a whole row of ``docs``."""
    id_type, arrow = docs.schema["doc_id"].dataType, docs.limit(0).toArrow().schema
    arrow_id = arrow.field("doc_id").type
    kinds = {"sha": (T.BinaryType(), pa.binary()), "text": (T.StringType(), pa.string()),
             "best_id": (id_type, arrow_id), "keep_id": (id_type, arrow_id),
             "members": (T.ArrayType(id_type), pa.list_(arrow_id)), "row": (docs.schema, pa.struct(list(arrow)))}
    long = (T.LongType(), pa.int64())
    return (T.StructType([T.StructField(f, kinds.get(f, long)[0]) for f in fields]),
            pa.schema([(f, kinds.get(f, long)[1]) for f in fields]))


def _bucketed(records: DataFrame, table_bytes: int) -> DataFrame:
    """Add (bits, prefix): the bucket of each record. Oversized buckets are
    written out and split by more hash bits, level by level."""
    spark = records.sparkSession
    distinct = materialise(records.groupBy("h").agg(F.max("bytes").alias("bytes")), "grace-sizes")
    total = distinct.agg(F.sum("bytes")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, math.ceil(math.log2(4 * max(parts, 1))), math.ceil(math.log2(total / table_bytes + 1)))
    levels = []
    while True:
        prefix = F.shiftrightunsigned("h", 64 - bits)
        over = (distinct.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
                .filter((F.col("b") > table_bytes) & (F.col("n") > 1)).select("prefix"))
        here = records.withColumn("bits", F.lit(bits)).withColumn("prefix", prefix)
        if bits >= MAX_BITS or over.isEmpty():
            levels.append(here)
            break
        over = materialise(over, "grace-over")
        levels.append(here.join(over, "prefix", "left_anti").select(here.columns))
        records = materialise(here.join(over, "prefix", "left_semi").select(records.columns), "grace-spill")
        distinct = distinct.withColumn("prefix", prefix).join(over, "prefix", "left_semi").select("h", "bytes")
        bits = min(MAX_BITS, bits + LEVEL_BITS)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def _grace(docs: DataFrame, with_rows: bool, hasher, block_bytes: int, table_bytes: int, fan: int):
    narrow = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"),
                         *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_rows else []))
    tail = ["row"] if with_rows else []  # a whole row holds the text as well
    spark_schema, arrow = _schemas(docs, ["rep_id", "h", "sha", "bytes", "points", "best_id", "best_at", "size",
                                          "members", *(tail or ["text"])])
    records = materialise(narrow.mapInArrow(tidy(_local_records(arrow, hasher, block_bytes)), spark_schema), "grace-records")
    out_schema, out_arrow = _schemas(docs, ["rep_id", "keep_rep", "keep_at", "keep_id", "group_size", *tail])
    merged, links = _premerged(records.drop("members"), arrow.remove(arrow.get_field_index("members")), hasher, fan)
    dealt = (_bucketed(merged, table_bytes).repartition("bits", "prefix")
             .sortWithinPartitions("bits", "prefix"))
    return records, dealt.mapInArrow(tidy(_merge_buckets(out_arrow, hasher, with_rows)), out_schema), links


def exact_groups(docs: DataFrame, hasher=content_hash, block_bytes: int = BLOCK_BYTES,
                 table_bytes: int = TABLE_BYTES, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    records, groups, links = _grace(docs, False, hasher, block_bytes, table_bytes, fan)
    if links:
        groups = materialise(groups, "grace-groups")
    for gone in reversed(links):
        groups = groups.unionByName(gone.join(groups.withColumnRenamed("rep_id", "parent"), "parent").drop("parent"))
    rows = (records.select("rep_id", "sha", "members").join(groups, "rep_id")
            .select("rep_id", "sha", "keep_rep", "keep_at", "keep_id", "group_size",
                    F.posexplode("members").alias("at", "doc_id")))
    return rows.select(
        "doc_id", "keep_id", "group_size",
        ((F.col("rep_id") == F.col("keep_rep")) & (F.col("at") == F.col("keep_at"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, hasher=content_hash, block_bytes: int = BLOCK_BYTES,
                      table_bytes: int = TABLE_BYTES, fan: int = FAN) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    _, groups, _ = _grace(docs, True, hasher, block_bytes, table_bytes, fan)  # a merged record is the best of its own
    return groups.filter(F.col("rep_id") == F.col("keep_rep")).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS original,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
g AS (
  SELECT doc_id,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY length(original) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size, sha256(body) AS text_sha256
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
