"""Sequence packing by minimum bin slack.

A document is its token ids followed by one end id. Documents are cut into
full windows of ``window`` ids (each is a sequence of its own) and one
remainder. Remainders are dealt by a hash of their piece id into groups of
about ``group_pieces`` (more rows give more groups, never larger ones). In
each group the longest remaining piece seeds a window, a bitset subset-sum
dynamic programme over the remaining-length multiset finds the reachable
sum closest to the capacity left, and the counts per length are read back
from the stored bitsets. The same filling is repeated as often as the
multiset allows.

Edge cases: null and empty texts are the end id alone; ids, ties and
repeated rows need no uniqueness (pieces carry their own id); an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import materialise

WINDOW, END_ID, GROUP_PIECES = 2048, 1, 2000
GROUPS_PER_TASK, MAX_TASKS = 4, 20_000
VOCABULARY = "byte_bpe_50k"

_ENCODERS: dict = {}


def encoder(vocabulary: str = VOCABULARY):
    """text -> ids of ``<vocabulary>.json`` without added special tokens.

    The same vocabulary is also published as ranks, which tiktoken encodes
    about four times faster to the same ids (tested); a text that spells a
    special token goes through the JSON tokenizer, which defines its id.
    """
    if vocabulary not in _ENCODERS:
        import public_tokenizers as files
        import tiktoken
        from tokenizers import Tokenizer
        with open(files.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(vocabulary, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
        exact = Tokenizer.from_file(files.path(f"{vocabulary}.json"))
        special = [t.content for t in exact.get_added_tokens_decoder().values()]

        def encode(text: str) -> list[int]:
            if any(s in text for s in special):
                return exact.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)
        _ENCODERS[vocabulary] = encode
    return _ENCODERS[vocabulary]


def _cutter(window: int, end_id: int, vocabulary: str, with_ids: bool):
    def run(batches):
        encode, pid, seq = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            rows, out = [], {k: [] for k in ("piece", "start", "length", "ids_crc32", "doc_tokens", "ids")}
            for i in range(batch.num_rows):
                tokens = np.array([*encode(texts[i].as_py() or ""), end_id], "<u4")
                for a in range(0, len(tokens), window):
                    part = tokens[a: a + window]
                    rows.append(i)
                    out["piece"].append((pid << 33) + seq)
                    seq += 1
                    out["start"].append(a)
                    out["length"].append(len(part))
                    out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    out["doc_tokens"].append(len(tokens))
                    if with_ids:
                        out["ids"].append(part.astype(np.int32))
            arrays = [ids.take(pa.array(rows, pa.int64()))]
            names = ["doc_id"]
            for name, values in out.items():
                if name != "ids" or with_ids:
                    arrays.append(pa.array(values, pa.list_(pa.int32()) if name == "ids" else pa.int64()))
                    names.append(name)
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def cut(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY,
        with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``window`` ids; ``with_ids`` adds the ids themselves."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, piece long, start long, length long, ids_crc32 long, doc_tokens long"
              + (", ids array<int>" if with_ids else ""))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _cutter(window, end_id, vocabulary, with_ids), schema)


def closest_filling(count: dict[int, int], capacity: int) -> dict[int, int]:
    """Pieces per length whose sum is the largest not over ``capacity``.

    ``count``: pieces left per length. Bit s of a bitset says that sum s is
    reachable; lengths enter in descending order, split into powers of two
    of their count, until the capacity itself is reachable.
    """
    keep = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n, c in count.items() if c and n <= capacity), reverse=True):
        left, take = min(count[length], capacity // length), 1
        while left > 0:
            take = min(take, left)
            before = reach
            reach |= (reach << (length * take)) & keep
            steps.append((length, take, before))
            left -= take
            take *= 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not (before >> total) & 1:
            used[length] += take
            total -= length * take
    return dict(used)


def fill(lengths, window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of indices into ``lengths`` (each from 1 to ``window``)."""
    where = defaultdict(list)
    for i, n in enumerate(lengths):
        where[int(n)].append(i)
    count = {n: len(v) for n, v in where.items()}
    bins = []
    for seed in sorted(where, reverse=True):
        while count[seed]:
            count[seed] -= 1
            used = closest_filling(count, window - seed)
            count[seed] += 1
            used[seed] = used.get(seed, 0) + 1
            for _ in range(min(count[n] // c for n, c in used.items())):
                bins.append([where[n].pop() for n, c in sorted(used.items(), reverse=True) for _ in range(c)])
                for n, c in used.items():
                    count[n] -= c
    return bins


def _fill_group(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece", ignore_index=True)
        group, lengths, pieces = int(pdf["grp"].iloc[0]), pdf["length"].to_numpy(), pdf["piece"].to_numpy()
        rows = []
        for k, members in enumerate(fill(lengths, window)):
            offset = 0
            for i in members:
                rows.append((pieces[i], 2 * ((group << 32) + k) + 1, offset))
                offset += int(lengths[i])
        return pd.DataFrame(rows, columns=["piece", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY,
         group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (, ids)."""
    pieces = materialise(cut(docs, window, end_id, vocabulary, with_ids), "pack-pieces")
    short = pieces.filter(F.col("length") < window)
    groups = max(1, -(-short.count() // group_pieces))
    # lengths are a few bytes: the number of tasks follows the groups, not the bytes that AQE would coalesce
    dealt = (short.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(groups)).alias("grp"))
             .repartition(min(MAX_TASKS, -(-groups // GROUPS_PER_TASK)), "grp"))
    placed = dealt.groupBy("grp").applyInPandas(_fill_group(window), "piece long, sequence_id long, offset long")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    full = (pieces.filter(F.col("length") == window)
            .withColumn("sequence_id", 2 * F.col("piece")).withColumn("offset", F.lit(0).cast("long")))
    return short.join(placed, "piece").select(out).unionByName(full.select(out))
