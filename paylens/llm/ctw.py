"""Corpus language model by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z lower-cased and one end byte (0xFF, which
UTF-8 never uses; it also pads the context before the first byte). Each
byte is eight binary decisions. A node is a context of 0 to ``depth``
preceding bytes plus the bits already decided; it holds the counts of the
next bit over the training texts.

Weights. Pe(node) is the Krichevsky-Trofimov block probability of a node's
counts. From the deepest contexts up, Pw = Pe at full depth, else
Pw = (Pe + product of Pw over the one-byte-longer contexts) / 2. The share
of Pe in Pw is the node's weight of its own KT estimate in the prediction;
the rest goes to the longer context. Where a scored context leaves the
observed tree, the last node on it acts as a leaf. Both bits see the same
path, so every prediction is a probability and a text's score is the log10
probability of its bytes and end.

Jobs. Grams are written nearest context byte first, so that sorted grams
stand subtree by subtree. Tasks list the distinct (depth+1)-byte grams of
their blocks of about ``BLOCK_BYTES`` and deal them by the three nearest
bytes, packed: sorted keys as differences, in byte planes, compressed.

1. Counts. The training grams of all blocks meet by subtree and are weighted
   there, a run of whole subtrees at a time; per depth-2 node the sums over
   its children are all that is kept. Depths 0 to 2 (at most 65,793 contexts
   of 255 nodes, whatever the corpus) are finished on the driver and
   broadcast. The same pass counts the words.
2. Scores. Grams go to their subtree once more, now of all texts and with
   the documents of their block in which they occur. A task rebuilds its
   subtrees, turns every distinct gram into its log2 probability and adds
   that to its documents; what leaves the task is one sum per document. No
   table of probabilities is written, no text is moved.

Below a context that training saw once every deeper node has the same
counts, so its Pw is its Pe: such nodes are left out, with equal results.
Neither grams nor deep nodes pass through the driver or a broadcast, and the
depth is the same at every size (3 to 7: a gram is a 64-bit key).

Baseline. ``base_score`` is the add-one unigram score over words
``[^\\x20\\x09-\\x0D]+`` and one end token. Counts of the ``hot_words`` most
frequent words (16 bytes each) are broadcast; every other word goes to its
bucket with the documents it occurs in, is counted there anew and adds to
its documents' sums, as the grams do: no table of words is joined.

Edge cases: null text is empty (one end byte, one end token); null ids fall
in the fold of ''; repeated rows are learned and scored each; without
training rows every bit has probability 1/2 and N = V = 0; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.common import drop_scratch, held_out, materialise, release_shuffles, tidy
from paylens.llm.words import SLICE_BYTES, U, VISIBLE, _LOWER, counted, mix, slices, words

DEPTH, FOLDS, END = 7, 7, 0xFF
COUNT_BYTES = 6 << 20            # texts whose grams are counted together
BLOCK_BYTES = 4 << 20            # texts whose grams are listed together with the documents they occur in
BLOCK_DOCS = 60_000              # of at most this many texts: a document's place in its block has 16 bits
HELD = 2 << 20                   # distinct words (or documents' sums) a task holds before it hands them on
CHUNK = 1 << 18                  # grams weighted together, rounded up to whole subtrees
BUCKET_BYTES = 8 << 20           # text behind the grams of one bucket of subtrees, on average
ROWS = 64                        # packed rows decoded at once
HOT_WORDS = 1 << 20
END_WORD = -1                    # key of the end token
GRAM, WORD, TEXT = 0, 1, 2


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0 (Stirling's series after shifting x above 8)."""
    x = np.asarray(x, float)
    n = np.where(x < 8, np.ceil(8 - x), 0).astype(int)
    shift, y = np.zeros_like(x), x + n
    for k in range(int(n.max(initial=0))):
        shift += np.where(k < n, np.log(x + k), 0)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


_SMALL = 1 << 14
_HALVES, _WHOLES = (log_gamma(np.arange(_SMALL) + x) for x in (0.5, 1.0))


def _log_gamma_of(n: np.ndarray, table: np.ndarray, x: float) -> np.ndarray:
    """ln Gamma(n + x) of counts: small ones from a table."""
    out = table[np.minimum(n, _SMALL - 1)]
    large = np.flatnonzero(n >= _SMALL)
    if len(large):
        out[large] = log_gamma(n[large] + x)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the KT block probability of n0 zeros and n1 ones."""
    return (_log_gamma_of(n0, _HALVES, 0.5) + _log_gamma_of(n1, _HALVES, 0.5) - _log_gamma_of(n0 + n1, _WHOLES, 1.0)
            - np.log(np.pi))


def text_grams(raw: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, gram) of every byte and end byte: the ``depth`` context bytes, nearest first
    from the top of the 64 bits, unused bytes 0, and the byte itself at the bottom.
    The stream holds seven pads, then the texts' bytes and ends with ``depth`` pads between."""
    n, sizes = len(off) - 1, np.diff(off)
    doc = np.repeat(np.arange(n, dtype=np.int32), sizes + 1)
    if not n:
        return doc, np.zeros(0, U)
    stream = np.full(7 + len(raw) + n * (depth + 1), END, np.uint8)
    kind = np.int32 if len(stream) < 1 << 31 else np.int64
    place = np.arange(len(raw), dtype=kind)
    place += np.repeat((np.arange(n) * (depth + 1) + depth + 7).astype(kind), sizes)
    stream[place] = _LOWER[raw]
    eight = np.ndarray((len(stream) - 7,), "<u8", stream, 0, (1,))       # every run of eight bytes
    place = np.arange(len(doc), dtype=kind)
    place += np.repeat((np.arange(n) * depth + depth).astype(kind), sizes + 1)
    eight = eight[place]
    del place, stream
    out = eight << U(8)
    out &= U((1 << 64) - (1 << (64 - 8 * depth)))                         # the nearest ``depth`` context bytes
    eight >>= U(56)
    out |= eight
    return doc, out


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
    return (k[at], *[np.add.reduceat(v[order], at) if len(k) else v for v in values])


def _bits(byte: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The eight (path so far with a leading 1, next bit) of each byte."""
    b = byte.astype(np.int64)
    return [((1 << k) | (b >> (8 - k)), (b >> (7 - k)) & 1) for k in range(8)]


def weighted(key, n0, n1, below) -> tuple:
    """(key, n0, n1, ln Pw, own weight) of nodes above others whose ln Pw sum to ``below``."""
    pe = log_kt(n0, n1)
    pw = np.logaddexp(pe, below) - np.log(2)
    return key, n0, n1, pw, np.exp(pe - np.log(2) - pw)


class Subtrees:
    """Nodes of the depths 3 to ``depth`` over sorted distinct grams (whole subtrees).

    Per depth the distinct (context, byte) pairs in order: a node, a context
    with a path of k bits, is a run of them. ``live`` marks pairs whose shorter context
    was seen twice or more; the others have no nodes of their own."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        self.depth = depth
        self.keys, self.counts, self.parent, self.live = {depth: grams}, {depth: counts}, {}, {}
        byte = U(0xFF)
        for d in range(depth - 1, 1, -1):
            mask = U((1 << 64) - (1 << (64 - 8 * d)))
            self.keys[d], self.parent[d + 1] = np.unique((self.keys[d + 1] & mask) | (self.keys[d + 1] & byte), return_inverse=True)
            self.counts[d] = np.bincount(self.parent[d + 1], weights=self.counts[d + 1], minlength=len(self.keys[d])).astype(np.int64)
        self.live[3] = np.ones(len(self.keys[3]), bool)
        for d in range(3, depth):
            context = self.keys[d] >> U(8)
            at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, int)
            size = np.add.reduceat(self.counts[d], at) if len(at) else np.zeros(0, np.int64)
            twice = np.repeat(size >= 2, np.diff(np.append(at, len(context))))
            self.live[d + 1] = twice[self.parent[d + 1]]
        self.weights = {}
        for d in range(3, depth + 1):       # from here on the live pairs only
            self.keys[d], self.counts[d] = self.keys[d][self.live[d]], self.counts[d][self.live[d]]
        self.up = {d: (np.cumsum(self.live[d - 1]) - 1)[self.parent[d]][self.live[d]] for d in range(4, depth + 1)}

    def _weigh(self) -> None:
        """Weights of the nodes, from the deepest up.

        A context with one byte only (most deep ones) has the same counts on all eight
        bits: ``one[d]`` holds ln Pw and own weight once per such pair. The other pairs are
        ``many[d]``; ``nodes[d, k]`` holds first pair, node of each pair, zeros, ones, ln Pw
        and own weight of their nodes with k bits decided."""
        self.many, self.single, self.one, self.nodes = {}, {}, {}, {}
        for d in range(self.depth, 2, -1):
            key, n = self.keys[d], self.counts[d]
            context = key >> U(8)
            edge = np.concatenate([[True], context[1:] != context[:-1], [True]]) if len(key) else np.zeros(1, bool)
            single = edge[:-1] & edge[1:]
            many = np.flatnonzero(~single)
            self.many[d], self.single[d] = many, np.flatnonzero(single)
            lower, inner = np.zeros(len(key)), np.zeros(len(key), bool)
            if d < self.depth:
                up, own = self.up[d + 1], self.single[d + 1]
                inner[up] = True
                lower = np.bincount(up[own], weights=self.one[d + 1][0][own], minlength=len(key)).astype(float)
            self.one[d] = self._pair(np.zeros(len(key), np.int64), n, inner, lower)
            place = np.cumsum(~single) - 1
            key, n, lower, inner = key[many], n[many], lower[many], inner[many]
            for k in range(8 if len(many) else 0):
                run = key >> U(8 - k)
                fresh = np.concatenate([[True], run[1:] != run[:-1]])
                first, node = np.flatnonzero(fresh), np.cumsum(fresh) - 1
                total = np.add.reduceat(n, first)
                ones = np.add.reduceat(n * ((key >> U(7 - k)) & U(1)).astype(np.int64), first)
                below = np.add.reduceat(lower, first)
                if (d + 1, k) in self.nodes:
                    child = self.nodes[d + 1, k]
                    below += np.bincount(node[place[self.up[d + 1][self.many[d + 1][child[0]]]]], weights=child[4], minlength=len(first))
                self.nodes[d, k] = (first, node, total - ones, ones, *self._pair(total - ones, ones, inner[first], below))

    @staticmethod
    def _pair(n0, n1, inner, below) -> tuple[np.ndarray, np.ndarray]:
        """(ln Pw, own weight) of nodes; those without nodes below (``inner`` false) are leaves."""
        pe = log_kt(n0, n1)
        pw = np.logaddexp(pe, below) - np.log(2)
        return np.where(inner, pw, pe), np.where(inner, np.exp(pe - np.log(2) - pw), 1.0)

    def sums(self) -> tuple[np.ndarray, ...]:
        """(key, zeros, ones, ln Pw) of the depth-2 nodes, summed over the depth-3 nodes below them."""
        self._weigh()
        keys, zeros, ones, pws = [], [], [], []
        for k in range(8):
            own = self.single[3]
            bit = ((self.keys[3][own] >> U(7 - k)) & U(1)).astype(bool)
            n = self.counts[3][own]
            parts = [(own, np.where(bit, 0, n), np.where(bit, n, 0), self.one[3][0][own])]
            if (3, k) in self.nodes:
                first, _, zero, one, pw, _ = self.nodes[3, k]
                parts.append((self.many[3][first], zero, one, pw))
            for at, zero, one, pw in parts:
                gram = self.keys[3][at]
                path = ((gram & U(0xFF)) >> U(8 - k)) | U(1 << k)
                keys.append(_top_context(gram, 2) << U(8) | path)
                zeros.append(zero)
                ones.append(one)
                pws.append(pw)
        return _sum_by(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones), np.concatenate(pws))

    def log2(self, top: Model) -> np.ndarray:
        """log2 probability of every gram's byte after its context.

        From the root on, a pair's probability of its next bit is a + b x (that of the
        longer context), or ``stop`` where the tree ends."""
        self._weigh()
        a, b, stop = top.start(self.keys[2])
        value = None
        for d in range(3, self.depth + 1):
            up = self.parent[3] if d == 3 else self.up[d]
            n, many, byte = self.counts[d], self.many[d], self.keys[d][self.many[d]] & U(0xFF)
            alone, chance = len(many) < len(n), np.ones(len(n))
            of_one, share_of_one, unseen_one = (n + 0.5) / (n + 1.0), self.one[d][1], n == 0
            for k in range(8):
                kt, share, ended = of_one, share_of_one, unseen_one
                if len(many):
                    _, node, zeros, ones, _, own = self.nodes[d, k]
                    total = zeros + ones
                    at = ((ones + 0.5) / (total + 1.0))[node]
                    at = np.where(((byte >> U(7 - k)) & U(1)).astype(bool), at, 1 - at)
                    kt, share, ended = at, own[node], (total == 0)[node] if not total.all() else np.zeros(len(node), bool)
                    if alone:
                        kt, share, ended = (_put(v, many, w) for v, w in zip((of_one, share_of_one, unseen_one), (kt, share, ended)))
                rest = b[k][up]
                step = rest * kt
                head = a[k][up]
                here = head + step
                gone = np.flatnonzero(ended)                 # the tree has ended before
                if len(gone):
                    here[gone] = stop[k][up[gone]]
                chance *= here
                if d < self.depth:
                    a[k], b[k], stop[k] = head + step * share, rest - rest * share, here
                    if len(gone):
                        a[k][gone], b[k][gone] = here[gone], 0
            found = np.log2(chance)
            if value is None:
                value = found
            else:
                value = value[self.parent[d]]
                value[self.live[d]] = found
        return value


def _put(values: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    out = values.copy()
    out[at] = new
    return out


def _top_context(gram: np.ndarray, d: int) -> np.ndarray:
    """The ``d`` nearest context bytes as a number, the nearest lowest (the order of depths 0 to 2)."""
    out = np.zeros(len(gram), U)
    for j in range(d):
        out |= ((gram >> U(56 - 8 * j)) & U(0xFF)) << U(8 * j)
    return out


class Model:
    """Depths 0 to 2: per depth the sorted keys, P(next bit is 1) and own weight of the nodes."""

    def __init__(self, nodes: list):
        self.nodes = nodes

    def start(self, pairs: np.ndarray) -> tuple[list, list, list]:
        """Per bit, arrays a, b and stop of the pairs after the depths 0 to 2 (see ``Subtrees.log2``)."""
        a, b, stop = np.zeros((8, len(pairs))), np.ones((8, len(pairs))), np.full((8, len(pairs)), 0.5)
        for k, (path, bit) in enumerate(_bits(pairs & U(0xFF))):
            for d, (keys, one, own) in enumerate(self.nodes):
                if not len(keys):
                    continue
                key = (_top_context(pairs, d) << U(8)) | path.astype(U)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                here = keys[at] == key
                kt = np.where(bit == 1, one[at], 1 - one[at])
                stop[k] = np.where(here, a[k] + b[k] * kt, stop[k])
                a[k] = np.where(here, a[k] + b[k] * own[at] * kt, stop[k])
                b[k] = np.where(here, b[k] * (1 - own[at]), 0.0)
        return [*a], [*b], [*stop]


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """An integer array in byte planes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=level).compress(planes)


def unpack(body: bytes, dtype: str, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U(0)), level=3)


def unpack_keys(body: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(body, "<u8", n), dtype=U)


def _small(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need (the reader knows it from the length)."""
    top = int(values.max(initial=0))
    return values.astype("<u1" if top < 256 else "<u2" if top < 65536 else "<u8")


def pack_counts(values: np.ndarray) -> bytes:
    small = _small(values)
    return bytes([small.itemsize]) + pack(small)


def unpack_counts(body: bytes, n: int) -> np.ndarray:
    return unpack(body[1:], f"<u{body[0]}", n)


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Subtrees (three nearest context bytes) are dealt whole."""
    return (mix(grams >> U(40)) % U(buckets)).astype(np.int64)


def _dealt(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, its places in order)."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 65536 else bucket, kind="stable")
    b = bucket[order]
    cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else []
    return [(int(b[i]), order[i:j]) for i, j in zip(cut, [*cut[1:], len(b)])] if len(b) else []


PACKED = "kind int, bucket int, base long, docs int, n int, m int, a binary, b binary, c binary, d binary, e binary"
_PACKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("base", pa.int64()), ("docs", pa.int32()), ("n", pa.int32()),
                     ("m", pa.int32()), *((c, pa.binary()) for c in "abcde")])


def _packed(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


class _Held:
    """Distinct keys with counts of a task, handed on packed by bucket."""

    def __init__(self, kind: int, bucket):
        self.kind, self.bucket, self.parts, self.size = kind, bucket, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > HELD:
            self._merge()
            if self.size > HELD // 2:
                yield from self.flush()

    def _merge(self) -> None:
        if self.parts:
            self.parts = [_sum_by(*map(np.concatenate, zip(*self.parts)))]
            self.size = len(self.parts[0][0])

    def flush(self):
        self._merge()
        if self.size:
            yield from _handed_on(self.kind, *self.parts[0], self.bucket)
        self.parts, self.size = [], 0


def _handed_on(kind: int, keys: np.ndarray, counts: np.ndarray, bucket):
    """Distinct sorted keys with counts, packed by bucket."""
    rows = [{"kind": kind, "bucket": b, "n": len(at), "a": pack_keys(keys[at]), "b": pack_counts(counts[at])}
            for b, at in _dealt(bucket(keys))]
    for i in range(0, len(rows), 256):
        yield _packed(rows[i: i + 256], _PACKED)


def _counter(depth: int, buckets: int):
    """The training texts' distinct grams and words with their counts, packed by bucket."""
    def run(batches):
        heard, texts = _Held(WORD, lambda w: (mix(w) % U(buckets)).astype(np.int64)), 0
        for batch in batches:
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            learned = batch.column("text").filter(pa.array(train))
            texts += len(learned)
            for _, _, raw, off in slices(learned, COUNT_BYTES):
                _, g = text_grams(raw, off, depth)
                g.sort()
                yield from _handed_on(GRAM, *_runs(g), lambda g: bucket_of(g, buckets))
                del g
                for part, at in _runs_of_texts(raw, off):
                    _, _, _, h = words(part, at, VISIBLE)
                    yield from heard.add(*_runs(np.sort(h)))
        if texts:
            yield from heard.add(np.array([END_WORD], np.int64).view(U), np.array([texts]))
        yield from heard.flush()
    return run


def _runs_of_texts(raw: np.ndarray, off: np.ndarray):
    """Whole texts of a block in smaller runs (see ``words.slices``)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        yield raw[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and how often each occurs."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[at], np.diff(np.append(at, len(keys)))


def _chunks(grams: np.ndarray):
    """Bounds of runs of whole subtrees of about CHUNK grams."""
    head, i = grams >> U(40), 0
    while i < len(grams):
        j = min(i + CHUNK, len(grams))
        j = int(np.searchsorted(head, head[j - 1], side="right"))
        yield i, j
        i = j


def _by_bucket(batches):
    """(kind, rows) of each bucket of a task; rows come sorted by kind and bucket."""
    now, held = None, []
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):     # a batch may hold a whole task's packed rows: no copy of all of it
            for row in batch.slice(i, ROWS).to_pylist():
                if (row["kind"], row["bucket"]) != now:
                    if held:
                        yield now[0], held
                    now, held = (row["kind"], row["bucket"]), []
                held.append(row)
    if held:
        yield now[0], held


def _summer(depth: int):
    """kind GRAM: sums below the depth-2 nodes (key, n0, n1, lp); kind WORD: (key, n0) of each word."""
    def run(batches):
        for kind, rows in _by_bucket(batches):
            keys, counts = _sum_by(np.concatenate([unpack_keys(r["a"], r["n"]) for r in rows]),
                                   np.concatenate([unpack_counts(r["b"], r["n"]).astype(np.int64) for r in rows]))
            if kind == WORD:
                yield _rows(WORD, keys, counts, np.zeros(len(keys), np.int64), np.zeros(len(keys)))
                continue
            for i, j in _chunks(keys):
                yield _rows(GRAM, *Subtrees(keys[i:j], counts[i:j], depth).sums())
    return run


def _rows(kind: int, key, n0, n1, lp) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(n0),
                                       pa.array(n1), pa.array(lp)], ["kind", "key", "n0", "n1", "lp"])


def _met(packed: DataFrame, buckets: int) -> DataFrame:
    """Packed rows in tasks that take their buckets one after the other: memory follows a
    bucket, and a document gets one sum from each task, so tasks follow the cluster and not
    the data (with one task a bucket the sums would grow with its square)."""
    tasks = min(buckets, 6 * packed.sparkSession.sparkContext.defaultParallelism)
    return packed.repartitionById(tasks, F.pmod("bucket", F.lit(tasks))).sortWithinPartitions("kind", "bucket")


def n_buckets(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))


def corpus_counts(marked: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Of the training texts (held_out, text): kind GRAM (key, n0, n1, lp) per depth-2 node (parts to be summed),
    kind WORD (key, n0)."""
    packed = marked.select("held_out", "text").mapInArrow(tidy(_counter(depth, buckets)), PACKED)
    sums = _met(packed, buckets).mapInArrow(tidy(_summer(depth)), "kind int, key long, n0 long, n1 long, lp double")
    return materialise(sums, "ctw-counts", "zstd")    # a word is in one bucket; a depth-2 node may be in several


def top_of(key: np.ndarray, n0: np.ndarray, n1: np.ndarray, lp: np.ndarray) -> Model:
    """Depths 0 to 2 (at most 65,793 contexts) from the sums below the depth-2 nodes."""
    order = np.argsort(key)
    levels = {2: weighted(key[order], n0[order], n1[order], lp[order])}
    key, n0, n1, pw, _ = levels[2]
    for d, mask in ((1, 0xFFFF), (0, 0xFF)):
        levels[d] = weighted(*_sum_by(key & U(mask), n0, n1, pw))
        key, n0, n1, pw, _ = levels[d]
    return Model([(v[0], (v[2] + 0.5) / (v[1] + v[2] + 1.0), v[4]) for _, v in sorted(levels.items())])


def top_model(counts: DataFrame) -> Model:
    made = counts.filter(F.col("kind") == GRAM).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "lp")]).toArrow()
    key, n0, n1, lp = (made.column(c).to_numpy() for c in ("key", "n0", "n1", "lp"))
    return top_of(key.view(U), n0, n1, lp)


def _lister(depth: int, buckets: int, hot, arrow: pa.Schema):
    """Packed grams, and packed words that are not hot, with the documents they occur in, by
    bucket; and one row per document (kind TEXT: its number and word counts)."""
    def run(batches):
        pid, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for i, j, raw, off in slices(batch.column("text"), BLOCK_BYTES):
                for a in range(i, j, BLOCK_DOCS):
                    b = min(a + BLOCK_DOCS, j)
                    part, at = raw[off[a - i]: off[b - i]], off[a - i: b - i + 1] - off[a - i]
                    base = (pid << 33) + seq
                    seq += b - a
                    yield from _postings(part, at, train[a:b], base, depth, buckets, arrow)
                    yield from _texts(part, at, batch.slice(a, b - a), train[a:b], base, hot, buckets, arrow)
    return run


def _postings(raw, off, train, base: int, depth: int, buckets: int, arrow: pa.Schema):
    doc, g = text_grams(raw, off, depth)
    order = np.argsort(g)
    g, doc = g[order], doc[order]
    del order
    fresh = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, bool)
    grams = g[fresh]
    np.cumsum(fresh, out=g)                                # from here on: number of the gram, then its document
    g -= U(1)
    g <<= U(16)
    g |= doc.astype(np.uint16)
    g.sort()
    pair, times = _runs(g)
    del g, doc, fresh
    of, who = (pair >> U(16)).astype(np.int32), (pair & U(0xFFFF)).astype("<u2")
    del pair
    yield from _posted(GRAM, grams, np.bincount(of, minlength=len(grams)), who, times, bucket_of(grams, buckets), base, train, arrow)


def _posted(kind: int, keys, per, who, times, bucket, base: int, train, arrow: pa.Schema):
    """Packed rows by bucket: sorted distinct keys, ``per`` places of each, and every place's document and times."""
    first = np.cumsum(per) - per
    flags, rows = np.packbits(train).tobytes(), []
    for b, at in _dealt(bucket):
        size = per[at]
        places = np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        rows.append({"kind": kind, "bucket": b, "base": base, "docs": len(train), "n": len(at), "m": len(places),
                     "a": pack_keys(keys[at]), "b": pack_counts(size), "c": pack(who[places]), "d": pack_counts(times[places]), "e": flags})
        if len(rows) == 256:
            yield _packed(rows, arrow)
            rows = []
    if rows:
        yield _packed(rows, arrow)


def _texts(raw, off, own: pa.RecordBatch, train, base: int, hot, buckets: int, arrow: pa.Schema):
    """The words that are not hot, packed by bucket with the documents they occur in; and the documents' rows."""
    keys, seen = hot.value
    each, n = np.log10(seen + 1.0), len(off) - 1
    _, _, doc, h = words(raw, off, VISIBLE)
    total = np.bincount(doc, minlength=n) + 1
    d, x, c = counted(doc, h)
    d, x, c = np.append(d, np.arange(n)), np.append(x, np.full(n, END_WORD, np.int64).view(U)), np.append(c, np.ones(n, int))
    if len(keys):
        at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        hit = keys[at] == x
        known = np.bincount(d[hit], weights=c[hit], minlength=n)
        base_score = np.bincount(d[hit], weights=c[hit] * each[at[hit]], minlength=n)
    else:
        hit, known, base_score = np.zeros(len(d), bool), np.zeros(n), np.zeros(n)
    d, x, c = d[~hit], x[~hit], c[~hit]
    order = np.lexsort((d, x))
    rare, per = _runs(x[order])
    yield from _posted(WORD, rare, per, d[order].astype("<u2"), c[order].astype(np.int64), (mix(rare) % U(buckets)).astype(np.int64),
                       base, train, arrow)
    rid = np.arange(n) + base
    made = {"rid": pa.array(rid), "n_tokens": pa.array(total), "known": pa.array(known.astype(np.int64)), "base": pa.array(base_score),
            "n_bytes": pa.array(np.diff(off) + 1)}
    kind = arrow.field("doc").type
    fields = [kind.field(i) for i in range(kind.num_fields)]
    struct = pa.StructArray.from_arrays([(made[f.name] if f.name in made else own.column(f.name)).cast(f.type) for f in fields], fields=fields)
    cols = {"kind": pa.array(np.full(n, TEXT, np.int32)), "bucket": pa.array((rid % buckets).astype(np.int32)), "doc": struct}
    yield pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(n, f.type) for f in arrow], schema=arrow)


def _scorer(depth: int, top, arrow: pa.Schema):
    """(rid, lp, known, more): a task's share of every document's log2 probability, and of the count
    and score of its words that are not hot; documents' own rows pass through."""
    def row(rid, lp=None, known=None, more=None) -> pa.RecordBatch:
        made = {"rid": rid, "lp": lp, "known": known, "more": more}
        return pa.RecordBatch.from_arrays([pa.nulls(len(rid), f.type) if made.get(f.name) is None else pa.array(made[f.name], f.type)
                                           for f in arrow], schema=arrow)

    def sums(kind, shares):
        for base, share in shares.items():
            if kind == GRAM:
                yield row(np.arange(share.shape[1]) + base, lp=share[0])
            else:
                at = np.flatnonzero(share[0])
                yield row(at + base, known=share[0][at].astype(np.int64), more=share[1][at])

    def add(kind, rows, shares):
        keys = [unpack_keys(r["a"], r["n"]) for r in rows]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        place = place.astype(np.int32)
        count, posted, at = np.zeros(len(distinct), np.int64), [], 0
        for r in rows:
            own = np.repeat(place[at: at + r["n"]], unpack_counts(r["b"], r["n"]))
            at += r["n"]
            who, times = unpack(r["c"], "<u2", r["m"]), unpack_counts(r["d"], r["m"])
            train = np.unpackbits(np.frombuffer(r["e"], np.uint8), count=r["docs"]).astype(bool)
            count += np.bincount(own, weights=times * train[who], minlength=len(distinct)).astype(np.int64)
            posted.append((r["base"], r["docs"], own, who, times))
        if kind == GRAM:
            values = [np.concatenate([Subtrees(distinct[i:j], count[i:j], depth).log2(top.value) for i, j in _chunks(distinct)])]
        else:                                              # every occurrence of the word stands in this bucket
            values = [(count > 0).astype(float), np.log10(count + 1.0)]
        for base, docs, own, who, times in posted:
            share = np.stack([np.bincount(who, weights=v[own] * times, minlength=docs) for v in values])
            shares[base] = shares[base] + share if base in shares else share

    def run(batches):
        shares, now = {}, GRAM

        def packed():
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS):
                    b = batch.slice(i, ROWS)
                    text = pc.equal(b.column("kind"), TEXT)
                    documents = b.filter(text)
                    if documents.num_rows:
                        through.append(documents.column("doc"))
                    yield b.filter(pc.invert(text)).select(_PACKED.names)
        through = []
        for kind, rows in _by_bucket(packed()):
            if kind != now or sum(s.size for s in shares.values()) > HELD:
                yield from sums(now, shares)
                shares, now = {}, kind
            add(kind, rows, shares)
        yield from sums(now, shares)
        for doc in through:
            n = len(doc)
            yield pa.RecordBatch.from_arrays([doc.cast(f.type) if f.name == "doc" else pa.nulls(n, f.type) for f in arrow], schema=arrow)
    return run


def log_scores(docs: DataFrame, depth: int = DEPTH, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, n_bytes (scored symbols) and code_bits (bits per byte)."""
    spark = docs.sparkSession
    marked = docs.select("doc_id", held_out(FOLDS).alias("held_out"), F.col("text").cast("string").alias("text"))
    buckets = n_buckets(docs)
    counts = corpus_counts(marked, depth, buckets)
    vocabulary = counts.filter(F.col("kind") == WORD).select("key", F.col("n0").alias("n"))
    size = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, v_train = size["n"] or 0, size["v"]
    top = vocabulary.orderBy(F.desc("n"), "key").limit(hot_words).toArrow()
    key, n = top.column("key").to_numpy().view(U), top.column("n").to_numpy()
    order = np.argsort(key)
    hot = spark.sparkContext.broadcast((key[order], n[order]))
    model = spark.sparkContext.broadcast(top_model(counts))
    drop_scratch(spark, counts)
    release_shuffles(spark)                  # the first pass's grams are not read again

    doc_type = T.StructType([T.StructField("rid", T.LongType()), marked.schema["doc_id"], *T.StructType.fromDDL(
        "held_out boolean, n_bytes long, n_tokens long, known long, base double")])
    arrow_doc = pa.struct([("rid", pa.int64()), docs.limit(0).toArrow().schema.field("doc_id"), ("held_out", pa.bool_()),
                           ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64())])
    packed = marked.mapInArrow(tidy(_lister(depth, buckets, hot, _PACKED.append(pa.field("doc", arrow_doc)))),
                               T.StructType([*T.StructType.fromDDL(PACKED), T.StructField("doc", doc_type)]))
    out = pa.schema([("rid", pa.int64()), ("lp", pa.float64()), ("known", pa.int64()), ("more", pa.float64()), ("doc", arrow_doc)])
    shares = materialise(_met(packed, buckets).mapInArrow(
        tidy(_scorer(depth, model, out)),
        T.StructType([*T.StructType.fromDDL("rid long, lp double, known long, more double"), T.StructField("doc", doc_type)])), "ctw-shares", "zstd")
    release_shuffles(spark)                  # nor are the second's
    texts = shares.filter("rid IS NULL").select("doc.*")
    scores = shares.filter("rid IS NOT NULL").groupBy("rid").agg(
        (F.sum("lp") * F.lit(float(np.log10(2)))).alias("score"), F.sum("known").alias("more"), F.sum("more").alias("more_base"))
    each = float(np.log10(n_train + v_train + 1))
    return texts.join(scores, "rid").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        "score", "n_bytes", (-F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("code_bits"))
