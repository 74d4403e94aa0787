"""Vectorised tokenising and hashing of text batches (numpy, inside tasks).

A batch is one flat byte buffer plus document offsets. Words are hashed
with a polynomial over their bytes (prefix sums modulo 2^64, an odd base
has an inverse), finished with a 64-bit mixer, so no Python loop runs per
word. Two different words share a hash with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20          # documents are processed in slices of about this size
_BASE = 0x9E3779B97F4A7C15 | 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: letters, digits and every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: everything but white space (space, tab .. carriage return)
VISIBLE = np.ones(256, bool)
VISIBLE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit integers."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n (or more) of the base and of its inverse. A worker keeps those of a
    usual slice; a longer text's are made for it and given back."""
    def made(n: int) -> list[np.ndarray]:
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            f = np.full(n + 1, b, U)
            f[0] = 1
            out.append(np.cumprod(f))
        return out
    if n > SLICE_BYTES:
        return tuple(made(n))
    if not _POWERS or len(_POWERS[0]) <= n:
        _POWERS[:] = made(min(SLICE_BYTES, 2 * n))
    return _POWERS[0], _POWERS[1]


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def slices(texts, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole documents."""
    raw, off = flat(texts)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, raw[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


def words(raw: np.ndarray, off: np.ndarray, alphabet: np.ndarray = ALNUM):
    """(start, end, document index, hash) of every word; A-Z count as a-z."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U)
    is_word = alphabet[raw]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, is_word[:-1]
    after[-1], after[:-1] = False, is_word[1:]
    inner = off[1:-1]
    before[inner[inner < n]] = False
    after[inner[(inner > 0)] - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, U)
    np.cumsum((_LOWER[raw].astype(U) + U(1)) * up[:n], out=sums[1:])
    h = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))
    doc = np.searchsorted(off, start, side="right") - 1
    return start, end, doc, h


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, A-Z as a-z."""
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum((_LOWER[raw].astype(U) + U(1)) * up[:len(raw)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def shingles(doc: np.ndarray, h: np.ndarray, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every run of ``size`` words, repeats included.
    A document of fewer words, but not none, has the one shingle of all its words."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)])
    m = max(0, n - size + 1)
    acc = np.zeros(m, U)
    for j in range(size):
        acc = (acc + h[j: m + j]) * U(0xC2B2AE3D27D4EB4F | 1)
    ok = doc[:m] == doc[size - 1: size - 1 + m]
    out_doc, out_h = doc[:m][ok], mix(acc[ok])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        acc = np.full(len(short), 0xA5A5A5A5, U)
        for j in range(size - 1):
            has = count[short] > j
            acc[has] = (acc[has] + h[first[short[has]] + j]) * U(0xC2B2AE3D27D4EB4F | 1)
        out_doc, out_h = np.concatenate([out_doc, short]), np.concatenate([out_h, mix(acc ^ count[short].astype(U))])
        order = np.argsort(out_doc, kind="stable")
        out_doc, out_h = out_doc[order], out_h[order]
    return out_doc, out_h


def counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, in order, with their counts."""
    if len(h) == 0:
        return doc, h, np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])])
    at = np.flatnonzero(new)
    return d[at], x[at], np.diff(np.concatenate([at, [len(d)]]))
