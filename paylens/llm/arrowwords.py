"""Words of text batches by Arrow kernels: ascii_lower, split_pattern_regex, list_flatten, dictionary_encode."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: what separates words of letters, digits and non-ASCII characters
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: what separates words of letters and non-ASCII characters
NOT_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SLICE_BYTES = 4 << 20


def text_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about ``limit`` bytes of text (column ``text``, null as empty)."""
    texts = batch.column("text").cast(pa.large_string()).fill_null("")
    at = batch.schema.get_field_index("text")
    batch = batch.set_column(at, "text", texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    i, done = 0, 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(i, j - i)
        i, done = j, int(ends[j - 1])


def encoded_words(texts: pa.Array, separator: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text index, dictionary index) of every word in order, and the dictionary.
    Only A-Z are lower-cased."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=separator)
    flat = pc.list_flatten(lists)
    of = pc.list_parent_indices(lists).to_numpy()
    coded = flat.dictionary_encode()
    index, words = coded.indices.to_numpy(), coded.dictionary
    blank = pc.index(words, pa.scalar("", words.type)).as_py()   # before a first and after a last separator
    if blank >= 0:
        keep = index != blank
        of, index = of[keep], index[keep]
    return of, index, words
