"""Word shingles of Arrow batches as 64-bit values, whole columns at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Odd factors that tell the places in a shingle apart, and a finaliser that spreads the sum.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
SPREAD = np.uint64(0xFF51AFD7ED558CCD)
# Rows of a batch that are taken at once hold so many bytes of text, about.
PIECE_BYTES = 1_000_000


def pieces(batch: pa.RecordBatch, column: str | int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PIECE_BYTES of text, so that long texts do not make large arrays."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // PIECE_BYTES
    starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()]
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def word_values(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a string column, and the word count of each row.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; null has none.
    """
    texts = pa.concat_arrays([pc.fill_null(texts, "")])  # no slice: kernels may misread those
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, rows = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    values = known[coded.indices.to_numpy()][real] if len(known) else np.zeros(0, np.uint64)
    return values, np.bincount(rows[real], minlength=len(lists))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word shingles of each row, sorted: all values in a row, and the offsets of the rows.

    A row with fewer words has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_values(texts)
    starts = np.concatenate([[0], np.cumsum(counts)])
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(offsets[-1]) - offsets[:-1][row] + starts[:-1][row]
    length = np.minimum(counts[row], k)
    values = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for place in range(k):
            there = place < length
            word = words[np.minimum(at + place, max(len(words) - 1, 0))] if len(words) else words
            values += np.where(there, word * FACTORS[place], np.uint64(0))
        values ^= values >> np.uint64(33)
        values *= SPREAD
        values ^= values >> np.uint64(29)
    # sort by row and value: rows are in order already, so sort each row's stretch as one key pair
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[first], row[first]
    return values, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(counts)))])
