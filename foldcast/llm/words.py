"""Batch helpers for Arrow code inside tasks: bounded chunks and whole-batch word splitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of a batch whose texts stay near ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if len(sizes) == 0:
        return
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, len(sizes)]):
        yield batch.slice(int(a), int(b - a))


def text_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of a batch, NULL as empty."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split(texts: pa.Array, ascii_space: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts and the offset of each text's first word (one more at the end).

    Words are the runs between ``[\\x20\\x09-\\x0D]``, or between any Unicode white space.
    """
    cut = pc.ascii_split_whitespace(texts) if ascii_space else pc.utf8_split_whitespace(texts)
    words = cut.flatten()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])
    full = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), kept[ends.astype(np.int64)].astype(np.int64)


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each word in the list of different words, and that list."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text number of every word."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
