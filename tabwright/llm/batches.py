"""Arrow batches inside tasks: whole texts as words, and row slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at a time inside a task. A single longer text is still worked on whole.
SLICE_BYTES = 12_000_000


def texts_of(column: pa.Array) -> pa.Array:
    """The column as large strings; null becomes the empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row slices whose texts together hold about ``limit`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the machine: Python workers live on between tasks and share it with their executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    _TRIM = None


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between runs of ASCII white space: row offsets, a code for each word, and the distinct words."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    kept = np.concatenate(([0], np.cumsum(full)))
    offsets = lists.offsets.to_numpy()
    offsets = kept[offsets - offsets[0]] if len(offsets) else np.zeros(1, np.int64)
    coded = (flat if full.all() else flat.filter(pa.array(full))).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return offsets, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def binary_column(buffer: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array of the slices of ``buffer`` between byte offsets."""
    values = pa.py_buffer(np.ascontiguousarray(buffer).view(np.uint8))
    bounds = pa.py_buffer(offsets.astype(np.int64))
    wide = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, bounds, values])
    return wide.cast(pa.binary())


def mapped_bytes(texts: pa.Array, table: bytes) -> pa.Array:
    """Large strings with every byte looked up in a table of 256; the table must keep UTF-8 valid and lengths as they are."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = data[bounds[0]:bounds[-1]].to_pybytes().translate(table) if data is not None else b""
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(bounds - bounds[0]), pa.py_buffer(raw)])


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# letters a-z, digits and everything beyond ASCII stay; all other bytes become spaces
WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
