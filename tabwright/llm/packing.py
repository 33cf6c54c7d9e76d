"""Sum-of-squares online packing of documents into fixed windows of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabwright.llm.batches import slices, texts_of
from tabwright.llm.tokens import encoder, with_end

PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
Piece = tuple[int | None, int, np.ndarray, int]  # document, start in it, ids, tokens of the document


class Packer:
    """Windows of ``capacity`` tokens.

    ``counts[h]`` is the number of open windows filled to h. A piece goes to the level (or a new window) that makes
    the sum of squared counts smallest; of equal ones the fullest is taken. Full windows count zero and leave.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece of fewer than ``capacity`` tokens somewhere; the window if that fills it."""
        size, counts = len(piece[2]), self.counts
        room = self.capacity - size
        below = counts[1:room + 1]
        levels = np.flatnonzero(below) + 1
        best, change = 0, 2 * counts[size] + 1
        if len(levels):
            changes = 2 - 2 * counts[levels] + 2 * counts[levels + size]
            if levels[-1] == room:
                changes[-1] = 1 - 2 * counts[room]
            k = len(levels) - 1 - int(np.argmin(changes[::-1]))
            if changes[k] <= change:
                best = int(levels[k])
        if best:
            window = self.open[best].pop()
            counts[best] -= 1
        else:
            window = []
        window.append(piece)
        if best + size == self.capacity:
            return window
        counts[best + size] += 1
        self.open.setdefault(best + size, []).append(window)
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Empty the level array: the emptiest windows are cut up to fill the fullest ones.

        The tokens that are left fill less than one window; they become sequences whose lengths are powers of two.
        """
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open, self.counts = {}, np.zeros(self.capacity + 1, np.int64)
        left, right, spare = 0, len(windows), []
        while left < right:
            window, left = windows[left], left + 1
            need = self.capacity - sum(len(p[2]) for p in window)
            while need and (spare or left < right):
                if not spare:
                    right -= 1
                    spare = windows[right]
                doc, start, ids, total = spare.pop()
                cut = max(0, len(ids) - need)
                if cut:
                    spare.append((doc, start, ids[:cut], total))
                window.append((doc, start + cut, ids[cut:], total))
                need -= len(ids) - cut
            if need:
                spare = window
                break
            yield window
        rest = sum(len(p[2]) for p in spare)
        while rest:
            need = 1 << (rest.bit_length() - 1)
            rest -= need
            window = []
            while need:
                doc, start, ids, total = spare.pop()
                cut = max(0, len(ids) - need)
                if cut:
                    spare.append((doc, start, ids[:cut], total))
                window.append((doc, start + cut, ids[cut:], total))
                need -= len(ids) - cut
            yield window


def _rows(windows: list[list[Piece]], first: int) -> pa.RecordBatch:
    flat = [(p, first + k) for k, w in enumerate(windows) for p in w]
    offsets = [o for w in windows for o in np.concatenate(([0], np.cumsum([len(p[2]) for p in w])))[:-1]]
    return pa.RecordBatch.from_arrays([
        pa.array([p[0] for p, _ in flat], pa.int64()), pa.array([p[1] for p, _ in flat], pa.int64()),
        pa.array([len(p[2]) for p, _ in flat], pa.int64()),
        pa.array([p[2].astype("<u4").tobytes() for p, _ in flat], pa.binary()),
        pa.array([p[3] for p, _ in flat], pa.int64()), pa.array([s for _, s in flat], pa.int64()),
        pa.array(offsets, pa.int64()),
    ], schema=PIECE)


def pack_documents(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
    capacity: int = 2048,
) -> DataFrame:
    """Pieces of sequences of ``capacity`` tokens: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.

    Each document is its ids and ``end_id``. Whole windows of a long document are sequences of their own; its rest is
    placed online by the sum-of-squares rule. Every partition packs its rows in order, without a shuffle, and closes
    its open windows at the end, so no sequence needs padding: all have ``capacity`` tokens, but for at most
    log2(capacity) of each partition, whose lengths are powers of two. A sequence id holds the partition in its upper
    bits. A null or empty text is ``end_id`` alone; repeated rows are packed as often as they come; a null id stays
    null; an empty table gives no rows; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encode = Packer(capacity), encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 32
        for batch in (s for b in batches for s in slices(b, 1)):
            offsets, ids = with_end(*encode.encode(texts_of(batch.column(1))), end_id)
            full = []
            for doc, lo, hi in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                start = lo
                while hi - start >= capacity:
                    full.append([(doc, start - lo, ids[start:start + capacity], hi - lo)])
                    start += capacity
                if start < hi and (done := packer.place((doc, start - lo, ids[start:hi].copy(), hi - lo))):
                    full.append(done)
            yield _rows(full, sequence)
            sequence += len(full)
        rest = list(packer.close())
        yield _rows(rest, sequence)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        work, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
