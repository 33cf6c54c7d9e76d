"""Token-id files: a static range asymmetric numeral system over one shared frequency table.

A block of up to 65,536 ids is coded on its own by 32 interleaved states of 32 bits that give off 16-bit words. Every
512 steps the states and the place in the words are kept, so a block can be decoded from any of these checkpoints; the
decoder runs the segments of many blocks side by side. Blocks, the document list and the table carry checksums.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.functions.state import scratch_path
from tabwright.llm import shared_files
from tabwright.llm.batches import binary_column, slices, texts_of
from tabwright.llm.tokens import encoder, with_end

LANES, SEGMENT, BLOCK_STEPS = 32, 512, 2048
BLOCK = LANES * BLOCK_STEPS
SCALE_BITS = 16
SCALE = 1 << SCALE_BITS
LOWEST = 1 << 16
TOGETHER = 48  # blocks coded side by side
MAGIC = b"TOKRANS1"
BLOCK_HEAD = struct.Struct("<IIIH")  # ids, checksum of the ids, words, checkpoints
FOOTER = struct.Struct("<QQQQIII8s")  # place of documents, of index; documents, ids, blocks, table and list checksums


@dataclass(frozen=True)
class Table:
    """Frequencies that sum to 65,536: at least 1 for every id that occurs."""

    freq: np.ndarray

    @staticmethod
    def of_counts(counts: np.ndarray) -> Table:
        seen = counts > 0
        if seen.sum() > SCALE:
            raise ValueError(f"more than {SCALE} different ids")
        total = max(1, int(counts.sum()))
        freq = np.where(seen, np.maximum(1, np.floor(counts.astype(np.float64) * SCALE / total)), 0).astype(np.int64)
        while seen.any() and (over := int(freq.sum()) - SCALE):
            k = int(np.argmax(freq))
            freq[k] -= min(over, max(1, freq[k] // 8)) if over > 0 else over
        return Table(freq)

    def dump(self) -> bytes:
        ids = np.flatnonzero(self.freq)
        body = struct.pack("<II", len(self.freq), len(ids)) + ids.astype("<u4").tobytes() + self.freq[ids].astype("<u4").tobytes()
        return MAGIC + body + struct.pack("<I", zlib.crc32(body))

    @staticmethod
    def load(raw: bytes) -> Table:
        body = raw[len(MAGIC):-4]
        if raw[:len(MAGIC)] != MAGIC or zlib.crc32(body) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("damaged frequency table")
        size, n = struct.unpack_from("<II", body)
        freq = np.zeros(size, np.int64)
        freq[np.frombuffer(body, "<u4", n, 8)] = np.frombuffer(body, "<u4", n, 8 + 4 * n)
        return Table(freq)

    @property
    def checksum(self) -> int:
        return zlib.crc32(self.dump())

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Frequency and lower bound of each id, and the id of each of the 65,536 slots."""
        freq = self.freq.astype(np.uint64)
        return freq, np.cumsum(freq) - freq, np.repeat(np.arange(len(freq), dtype=np.uint32), self.freq)


def _encode(ids: np.ndarray, steps: int, table: Table) -> list[bytes]:
    """Blocks of ``steps * LANES`` ids each, side by side."""
    freq, low, _ = table.arrays()
    rows = len(ids) // (steps * LANES)
    symbols = ids.reshape(rows, steps, LANES)
    state = np.full((rows, LANES), LOWEST, np.uint64)
    words = np.zeros((rows, steps, LANES), np.uint16)
    gives = np.zeros((rows, steps, LANES), bool)
    marks = -(-steps // SEGMENT)
    states = np.zeros((rows, marks, LANES), "<u4")
    sixteen, mask = np.uint64(16), np.uint64(0xFFFF)
    for step in range(steps - 1, -1, -1):
        s = symbols[:, step]
        f, c = freq[s], low[s]
        full = state >= (f << sixteen)
        words[:, step] = state & mask
        gives[:, step] = full
        state = np.where(full, state >> sixteen, state)
        quotient = state // f
        state = (quotient << sixteen) + (state - quotient * f) + c
        if step % SEGMENT == 0:
            states[:, step // SEGMENT] = state
    out = []
    for r in range(rows):
        given = gives[r].sum(axis=1)
        before = (np.cumsum(given) - given)[::SEGMENT].astype("<u4")
        own = words[r][gives[r]].astype("<u2")
        out.append((before, states[r], own))
    return [b"".join((BLOCK_HEAD.pack(steps * LANES, 0, len(w), marks), b.tobytes(), s.tobytes(), w.tobytes())) for b, s, w in out]


def encode_blocks(ids: np.ndarray, table: Table) -> list[bytes]:
    """Independent blocks of the ids. The last one is filled up with the commonest id; its head has the true count."""
    blocks: list[bytes] = []
    whole = len(ids) // BLOCK * BLOCK
    for start in range(0, whole, BLOCK * TOGETHER):
        blocks += _encode(ids[start:min(whole, start + BLOCK * TOGETHER)], BLOCK_STEPS, table)
    if whole < len(ids):
        steps = -(-(len(ids) - whole) // LANES)
        padded = np.full(steps * LANES, int(np.argmax(table.freq)), ids.dtype)
        padded[:len(ids) - whole] = ids[whole:]
        blocks += _encode(padded, steps, table)
    done = []
    for k, block in enumerate(blocks):
        own = ids[k * BLOCK:(k + 1) * BLOCK]
        _, _, words, marks = BLOCK_HEAD.unpack_from(block)
        done.append(BLOCK_HEAD.pack(len(own), zlib.crc32(own.astype("<u4").tobytes()), words, marks) + block[BLOCK_HEAD.size:])
    return done


def decode_blocks(blocks: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each block: all segments of all blocks advance together, from their checkpoints."""
    freq, low, slots = table.arrays()
    heads, pieces, starts, states, steps, base = [], [], [], [], [], 0
    for block in blocks:
        count, check, words, marks = BLOCK_HEAD.unpack_from(block)
        place = BLOCK_HEAD.size
        starts.append(base + np.frombuffer(block, "<u4", marks, place).astype(np.int64))
        states.append(np.frombuffer(block, "<u4", marks * LANES, place + 4 * marks).reshape(marks, LANES))
        pieces.append(np.frombuffer(block, "<u2", words, place + 4 * marks * (1 + LANES)))
        total = -(-count // LANES)
        steps.append(np.minimum(SEGMENT, total - SEGMENT * np.arange(marks)))
        heads.append((count, check, marks))
        base += words
    words = np.concatenate([*pieces, np.zeros(1, np.uint16)]).astype(np.uint64)
    all_steps = np.concatenate(steps)
    order = np.argsort(-all_steps, kind="stable")
    at, state, left = np.concatenate(starts)[order], np.concatenate(states)[order].astype(np.uint64), all_steps[order]
    out = np.zeros((len(order), int(left[0]), LANES), np.uint32)
    sixteen, mask = np.uint64(16), np.uint64(0xFFFF)
    for step in range(int(left[0])):
        n = int(np.searchsorted(-left, -step))  # segments with more than ``step`` steps
        x = state[:n]
        slot = x & mask
        s = slots[slot]
        out[:n, step] = s
        x = freq[s] * (x >> sixteen) + slot - low[s]
        short = x < LOWEST
        taken = np.cumsum(short, axis=1)
        x = np.where(short, (x << sixteen) | words[np.minimum(at[:n, None] + taken - 1, len(words) - 1)], x)
        state[:n] = x
        at[:n] += taken[:, -1]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    ids, first = [], 0
    for count, check, marks in heads:
        own = np.concatenate([out[back[k], :all_steps[k]].ravel() for k in range(first, first + marks)])[:count]
        if zlib.crc32(own.astype("<u4").tobytes()) != check:
            raise ValueError("damaged block")
        ids.append(own)
        first += marks
    return ids


class FileWriter:
    """Collects documents and gives the bytes of a file of blocks."""

    def __init__(self, table: Table):
        self.table, self.blocks, self.waiting, self.held = table, [], [], 0
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK * TOGETHER:
            self._code(self.held // BLOCK * BLOCK)

    def _code(self, count: int) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        self.blocks += encode_blocks(ids[:count], self.table)
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def finish(self) -> bytes:
        self._code(self.held)
        places = np.cumsum([len(MAGIC), *map(len, self.blocks)]).astype("<u8")
        known = np.array([d is not None for d, _ in self.docs], np.uint8).tobytes()
        ids = np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
        lengths = np.array([n for _, n in self.docs], "<u8").tobytes()
        listed, index = known + ids + lengths, places.tobytes()
        foot = FOOTER.pack(int(places[-1]), int(places[-1]) + len(listed), len(self.docs), sum(n for _, n in self.docs),
                           len(self.blocks), self.table.checksum, zlib.crc32(listed + index), MAGIC)
        return b"".join([MAGIC, *self.blocks, listed, index, foot])


def read_file(raw: bytes, table: Table) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Documents in turn, some at a time: their ids, their lengths, and all their token ids."""
    docs_at, index_at, n, _, n_blocks, table_sum, check, magic = FOOTER.unpack(raw[-FOOTER.size:])
    listed, index = raw[docs_at:index_at], raw[index_at:-FOOTER.size]
    if magic != MAGIC or raw[:len(MAGIC)] != MAGIC or zlib.crc32(listed + index) != check or table_sum != table.checksum:
        raise ValueError("damaged token file, or another frequency table")
    known, ids = np.frombuffer(listed, np.uint8, n), np.frombuffer(listed, "<i8", n, n)
    lengths = np.frombuffer(listed, "<u8", n, 9 * n).astype(np.int64)
    ends, places = np.cumsum(lengths), np.frombuffer(index, "<u8", n_blocks + 1)
    held, have, given, first = np.zeros(0, np.uint32), 0, 0, 0
    for k in range(0, n_blocks, TOGETHER):
        blocks = [raw[places[b]:places[b + 1]] for b in range(k, min(n_blocks, k + TOGETHER))]
        held = np.concatenate([held, *decode_blocks(blocks, table)])
        have = given + len(held)
        last = int(np.searchsorted(ends, have, side="right"))
        if last > first:
            size = int(ends[last - 1]) - given
            yield [int(i) if b else None for b, i in zip(known[first:last], ids[first:last])], lengths[first:last], held[:size]
            held, given, first = held[size:], given + size, last


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, *, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 2, ids_per_file: int = 8_000_000,
) -> str:
    """Write token files in ascending document order; the folder (a fresh one in the shared folder by default).

    ``folder`` gets ``table.bin``, ``files`` (the token files) and ``manifest`` (Parquet: file, first, docs, ids). Texts
    are tokenized once into a staged table; ids are counted over all of it (at most one row per id of the vocabulary
    reaches the driver); then rows are dealt by document id, with a hash of the ids splitting equal document ids, and
    each task codes its range into one file. Files are moved into place whole, so repeated attempts do no harm.
    A null or empty text is ``end_id`` alone; null ids come first and stay null; repeated rows are all written; an empty
    table gives an empty manifest; other columns are not read.
    """
    spark = docs.sparkSession
    folder = (folder or scratch_path(spark, "tokens")).rstrip("/")
    files = f"{folder}/files"

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in (s for b in batches for s in slices(b, 1)):
            offsets, ids = with_end(*encode.encode(texts_of(batch.column(1))), end_id)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), binary_column(ids.astype("<u2") if ids.max(initial=0) < SCALE
                 else ids.astype("<u4"), offsets * (2 if ids.max(initial=0) < SCALE else 4))], names=["doc_id", "n", "ids"])

    docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        tokenized, "doc_id long, n long, ids binary").write.parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")

    def arrays(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
        for n, raw in zip(batch.column(0).to_pylist(), batch.column(column).to_pylist()):
            yield np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            part = np.bincount(np.concatenate([np.zeros(0, np.uint32), *arrays(batch, 1)]).astype(np.int64))
            total = np.pad(total, (0, max(0, len(part) - len(total))))
            total[:len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "count"])

    rows = staged.select("n", "ids").mapInArrow(counted, "id long, count long").groupBy("id").agg(F.sum("count").alias("count")).collect()
    counts = np.zeros(1 + max((r["id"] for r in rows), default=0), np.int64)
    for r in rows:
        counts[r["id"]] = r["count"]
    table = Table.of_counts(counts)
    shared_files.put(folder, "table.bin", table.dump())
    parts = max(1, -(-int(counts.sum()) // ids_per_file))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, writer = TaskContext.get(), FileWriter(table)
        for batch in batches:
            for doc, ids in zip(batch.column(2).to_pylist(), arrays(batch, 1)):
                writer.add(doc, ids.astype(np.uint32))
        if writer.docs:
            name = f"part-{context.partitionId():06d}.rans"
            content = writer.finish()
            shared_files.put(files, name, content, context.taskAttemptId())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(writer.docs)]), pa.array([sum(n for _, n in writer.docs)]), pa.array([len(content)])],
                names=["file", "docs", "ids", "bytes"])

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    written = (
        staged.withColumn("tie", F.xxhash64("ids")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("n", "ids", "doc_id").mapInArrow(coded, "file string, docs long, ids long, bytes long").toArrow().to_pylist()
    )  # one row per file
    written.sort(key=lambda r: r["file"])
    first = 0
    for r in written:
        r["first"], first = first, first + r["ids"]
    spark.createDataFrame(written, "file string, first long, docs long, ids long, bytes long").write.parquet(f"{folder}/manifest")
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents decoded from token files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian
    unsigned 32-bit). Files are decoded side by side, one task each; checksums are checked."""
    table = Table.load(shared_files.get(folder, "table.bin"))
    manifest = spark.read.parquet(f"{folder}/manifest").select("file", "first")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for docs, lengths, ids in read_file(shared_files.get(f"{folder}/files", name), table):
                    ends = np.cumsum(lengths)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths),
                         binary_column(ids.astype("<u4"), np.concatenate(([0], 4 * ends)))], names=["doc_id", "start", "n_tokens", "ids"])
                    start += int(ends[-1])

    files = max(1, manifest.count())
    return manifest.repartitionByRange(files, "first").mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids binary")
