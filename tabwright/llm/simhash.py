"""SimHash near-duplicates by anchor points of covering codes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import cut_lineage
from tabwright.llm.batches import LOWER, mapped_bytes, slices, split_words, texts_of
from tabwright.llm.components import components
from tabwright.llm.staging import staged

# Distinct fingerprints compared in one go; an anchor with more is dealt out as pairs of chunks of this size.
CHUNK = 2048
# Bytes of text hashed at a time; shingles take some twenty times the room of their words.
SHINGLED = 2_000_000
THRESHOLD = 3


# ---- fingerprints -------------------------------------------------------------------------------------------------

def shingle_hashes(offsets: np.ndarray, codes: np.ndarray, words: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each row's shingles of ``width`` words, and row offsets. Shorter rows are one shingle."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    in_turn = pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), words.take(pa.array(codes)).cast(pa.string()))
    joined = memoryview(pc.binary_join(in_turn, " ")[0].as_py().encode())
    counts = np.diff(offsets)
    shingles = np.where(counts > 0, np.maximum(1, counts - width + 1), 0)
    row_starts = np.concatenate(([0], np.cumsum(shingles)))
    first = np.arange(row_starts[-1]) - np.repeat(row_starts[:-1], shingles) + np.repeat(offsets[:-1], shingles)
    last = np.minimum(first + width, np.repeat(offsets[1:], shingles)) - 1
    begin, end = starts[first].tolist(), (starts[last] + sizes[last]).tolist()
    hashed = map(xxhash.xxh64_intdigest, (joined[b:e] for b, e in zip(begin, end)), repeat(42))
    return np.fromiter(hashed, np.uint64, len(begin)), row_starts


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row the 64 bits that are set in over half of its hashes; none for a row without hashes.

    Bits are counted eight at a time, in the bytes of 64-bit sums over at most 255 hashes.
    """
    counts = np.diff(offsets)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    parts = -(-counts[full] // 255)
    firsts = np.concatenate(([0], np.cumsum(parts)))[:-1]
    within = np.arange(parts.sum()) - np.repeat(firsts, parts)
    cuts = np.repeat(offsets[:-1][full], parts) + 255 * within
    ones = np.uint64(0x0101010101010101)
    for shift in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & ones, cuts)
        per_byte = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), firsts, axis=0)
        for byte in range(8):
            over = 2 * per_byte[:, byte] > counts[full]
            out[full] |= over.astype(np.uint64) << np.uint64(8 * byte + shift)
    return out


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """doc_id and its 64-bit fingerprint as a signed long. Texts are lower-cased (A-Z), words lie between ASCII white
    space; null and empty texts have fingerprint zero."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1, SHINGLED)):
            hashes, offsets = shingle_hashes(*split_words(mapped_bytes(texts_of(batch.column(1)), LOWER)), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(majority_bits(hashes, offsets).view(np.int64))],
                                             names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(work, "doc_id long, fp long")


# ---- anchors ------------------------------------------------------------------------------------------------------

def hamming_neighbours() -> tuple[np.ndarray, np.ndarray]:
    """For every 15-bit word the code words of the perfect Hamming code near it: (32768, 8) words, (32768,) how many.

    Column 0 is the code word within distance 1, its covering radius; the others are those at distance 2.
    """
    words = np.arange(1 << 15)
    syndrome = np.zeros(1 << 15, np.int64)
    for bit in range(15):
        syndrome ^= np.where(words >> bit & 1, bit + 1, 0)
    nearest = np.where(syndrome > 0, words ^ (1 << np.maximum(syndrome - 1, 0)), words)
    near = np.empty((1 << 15, 8), np.int64)
    near[:, 0] = nearest
    column = np.ones(1 << 15, np.int64)
    for i, j in combinations(range(15), 2):
        hit = np.flatnonzero((syndrome == ((i + 1) ^ (j + 1))) & (syndrome > 0))
        near[hit, column[hit]] = hit ^ (1 << i) ^ (1 << j)
        column[hit] += 1
    return near, column


def anchor_rows(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, position of the fingerprint) for all anchors of all fingerprints.

    Fingerprints that differ in at most 3 bits differ in at most 1 bit in some two of their four 16-bit quarters. For
    each of the six pairs of quarters the anchors are a covering code of 32 bits: two Hamming codes of 15 bits (each
    of covering radius 1) and two free bits. A fingerprint goes to its nearest anchor and to all that are one step
    further in one part, that is, within covering radius plus threshold; so two linked ones meet at the nearest anchor
    of either.
    """
    near, many = hamming_neighbours()
    quarters = [(fps >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    anchors, rows = [], []
    everyone = np.arange(len(fps))
    for table, (i, j) in enumerate(combinations(range(4), 2)):
        left, right = quarters[i] & 0x7FFF, quarters[j] & 0x7FFF
        free = (quarters[i] >> 15) << 1 | quarters[j] >> 15

        def key(a: np.ndarray, b: np.ndarray, f: np.ndarray) -> np.ndarray:
            return ((table << 2 | f) << 15 | a) << 15 | b

        home = near[left, 0], near[right, 0]
        anchors += [key(*home, free), key(*home, free ^ 1), key(*home, free ^ 2)]
        rows += [everyone] * 3
        for column in range(1, 8):
            some = np.flatnonzero(many[left] > column)
            anchors.append(key(near[left[some], column], home[1][some], free[some]))
            rows.append(some)
            some = np.flatnonzero(many[right] > column)
            anchors.append(key(home[0][some], near[right[some], column], free[some]))
            rows.append(some)
    return np.concatenate(anchors), np.concatenate(rows)


# ---- comparison ---------------------------------------------------------------------------------------------------

def forest(groups: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of a group that are linked directly or over others: at most one less than rows.

    Rows are sorted by group. Distances are taken for all pairs of a group, one shift of the array at a time; links
    between rows that are joined already are left out.
    """
    parent = np.arange(len(fps))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first, second, shift = [], [], 1
    rows = np.arange(len(fps))
    while True:
        rows = rows[rows + shift < len(fps)]
        rows = rows[groups[rows] == groups[rows + shift]]
        if not len(rows):
            break
        close = rows[np.bitwise_count(fps[rows] ^ fps[rows + shift]) <= threshold]
        for x in close.tolist():
            a, b = root(x), root(x + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                first.append(x)
                second.append(x + shift)
        shift += 1
    return np.array(first, np.int64), np.array(second, np.int64)


def _by_group(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Sorted (group, fingerprint) rows in arrays of whole groups; the rows of a group above ``most`` come alone, flagged."""
    group, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        group = np.concatenate([group, batch.column(0).to_numpy()])
        fp = np.concatenate([fp, batch.column(1).to_numpy()])
        cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
        if cut:
            yield from _split(group[:cut], fp[:cut], most)
            group, fp = group[cut:], fp[cut:]
    if len(group):
        yield from _split(group, fp, most)


def _split(group: np.ndarray, fp: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate([starts, [len(group)]]))
    big = np.repeat(sizes > most, sizes)
    if (~big).any():
        yield group[~big], fp[~big], False
    for start, size in zip(starts[sizes > most].tolist(), sizes[sizes > most].tolist()):
        yield group[start:start + size], fp[start:start + size], True


LINK = pa.schema([("anchor", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("chunks", pa.int64())])


def _link_rows(anchor, a, b, chunks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (anchor, a, b, chunks)], schema=LINK)


def links(fps: DataFrame, threshold: int = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` (signed longs): enough to join all within ``threshold`` <= 3 bits.

    Every fingerprint is replicated to its anchors (about 91), rows are dealt and sorted by anchor, and compared inside
    it. An anchor of more than ``chunk`` rows is not compared there: its rows are dealt out again as pairs of chunks.
    """
    if threshold > THRESHOLD:
        raise ValueError("the anchors serve thresholds up to 3")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for start in range(0, len(own), 50_000):
                part = own[start:start + 50_000]
                anchors, rows = anchor_rows(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(part[rows])], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, fp, big in _by_group(batches, chunk):
            if big:
                number = np.arange(len(fp)) // chunk
                yield _link_rows(group, fp, number, np.full(len(fp), number[-1] + 1))
            else:
                x, y = forest(group, fp.view(np.uint64), threshold)
                yield _link_rows(pa.nulls(len(x)), fp[x], fp[y], np.zeros(len(x)))

    def compare_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, fp, _ in _by_group(batches, 2 * chunk):
            x, y = forest(group, fp.view(np.uint64), threshold)
            yield _link_rows(pa.nulls(len(x)), fp[x], fp[y], np.zeros(len(x)))

    kind = "anchor long, a long, b long, chunks long"
    met = cut_lineage(
        fps.select("fp").mapInArrow(replicate, "anchor long, fp long").repartition("anchor")
        .sortWithinPartitions("anchor", "fp").mapInArrow(compare, kind))
    # row a of chunk b of a large anchor goes to all pairs of chunks with its own
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = (
        met.where("chunks > 0").withColumn("o", other)
        .select(F.xxhash64("anchor", F.least("b", "o"), F.greatest("b", "o")).alias("pair"), F.col("a").alias("fp"))
        .repartition("pair").sortWithinPartitions("pair", "fp").mapInArrow(compare_chunks, kind)
    )
    return met.where("chunks = 0").union(dealt).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, fp (signed long), fingerprint (16 hex digits), component_id (smallest doc_id that
    can be reached over links of at most ``threshold`` differing bits, itself included).

    Equal fingerprints become one row before anything is replicated, so a group of copies of any size costs one row.
    Null and empty texts have fingerprint zero and are linked like any other; a null id takes no part in the minimum;
    repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    marked = cut_lineage(fingerprints(docs, id_col=id_col, text_col=text_col, width=width))
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = components(links(classes.select("fp"), threshold))
    roots = classes.join(joined, classes["fp"] == joined["node"], "left").select(
        classes["fp"].alias("fp"), "least", F.coalesce("root", classes["fp"]).alias("root"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = staged(roots.select("fp", "root").join(least, "root").select("fp", "component_id"), "labels")  # a hot fp can be split below
    return marked.join(labels, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
