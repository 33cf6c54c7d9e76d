"""Repeated byte strings by a distributed merge sort of suffixes that never compares a known common prefix again.

Only suffixes that can matter are sorted: every string of the wanted length holds one anchor, the place of its smallest
40-byte hash, which depends on nothing but the string. Anchors whose 40 bytes occur once in the corpus cannot lie in a
repeated string and are left out. The suffixes of the others are sorted in runs, front-coded, dealt by ranges of their
first bytes, and merged by loser trees that know how long a prefix each run's head shares with the last suffix given out.
"""

from __future__ import annotations

import bisect
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabwright.llm.batches import slices, texts_of
from tabwright.llm.line_dedup import NO_ID, keyed
from tabwright.llm.staging import staged

LENGTH = 200
GRAM = 40  # bytes of an anchor's own string
LEFT = LENGTH - GRAM  # bytes that a string can have before its anchor
SLICE = 3_000_000  # bytes hashed at a time
RUN = 60_000  # suffixes sorted at a time
RANGE_ROWS = 40_000  # suffixes aimed at in a range
SAMPLED, SPLITTERS = 256, 100_000  # one anchor in so many may serve as a splitter; splitter candidates looked at, at most


# ---- anchors ------------------------------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 40 bytes from each place, by doubling: 1, 2, 4, ... 32, then 32 + 8."""
    def joined(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
        size = len(b) - gap
        h = a[:size] * np.uint64(0x9E3779B97F4A7C15) + b[gap:]
        h ^= h >> np.uint64(31)
        return h

    level, eight = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9), None
    for gap in (1, 2, 4, 8, 16):
        if gap == 8:
            eight = level
        level = joined(level, level, gap)
    return joined(level, eight, 32) * np.uint64(0x94D049BB133111EB)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all strings of LENGTH bytes inside the rows, and the hashes of their 40 bytes.

    Of equal hashes in a string the first counts (the place breaks ties), so equal strings have their anchor at the same
    distance from their start. 40 bits of the hash decide.
    """
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes, place = gram_hashes(data), np.uint64(24)
    least = sliding_least(hashes >> place << place | np.arange(len(hashes), dtype=np.uint64), LENGTH - GRAM + 1)
    ends = offsets[np.searchsorted(offsets, np.arange(len(least)), side="right")]
    inside = np.arange(len(least)) + LENGTH <= ends
    found = np.unique(least[inside] & np.uint64((1 << 24) - 1)).astype(np.int64)
    return found, hashes[found]


def byte_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in turn, and the row offsets."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(h, doc, th, pos, head) for all anchors; some rows have the 40 bytes as ``head``, to choose splitters from.

    A text longer than the slices that are hashed together is hashed in overlapping pieces.
    """

    def pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if len(raw) <= 4 * SLICE:
            yield 0, raw, offsets
            return
        for start in range(0, len(raw), SLICE):
            stop = min(len(raw), start + SLICE + LENGTH - 1)
            inner = offsets[(offsets > start) & (offsets < stop)] - start
            yield start, raw[start:stop], np.concatenate(([0], inner, [stop - start]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 2, SLICE)):
            raw, offsets = byte_table(texts_of(batch.column(2)))
            parts = [(start + at, h) for start, piece, cuts in pieces(raw, offsets) for at, h in [anchors(piece, cuts)]]
            place = np.concatenate([p[0] for p in parts])
            place, first = np.unique(place, return_index=True)
            h = np.concatenate([p[1] for p in parts])[first]
            row = np.searchsorted(offsets, place, side="right") - 1
            heads = [raw[p:p + GRAM].tobytes() if take else None for p, take in zip(place.tolist(), (h % np.uint64(SAMPLED) == 0).tolist())]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array((place - offsets[row]).astype(np.int32)),
                 pa.array(heads, pa.binary())], names=["h", "doc", "th", "pos", "head"])

    return docs.mapInArrow(work, "h long, doc long, th long, pos int, head binary")


# ---- sorted runs --------------------------------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    most = min(len(a), len(b))
    while known + 16 <= most and a[known:known + 16] == b[known:known + 16]:
        known += 16
    while known < most and a[known] == b[known]:
        known += 1
    return known


def front_coded(suffixes: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted suffixes (of at most 255 bytes) as prefix lengths shared with the one before, rest lengths, and rests."""
    shared, rests, last = bytearray(), [], b""
    for s in suffixes:
        same = common_prefix(last, s, 0)
        shared.append(same)
        rests.append(s[same:])
        last = s
    return bytes(shared), bytes(map(len, rests)), b"".join(rests)


def unfronted(shared: bytes, sizes: bytes, rests: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for same, size in zip(shared, sizes):
        last = last[:same] + rests[at:at + size]
        at += size
        out.append(last)
    return out


class LoserTree:
    """Merges sorted runs given as (suffixes, prefix lengths shared with the one before).

    Each run's head carries the length of the prefix it shares with the suffix given out last. Of two heads the one that
    shares more is smaller, without a look at their bytes; only heads that share equally much are compared, from there
    on. The loser then knows what it shares with the winner, which is the next to be given out.
    """

    def __init__(self, runs: list[tuple[list[bytes], bytes]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.same = [0] * len(runs)
        self.width = 1
        while self.width < len(runs):
            self.width *= 2
        self.losers = [-1] * self.width
        self.winner = self._build(1)

    def _head(self, run: int) -> bytes | None:
        return self.runs[run][0][self.at[run]] if 0 <= run < len(self.runs) and self.at[run] < len(self.runs[run][0]) else None

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        x, y = self._head(a), self._head(b)
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.same[a] != self.same[b]:
            return (a, b) if self.same[a] > self.same[b] else (b, a)
        same = common_prefix(x, y, self.same[a])
        if same == len(x) or (same < len(y) and x[same] < y[same]):
            self.same[b] = same
            return a, b
        self.same[a] = same
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, place in it, length of the prefix shared with the suffix given out before)."""
        while self._head(run := self.winner) is not None:
            yield run, self.at[run], self.same[run]
            self.at[run] += 1
            if self.at[run] < len(self.runs[run][0]):
                self.same[run] = self.runs[run][1][self.at[run]]
            node, best = (run + self.width) // 2, run
            while node:
                best, self.losers[node] = self._play(best, self.losers[node])
                node //= 2
            self.winner = best


# ---- what the sorted suffixes show ----------------------------------------------------------------------------------

def repeated_reach(same: np.ndarray, right: np.ndarray, lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix in sorted order the least and most bytes before its anchor at which a repeated string starts
    (-1: none).

    ``same`` has the prefix shared with the one before, ``right`` the suffix lengths, ``lefts`` the bytes before the
    anchors. A string that starts d bytes before is repeated if another suffix shares LENGTH - d bytes to the right and
    the same d bytes to the left: the first are intervals of the sorted order, the second classes refined byte by byte.
    Suffixes that are alone in their class leave.
    """
    n = len(same)
    least, most = np.full(n, -1), np.full(n, -1)
    size = np.fromiter(map(len, lefts), np.int64, n)
    before = np.zeros((n, LEFT), np.uint8)
    for k, left in enumerate(lefts):
        if left:
            before[k, :len(left)] = np.frombuffer(left, np.uint8)[::-1]
    classes = np.cumsum(same < GRAM).astype(np.int64)
    active = np.arange(n)
    for d in range(LEFT + 1):
        if d:
            active = active[size[active] >= d]
            _, kind = np.unique(classes[active] * 256 + before[active, d - 1], return_inverse=True)
            classes[active] = kind
        else:
            kind = classes
        alone = np.bincount(kind, minlength=1)[kind] < 2
        active = active[~alone]
        if not len(active):
            break
        fits = active[right[active] >= LENGTH - d]
        interval = np.cumsum(same < LENGTH - d)
        _, group, times = np.unique(interval[fits] * (n + 1) + classes[fits], return_inverse=True, return_counts=True)
        hit = fits[times[group] > 1]
        most[hit] = d
        least[hit[least[hit] < 0]] = d
    return least, most


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


SENT = pa.schema([("target", pa.int32()), ("doc", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("run", pa.binary())])
SPAN = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def run_rows(suffixes: list[tuple[bytes, bytes, int, int, int]], splitters: list[bytes]) -> Iterator[tuple]:
    """Sort (right, left, doc, th, pos); give settled spans and front-coded runs by range.

    Suffixes with equal bytes on both sides settle each other at once; one of them goes on, without a place, so a string
    of any frequency is sent once for each run.
    """
    suffixes.sort(key=lambda s: s[:2])
    ends = [*range(1, len(suffixes))] + [len(suffixes)]
    kept, first = [], 0
    for k in ends:
        if k < len(suffixes) and suffixes[k][:2] == suffixes[first][:2]:
            continue
        right, left = suffixes[first][:2]
        if k - first > 1 and len(left) + len(right) >= LENGTH:
            by_doc: dict[tuple[int, int], list] = {}
            for _, _, doc, th, pos in suffixes[first:k]:
                by_doc.setdefault((doc, th), []).append((pos - len(left), pos + len(right)))
            for (doc, th), spans in by_doc.items():
                for start, end in merged(spans):
                    yield doc % (len(splitters) + 1), doc, th, start, end, None
        kept.append((right, left, *(suffixes[first][2:] if k - first == 1 else (0, 0, -1))))
        first = k
    start = 0
    for target in range(len(splitters) + 1):
        stop = bisect.bisect_left(kept, splitters[target], start, key=lambda s: s[0][:GRAM]) if target < len(splitters) else len(kept)
        if start < stop:
            part = kept[start:stop]
            place = np.array([s[2:] for s in part], np.int64)
            yield target, None, None, None, None, pickle.dumps(
                (front_coded([s[0] for s in part]), bytes(len(s[1]) for s in part), b"".join(s[1] for s in part), place.tobytes()))
        start = stop


def merged_spans(runs: list[bytes]) -> Iterator[tuple]:
    """Spans (doc, th, start, end) of repeated strings from the runs of one range."""
    streams, lefts, places = [], [], []
    for raw in runs:
        (shared, sizes, rests), left_sizes, left, place = pickle.loads(raw)
        streams.append((unfronted(shared, sizes, rests), shared))
        ends = np.cumsum(np.frombuffer(left_sizes, np.uint8).astype(np.int64)).tolist()
        lefts.append([left[a:b] for a, b in zip([0, *ends], ends)])
        places.append(np.frombuffer(place, np.int64).reshape(-1, 3))
    order = list(LoserTree(streams))
    same = np.array([s for _, _, s in order], np.int64)
    right = np.array([len(streams[r][0][k]) for r, k, _ in order], np.int64)
    least, most = repeated_reach(same, right, [lefts[r][k] for r, k, _ in order])
    for (r, k, _), d0, d1 in zip(order, least.tolist(), most.tolist()):
        doc, th, pos = places[r][k].tolist()
        if d1 >= 0 and pos >= 0:
            yield doc, th, pos - d1, pos - d0 + LENGTH


# ---- the operator -------------------------------------------------------------------------------------------------

def repeated_spans(base: DataFrame) -> DataFrame:
    """(doc, th, start, end) in bytes: spans whose union, by document of ``base`` (doc, th, text), is all that is repeated."""
    found = staged(anchor_rows(base), "anchors")
    # written first: a join of two plain exchanges, whose hot hashes adaptive execution can split
    several = staged(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "several")
    wanted = staged(found.join(several, "h", "left_semi").select("doc", "th", "pos", "head"), "wanted")
    ranges = max(1, -(-wanted.count() // RANGE_ROWS))
    heads = sorted(bytes(r["head"]) for r in wanted.where("head IS NOT NULL").select("head").orderBy(F.xxhash64("head", "doc", "pos")).limit(SPLITTERS).collect())
    splitters = sorted({heads[k * len(heads) // ranges] for k in range(1, ranges)} - {b""}) if heads else []
    places = wanted.groupBy("doc", "th").agg(F.collect_set("pos").alias("places"))  # bounded by a document's bytes

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes: list[tuple] = []
        for batch in (s for b in batches for s in slices(b, 2)):
            for doc, th, text, own in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2).cast(pa.large_binary()).to_pylist(), batch.column(3).to_pylist()):
                suffixes += [(text[p:p + LENGTH], text[max(0, p - LEFT):p], doc, th, p) for p in own]
                if len(suffixes) >= RUN:
                    yield _columns(list(run_rows(suffixes, splitters)), SENT)
                    suffixes = []
        yield _columns(list(run_rows(suffixes, splitters)), SENT)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, held = None, []
        for batch in batches:
            settled = batch.filter(batch.column(5).is_null())
            yield settled.select(["doc", "th", "start", "end"])
            for own, run in zip(batch.column(0).to_pylist(), batch.column(5).to_pylist()):
                if own != target and held:
                    yield _columns(list(merged_spans(held)), SPAN)
                    held = []
                target = own
                if run is not None:
                    held.append(run)
        if held:
            yield _columns(list(merged_spans(held)), SPAN)

    sent = base.join(places, ["doc", "th"]).select("doc", "th", "text", "places").mapInArrow(
        runs, "target int, doc long, th long, start int, end int, run binary")
    return sent.repartition(len(splitters) + 1, "target").sortWithinPartitions("target").mapInArrow(
        merge, "doc long, th long, start int, end int")


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (array of byte start, end: maximal removed runs), kept (the
    remaining bytes).

    A byte is removed if a string of 200 bytes that covers it also starts anywhere else in the table, in the same
    document included; strings do not cross documents and are judged on the input. Rows with the same id and text are
    separate documents, so they repeat each other. Null and empty texts have no bytes; a null id stays null; an empty
    table gives no rows; other columns are not read.
    """
    base = keyed(docs, id_col, text_col)
    spans = repeated_spans(base).groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # bounded by a document
    joined = base.join(spans, ["doc", "th"], "left").select("doc", "text", "spans")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1)):
            sizes, cut, kept = [], [], []
            for text, own in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
                runs = merged([(r["start"], r["end"]) for r in own or ()])
                edges = [0, *(x for r in runs for x in r), len(text)]
                sizes.append(len(text))
                cut.append([{"start": s, "end": e} for s, e in runs])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cut, span), pa.array(kept, pa.binary())], names=["doc", "n_bytes", "spans", "kept"])

    rows = joined.mapInArrow(work, "doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return rows.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "spans", "kept")
