"""A modified Kneser-Ney model of word pairs, counted by Spark, kept and asked by range in sorted hash arrays.

Texts are read once. Every slice of rows stays in a file of its own, as word codes. Four exchanges follow. The sorted hashes
of a slice's distinct pairs go to the parts of the model they belong to, which add up counts and answer; one of the slices
that hold a pair is told to own it. Slices add up what their own pairs say about a word, as a context and as a follower, and
send it to the parts of words, which add up and answer each slice about its words. So no task holds the whole model, a
frequent word or pair is one entry for each slice, and the model may grow with the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tabwright.functions.state import scratch_path
from tabwright.llm import shared_files
from tabwright.llm.batches import give_back, slices, split_words, texts_of

NO_LANGUAGE = "und"
MESSAGE = "part int, slice long, a binary, b binary, c binary, d binary"
CODEC = pa.Codec("zstd", 3)
SLICE_BYTES = 12_000_000  # larger slices repeat fewer pairs, and need more memory
WORD_BITS, PAIR_BITS = 32, 44


def language_of(lang: pa.Array) -> pa.DictionaryArray:
    return lang.cast(pa.string()).fill_null(NO_LANGUAGE).dictionary_encode()


def words_by_language(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.DictionaryArray]:
    """Of (text, lang) columns 0 and 1: row offsets, for each word its pair, then of each distinct pair the language
    number times the number of words plus the word number, the words, and the language of each row."""
    offsets, codes, words = split_words(texts_of(batch.column(0)))
    langs = language_of(batch.column(1))
    own = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(offsets)).astype(np.int64)
    key = own * max(1, len(words)) + codes
    size = max(1, len(words)) * max(1, len(langs.dictionary))
    if size > 4 * len(key) + 1000:  # many languages: sort the pairs that occur
        pairs, inverse = np.unique(key, return_inverse=True)
    else:
        times = np.bincount(key, minlength=size)
        pairs = np.flatnonzero(times)
        times[pairs] = np.arange(len(pairs))
        inverse = times[key]
    return offsets, inverse, pairs, words, langs


# ---- hashes and arrays as bytes -----------------------------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """An array as compressed planes of bytes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (CODEC.compress(planes, asbytes=True) if planes else b"")


def unpack(blob: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(CODEC.decompress(blob[8:], size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def word_hashes(words: list[str], langs: list[str], pairs: np.ndarray) -> np.ndarray:
    """32-bit hashes of (language, word) pairs, then of the starts of texts in each language."""
    seeds = [xxhash.xxh32_intdigest(x.encode(), 7) for x in langs]
    size = max(1, len(words))
    own = [xxhash.xxh32_intdigest(words[w], seeds[x]) for x, w in zip((pairs // size).tolist(), (pairs % size).tolist())]
    return np.array(own + [xxhash.xxh32_intdigest(b"", seed) for seed in seeds], np.uint64)


def edges(bits: int, parts: int) -> np.ndarray:
    """Where the parts of a range of hashes begin, and its end."""
    return np.array([(k << bits) // parts for k in range(parts + 1)], np.uint64)


def dealt(keys: np.ndarray, bits: int, parts: int) -> Iterator[tuple[int, slice]]:
    """For each part the stretch of sorted keys it holds."""
    cuts = np.searchsorted(keys, edges(bits, parts)).tolist()
    return ((part, slice(cuts[part], cuts[part + 1])) for part in range(parts))


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys[:0].dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of the columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return (keys[first], *(np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns))


def joined(arrays: list[np.ndarray], kind: type = np.uint64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays])


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
    columns = zip(*(r + (None,) * (6 - len(r)) for r in rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "slice", "a", "b", "c", "d"])


def frozen(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def thawed(raw: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(raw).read_next_batch()


# ---- discounts ----------------------------------------------------------------------------------------------------

def discounts(seen: np.ndarray) -> np.ndarray:
    """The three modified discounts, from the numbers of entries that occur once to four times."""
    n1, n2, n3, n4 = (float(x) for x in seen)
    if not (n1 and n2 and n3):
        return np.array([0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.array([min(k, max(0.0, k - (k + 1) * y * more / own)) for k, own, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))])


def discount(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.concatenate(([0.0], d))[np.minimum(counts, 3).astype(np.int64)]


def occurrences(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5]


# ---- the four exchanges -------------------------------------------------------------------------------------------

@dataclass
class Slice:
    """The words of some rows as codes: row offsets, code of each word, language of each row, hash of each code; the
    hashes of the languages' starts come last."""

    offsets: np.ndarray
    inverse: np.ndarray
    lang: np.ndarray
    hashes: np.ndarray
    kinds: int

    def before(self) -> np.ndarray:
        """For each word the code of the word before it; at the start of a text that of its language's start."""
        out = np.empty_like(self.inverse)
        out[1:] = self.inverse[:-1]
        full = np.diff(self.offsets) > 0
        out[self.offsets[:-1][full]] = self.kinds + self.lang[full]
        return out

    def pair_hashes(self, before: np.ndarray) -> np.ndarray:
        """The hash of each word with the word before it."""
        keys = self.hashes[before] << np.uint64(32) | self.hashes[self.inverse]
        for shift, factor in ((32, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
            keys ^= keys >> np.uint64(shift)
            keys *= np.uint64(factor)
        keys >>= np.uint64(64 - PAIR_BITS)
        return keys

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each word's pair among the sorted distinct hashes, and the two words of each distinct pair as codes."""
        before = self.before()
        _, first, place = np.unique(self.pair_hashes(before), return_index=True, return_inverse=True)
        return place, before[first], self.inverse[first]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes, sorted, and the place of each code among them."""
        return np.unique(self.hashes, return_inverse=True)

    def put(self, folder: str, number: int, measured: bytes, attempt: int) -> None:
        codes = {"inverse": pack(self.inverse.astype(np.uint32)), "counts": pack(np.diff(self.offsets)), "lang": pack(self.lang),
                 "hashes": pack(self.hashes.astype(np.uint32)), "kinds": self.kinds.to_bytes(8, "little"), "measures": measured}
        shared_files.put(folder, f"codes-{number}", frozen(pa.RecordBatch.from_pydict({n: [c] for n, c in codes.items()})), attempt)

    @staticmethod
    def get(folder: str, number: int) -> tuple[Slice, bytes]:
        codes = [c[0].as_py() for c in thawed(shared_files.get(folder, f"codes-{number}")).columns]
        offsets = np.concatenate(([0], np.cumsum(unpack(codes[1], np.int64))))
        return Slice(offsets, unpack(codes[0], np.uint32).astype(np.int64), unpack(codes[2], np.int64),
                     unpack(codes[3], np.uint32).astype(np.uint64), int.from_bytes(codes[4], "little")), codes[5]


def _cut(parts: int, folder: str, text: int, lang: int, carried: list[int], measure: Callable) -> Callable:
    """Stores slices, and sends each part of the pairs the hashes of its own; all parts hear of all slices."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made = TaskContext.get(), 0
        for batch in (s for b in batches for s in slices(b, text, SLICE_BYTES)):
            number = context.partitionId() << 24 | made
            made += 1
            if carried:
                rows = pa.RecordBatch.from_arrays([batch.column(k) for k in carried], schema=pa.schema([batch.schema.field(k) for k in carried]))
                shared_files.put(folder, f"rows-{number}", frozen(rows), context.taskAttemptId())
                del rows
            pair = pa.RecordBatch.from_arrays([batch.column(text), batch.column(lang)], names=["text", "lang"])
            offsets, inverse, kinds, words, langs = words_by_language(pair)
            sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False)[kinds % max(1, len(words))]
            measured = frozen(pa.RecordBatch.from_arrays(*measure(pair, offsets, inverse, sizes)))
            own = Slice(offsets, inverse, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                        word_hashes(words.to_pylist(), langs.dictionary.to_pylist(), kinds), len(kinds))
            del pair, words, kinds, sizes, langs
            own.put(folder, number, measured, context.taskAttemptId())
            keys, counts = np.unique(own.pair_hashes(own.before()), return_counts=True)
            del own, offsets, inverse
            give_back()
            yield messages([(part, number, pack_sorted(keys[at]), pack(counts[at].astype(np.uint64))) for part, at in dealt(keys, PAIR_BITS, parts)])

    return work


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _by_slice(work: Callable[[int, list[tuple]], pa.RecordBatch]) -> Callable:
    """Calls ``work`` with all messages to one slice, in order of part; rows have to come sorted by slice and part."""
    return lambda batches: (work(number, list(rows)) for number, rows in groupby(_rows(batches), key=lambda r: r[1]))


def _count_pairs(parts: int) -> Callable:
    """Adds up the pairs of a part. Answers hold, of each pair, twice its count, and one more for the slice that owns it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(_rows(batches), key=lambda r: r[:2])
        own = [unpack_sorted(r[2]) for r in held]
        ends = np.cumsum([0, *map(len, own)])
        keys = joined(own)
        del own
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, bool)
        counts = joined([unpack(r[3], np.uint64) for r in held])[order]
        sums = np.add.reduceat(counts, np.flatnonzero(first)) if len(keys) else counts
        answers = np.empty(len(keys), np.uint64)
        answers[order] = sums[np.cumsum(first) - 1] * np.uint64(2) + first
        seen = {part: occurrences(sums[at]).astype(np.int64).tobytes() for part, at in dealt(ordered[first], PAIR_BITS, parts)}
        for k, row in enumerate(held):
            yield messages([(row[0], row[1], pack(answers[ends[k]:ends[k + 1]]), seen[row[0]])])

    return work


def _tell_words(parts: int, folder: str) -> Callable:
    """A slice that has the counts of its pairs keeps them and sends each part of the words what its own pairs say:
    counts as a context, the counts that discounts set free, and different followed words."""

    def work(number: int, rows: list[tuple]) -> pa.RecordBatch:
        answers = joined([unpack(r[2], np.uint64) for r in rows])
        d = discounts(sum(np.frombuffer(r[3], np.int64) for r in rows))
        kept = pa.RecordBatch.from_pydict({"counts": [pack(answers >> np.uint64(1))], "d": [d.tobytes()]})
        shared_files.put(folder, f"counts-{number}", frozen(kept), TaskContext.get().taskAttemptId())
        own, _ = Slice.get(folder, number)
        _, before, after = own.pairs()
        words, place = own.words()
        owned = (answers & np.uint64(1)) > 0
        counts = (answers >> np.uint64(1))[owned]
        v, w = place[before[owned]], place[after[owned]]
        total = np.bincount(v, counts, len(words)).astype(np.uint64)
        free = np.bincount(v, discount(counts, d), len(words)).astype(np.float32)
        follows = np.bincount(w, minlength=len(words)).astype(np.uint64)
        return messages([(part, number, pack_sorted(words[at]), pack(total[at]), pack(free[at]), pack(follows[at])) for part, at in dealt(words, WORD_BITS, parts)])

    return _by_slice(work)


def _weigh_words(parts: int) -> Callable:
    """Adds up what is known of the words of a part. Answers hold, of each word, its count as a context, the share that
    discounts set free, and the different words it follows; beside them the part's share of the numbers discounts need."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(_rows(batches), key=lambda r: r[:2])
        words, total, free, follows = summed(
            joined([unpack_sorted(r[2]) for r in held]), joined([unpack(r[3], np.uint64) for r in held]),
            joined([unpack(r[4], np.float32).astype(np.float64) for r in held], np.float64), joined([unpack(r[5], np.uint64) for r in held]))
        gamma = np.where(total > 0, free / np.maximum(total, 1), 1.0).astype(np.float32)
        shares = {part: np.array([*occurrences(follows[at]), (follows[at] > 0).sum(), follows[at].sum()], np.float64).tobytes()
                  for part, at in dealt(words, WORD_BITS, parts)}
        for row in held:
            at = np.searchsorted(words, unpack_sorted(row[2]))
            yield messages([(row[0], row[1], pack(total[at]), pack(gamma[at]), pack(follows[at]), shares[row[0]])])

    return work


def pair_logs(context: np.ndarray, word: np.ndarray, counts: np.ndarray, total: np.ndarray, gamma: np.ndarray,
              follows: np.ndarray, d_pairs: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each pair of words, given their places, and of each word as a follower of any word.

    ``share``: different followers that follow one to four words, all of them, and all different pairs.
    """
    d = discounts(share[:4])
    known, pairs = share[4], max(1.0, share[5])
    three = known - share[0] - share[1]
    rest = (d @ np.array([share[0], share[1], three])) / pairs / (known + 1)
    single = (follows - discount(follows, d)) / pairs + rest
    pair = (counts - discount(counts, d_pairs)) / np.maximum(1, total[context]) + gamma[context] * single[word]
    return np.log(np.maximum(pair, 1e-300)), np.log(np.maximum(single, 1e-300))


def _score(folder: str, show: int, names: list[str]) -> Callable:
    """Sums of log probabilities of each row of a slice, once all its answers are there."""

    def work(number: int, rows: list[tuple]) -> pa.RecordBatch:
        own, measured = Slice.get(folder, number)
        packed, d = (c[0].as_py() for c in thawed(shared_files.get(folder, f"counts-{number}")).columns)
        pair_of, before, after = own.pairs()
        _, place = own.words()
        total, gamma, follows = (joined([unpack(r[k], kind) for r in rows], kind) for k, kind in ((2, np.uint64), (3, np.float32), (4, np.uint64)))
        share = sum(np.frombuffer(r[5], np.float64) for r in rows)
        pair, single = pair_logs(place[before], place[after], unpack(packed, np.uint64), total, gamma.astype(np.float64), follows, np.frombuffer(d, np.float64), share)

        def by_row(values: np.ndarray) -> pa.Array:
            sums = np.concatenate(([0.0], np.cumsum(values)))
            return pa.array(sums[own.offsets[1:]] - sums[own.offsets[:-1]])

        size = len(own.lang)
        shown = thawed(shared_files.get(folder, f"rows-{number}")).columns[:show] if show else []
        return pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(number, pa.int64()), size), pa.array(np.arange(size)), *shown, *thawed(measured).columns,
            by_row(pair[pair_of]), by_row(single[place[own.inverse]])], names=names)

    return _by_slice(work)


def scored(docs: DataFrame, text_col: str, lang_col: str, carried: list[str], show: int, measure: Callable, fields: str) -> tuple[DataFrame, str]:
    """For each row its slice, its place there, the first ``show`` carried columns, the columns of ``measure``, the summed
    log probability of its words, and the same from followers alone; and the folder where slices keep the carried columns.

    ``measure`` gets (text, lang), row offsets, the code of each word and the length of each code, and returns columns and
    names; ``fields`` is the schema of shown columns and measures.

    Words of different languages are different words. The part count is ``spark.sql.shuffle.partitions``. A slice is read
    again only if its task is lost, so ``docs`` has to give the same rows in the same order then, as a stored table does.
    """
    spark = docs.sparkSession
    parts, folder = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch_path(spark, "slices")
    columns = docs.columns
    cut = docs.mapInArrow(_cut(parts, folder, columns.index(text_col), columns.index(lang_col), [columns.index(c) for c in carried], measure), MESSAGE)
    counted = _to_slices(cut.repartitionById(parts, "part").mapInArrow(_count_pairs(parts), MESSAGE), parts)
    told = counted.mapInArrow(_tell_words(parts, folder), MESSAGE)
    weighed = _to_slices(told.repartitionById(parts, "part").mapInArrow(_weigh_words(parts), MESSAGE), parts)
    names = ["slice", "at", *(f.split()[0] for f in fields.split(", ")), "log_p", "log_single"]
    return weighed.mapInArrow(_score(folder, show, names), f"slice long, at long, {fields}, log_p double, log_single double"), folder


def _to_slices(answers: DataFrame, parts: int) -> DataFrame:
    return answers.repartition(parts, "slice").sortWithinPartitions("slice", "part")
