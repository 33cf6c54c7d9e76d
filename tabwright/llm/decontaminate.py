"""Benchmark passages in training texts: a suffix automaton of the items reads every document."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import scratch_path
from tabwright.llm import shared_files
from tabwright.llm.automaton import SuffixAutomaton
from tabwright.llm.batches import WORD_BYTES, mapped_bytes, slices, split_words, texts_of

# Most item words in one automaton (about 200 bytes each); more items make more automata, read one after another.
BLOCK_WORDS = 400_000
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")  # the words of the text as written, upper case included


class ItemIndex:
    """Word numbers, automaton, and which items hold each window of ``least`` words (or are shorter and whole)."""

    def __init__(self, items: list[tuple[str | None, list[str]]], least: int):
        self.least, self.numbers = least, {}
        coded = [(name, [self.numbers.setdefault(w, len(self.numbers)) for w in words]) for name, words in items if words]
        self.automaton = a = SuffixAutomaton()
        for _, words in coded:
            a.add(words)
        self.holders: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        for name, words in coded:
            state = 0
            for k, word in enumerate(words, 1):
                state = a.next[state][word]
                if k >= least:
                    self.holders.setdefault(a.suffix(state, least), set()).add(name)
            if len(words) < least:
                self.short.setdefault(a.suffix(state, len(words)), {}).setdefault(len(words), set()).add(name)
        self.ends: dict[int, list] = {}

    def whole_items(self, state: int) -> list[tuple[int, set]]:
        """Short items that end where ``state`` ends: (words, names)."""
        if state not in self.ends:
            found, s = [], state
            while s > 0:
                found += self.short.get(s, {}).items()
                s = self.automaton.link[s]
            self.ends[state] = found
        return self.ends[state]

    def read(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Matches (start, end) in a run of known words, and the names of the items with a match."""
        state = length = 0
        matches, names, step, least = [], set(), self.automaton.step, self.least
        for k, word in enumerate(words, 1):
            state, length = step(state, length, word)
            if length >= least:
                matches.append((k - least, k))
                names |= self.holders[self.automaton.suffix(state, least)]
            if self.short:
                for size, who in self.whole_items(state):
                    if size <= length:
                        matches.append((k - size, k))
                        names |= who
        return matches, names


def merged(matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(matches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def words_of(text: str | None) -> list[str]:
    return [w for w in (text or "").encode().translate(WORD_BYTES).decode().split(" ") if w]


def _indexes(items: DataFrame, id_col: str, text_col: str, least: int, block_words: int) -> tuple[str, list[str]]:
    """Automata of all items, each of a bounded number of words, as files in the shared folder."""
    spark = items.sparkSession
    items = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    total = items.select(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (4 * block_words)))
    folder, names = scratch_path(spark, "items"), []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).distinct().toArrow().to_pylist()
        index = ItemIndex(sorted(((r["id"], words_of(r["text"])) for r in rows), key=lambda r: (r[0] or "", r[1])), least)
        shared_files.put(folder, f"block-{block}", pickle.dumps(index))
        names.append(f"block-{block}")
    return folder, names


def find_contamination(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", least: int = 10, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (array of first word, words, start, end), items (sorted).

    Words are runs of letters a-z (after lower-casing A-Z), digits and non-ASCII characters. A match is ``least``
    consecutive words of an item, or all words of a shorter one; spans are the merged matches, with their code points
    in the text. Documents are read once in place, without a shuffle; words that occur in no item restart the
    automaton. Items are split into automata of bounded size by a hash, and each is read against all documents.
    Null and empty texts have no words; null ids and repeated rows stay; a null item id counts for hits but is not
    listed; no items or no documents give no matches; other columns are not read.
    """
    folder, names = _indexes(items, item_id_col, item_text_col, least, block_words)
    span = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, ItemIndex] = {}
        for batch in (s for b in batches for s in slices(b, 1)):
            texts = texts_of(batch.column(1))
            offsets, codes, words = split_words(mapped_bytes(texts, WORD_BYTES))
            words, rows = words.to_pylist(), len(offsets) - 1
            matches: list[list] = [[] for _ in range(rows)]
            found: list[set] = [set() for _ in range(rows)]
            for name in names:
                if name not in kept:
                    kept.clear()
                    kept[name] = pickle.loads(shared_files.get(folder, name))
                index = kept[name]
                numbers = np.array([index.numbers.get(w, -1) for w in words] or [-1])[codes] if len(codes) else codes
                shortest = min([least, *(n for by in index.short.values() for n in by)])
                for row, first, run in known_runs(numbers, offsets, shortest):
                    got, who = index.read(run)
                    matches[row] += [(first + s, first + e) for s, e in got]
                    found[row] |= who
            spans, hits = [], []
            for row, got in enumerate(matches):
                runs = merged(got)
                hits.append(sum(e - s for s, e in runs))
                places = [m.span() for m in WORD.finditer(texts[row].as_py())] if runs else []
                spans.append([{"first": s, "words": e - s, "start": places[s][0], "end": places[e - 1][1]} for s, e in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(hits, pa.int64()), pa.array(spans, span),
                 pa.array([sorted(x for x in f if x is not None) for f in found], pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "spans", "items"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        work, "doc_id long, n_words long, n_hit long, spans array<struct<first:long,words:long,start:long,end:long>>, items array<string>")


def known_runs(numbers: np.ndarray, offsets: np.ndarray, shortest: int) -> Iterator[tuple[int, int, list[int]]]:
    """Runs of at least ``shortest`` known words inside a row: row, first word, word numbers."""
    known = np.concatenate(([0], (numbers >= 0).astype(np.int8), [0]))
    turns = np.diff(known)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    if len(starts):  # cut runs where a row ends
        cuts = offsets[1:-1]
        inside = cuts[known[cuts + 1].astype(bool) & known[cuts].astype(bool)]
        starts, ends = np.unique(np.concatenate([starts, inside])), np.unique(np.concatenate([ends, inside]))
    keep = ends - starts >= shortest
    rows = np.searchsorted(offsets, starts[keep], side="right") - 1
    for row, start, end in zip(rows.tolist(), starts[keep].tolist(), ends[keep].tolist()):
        yield row, start - int(offsets[row]), numbers[start:end].tolist()


def decontaminate(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", least: int = 10, most_share: float = 0.5,
) -> DataFrame:
    """The documents without matched spans; documents with more than ``most_share`` of their words matched are left out.

    All columns and clean rows stay as they are. A cut text keeps everything outside its spans. Documents are read in
    place by their text: the id column need not be unique, and there is no join. Same automata and matches as
    ``find_contamination``.
    """
    folder, names = _indexes(items, item_id_col, item_text_col, least, BLOCK_WORDS)
    where = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, ItemIndex] = {}
        for batch in (s for b in batches for s in slices(b, where)):
            offsets, codes, words = split_words(mapped_bytes(texts_of(batch.column(where)), WORD_BYTES))
            words, matches = words.to_pylist(), {}
            for name in names:
                if name not in kept:
                    kept.clear()
                    kept[name] = pickle.loads(shared_files.get(folder, name))
                index = kept[name]
                numbers = np.array([index.numbers.get(w, -1) for w in words] or [-1])[codes] if len(codes) else codes
                shortest = min([least, *(n for by in index.short.values() for n in by)])
                for row, first, run in known_runs(numbers, offsets, shortest):
                    if got := index.read(run)[0]:
                        matches.setdefault(row, []).extend((first + s, first + e) for s, e in got)
            if not matches:
                yield batch
                continue
            texts, keep = batch.column(where).to_pylist(), np.ones(batch.num_rows, bool)
            for row, got in matches.items():
                runs = merged(got)
                places = [m.span() for m in WORD.finditer(texts[row])]
                keep[row] = sum(e - s for s, e in runs) <= most_share * len(places)
                edges = [0, *(x for s, e in runs for x in (places[s][0], places[e - 1][1])), len(texts[row])]
                texts[row] = "".join(texts[row][a:b] for a, b in zip(edges[::2], edges[1::2]))
            columns = list(batch.columns)
            columns[where] = pa.array(texts, batch.schema.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))

    return docs.mapInArrow(work, docs.schema)
