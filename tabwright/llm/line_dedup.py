"""Repeated line runs by a suffix array over line ids, built by distributed prefix doubling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tabwright.llm.batches import slices, texts_of
from tabwright.llm.staging import free_names, staged

LEAST_WORDS = 50
NO_ID = -(1 << 63)  # stands for a null document id, before all others
PLACE = "doc long, th long, pos int, need int"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, text): rows with the same id and text are one document here."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def line_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Lines that hold a word: row offsets, line codes, the distinct lines without outer white space, their words."""
    lists = pc.split_pattern(texts, "\n")
    coded = pc.ascii_trim_whitespace(lists.flatten()).dictionary_encode()
    words = pc.list_value_length(pc.ascii_split_whitespace(coded.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    words[pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)] = 0
    codes = coded.indices.to_numpy(zero_copy_only=False)
    full = words[codes] > 0 if len(codes) else np.zeros(0, bool)
    return np.concatenate(([0], np.cumsum(full)))[lists.offsets.to_numpy()], codes[full], coded.dictionary, words


def line_rows(docs: DataFrame, least_words: int) -> DataFrame:
    """Every line with a word: place, ``need`` (lines from here until ``least_words`` words are reached, 0 if never) and
    its id, 128 bits of hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 2)):
            offsets, codes, lines, words = line_table(texts_of(batch.column(2)))
            ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in lines.to_pylist()), "<i8").reshape(-1, 2)
            counts = np.diff(offsets)
            pos = np.arange(len(codes)) - np.repeat(offsets[:-1], counts)
            sums = np.concatenate(([0], np.cumsum(words[codes]))) if len(codes) else np.zeros(1, np.int64)
            reach = np.searchsorted(sums, sums[:-1] + least_words)
            need = np.where(reach <= np.repeat(offsets[1:], counts), reach - np.arange(len(codes)), 0)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pos, pa.int32()), pa.array(need, pa.int32()),
                 pa.array(ids[codes, 0]), pa.array(ids[codes, 1])], names=["doc", "th", "pos", "need", "r", "s"])

    return docs.mapInArrow(work, f"{PLACE}, r long, s long")


def ranked(pairs: DataFrame) -> DataFrame:
    """(r, s, rank) for the pairs that occur more than once: ranks follow the order of the pairs.

    Occurrences are counted before the shuffle, so a pair of any frequency is one row; distinct pairs are sorted by
    range. A rank is the number of the range and the place in it.
    """
    several = pairs.groupBy("r", "s").agg(F.count("*").alias("n")).where("n > 1").select("r", "s")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.arange(first, first + batch.num_rows))], names=["r", "s", "rank"])
            first += batch.num_rows

    return staged(several.repartitionByRange("r", "s").sortWithinPartitions("r", "s").mapInArrow(number, "r long, s long, rank long"), "ranks")


def paired(active: DataFrame, level: int) -> DataFrame:
    """From ranks of runs of 2^level lines: each place with its rank r and the rank s further on.

    ``need`` is kept. Rows with ``done`` false are runs twice as long; rows with ``done`` true are exactly the runs of
    ``need`` lines, put together from two overlapping ones.
    """
    length = 1 << level

    def rows(t: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        doc, th, pos, need, rank = t
        turn = np.concatenate(([False], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])))
        key = (np.cumsum(turn) << 32) + pos
        out = []
        for wanted, step, done in ((need >= 0, length, False), ((need >= length) & (need < 2 * length), need - length, True)):
            target = key + step
            at = np.minimum(np.searchsorted(key, target), len(key) - 1)
            hit = np.flatnonzero(wanted & (key[at] == target))
            out.append((doc[hit], th[hit], pos[hit], need[hit], rank[hit], rank[at[hit]], np.full(len(hit), done)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["doc", "th", "pos", "need", "r", "s", "done"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = tuple(c.to_numpy() for c in batch.columns)
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1])) if len(held[0]) else []
            if len(last):
                cut = int(last[-1]) + 1
                yield rows(tuple(c[:cut] for c in held))
                held = tuple(c[cut:] for c in held)
        if held is not None and len(held[0]):
            yield rows(held)

    order = ["doc", "th", "pos"]
    return active.repartition("doc", "th").sortWithinPartitions(*order).select(*order, "need", "rank").mapInArrow(
        work, f"{PLACE}, r long, s long, done boolean")


def later_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, th, start, end): line runs of (doc, th, text) that repeat an earlier one, order being that of document and line.

    Runs are the shortest with ``least_words`` words from each place; maximal ones follow by merging, since each
    place inside a maximal run starts one. They are the intervals of the suffix array whose common prefix is that long:
    ranks of 1, 2, 4, ... lines are built by doubling, and in each round places whose prefix occurs once are
    settled and leave. There are as many rounds as binary digits in the longest run needed, at most
    log2(least_words) + 1. Where a copy overlaps its own first occurrence, only what lies beyond that is listed.
    """
    pairs = staged(line_rows(docs, least_words), "lines")
    level, windows = 0, None
    while True:
        active = staged(pairs.join(ranked(pairs.select("r", "s")), ["r", "s"]).select("doc", "th", "pos", "need", "rank"), "active")
        longest = active.agg(F.max("need")).first()[0] or 0
        both = staged(paired(active, level), "pairs")
        own = both.where("done").select(F.lit(level).alias("level"), "doc", "th", "pos", "need", "r", "s")
        windows = own if windows is None else windows.union(own)
        level += 1
        if longest < 1 << level:
            break
        pairs = both.where("NOT done").drop("done")
    same = ["level", "need", "r", "s"]
    first = windows.groupBy(*same).agg(F.min(F.struct("doc", "th", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = staged(first, "first")  # so that the join below is one of plain exchanges, whose hot runs can be split
    joined = windows.join(first, same)
    beyond = F.when((F.col("doc") == F.col("first.doc")) & (F.col("th") == F.col("first.th")), F.greatest("pos", F.col("first.pos") + F.col("need"))).otherwise(F.col("pos"))
    return joined.where(F.struct("doc", "th", "pos") != F.col("first")).select(
        "doc", "th", beyond.alias("start"), (F.col("pos") + F.col("need")).alias("end")).where("start < end")


def cut_lines(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int, int]:
    """The text without the lines in ``runs`` (numbers of lines with a word), lines before, lines removed, maximal runs."""
    gone: set[int] = set()
    for start, end in runs:
        gone.update(range(start, end))
    kept, number = [], 0
    for line in text.split("\n"):
        blank = not line.strip(" \t\n\v\f\r")
        if blank or number not in gone:
            kept.append(line)
        number += not blank
    return "\n".join(kept), number, len(gone), sum(k - 1 not in gone for k in gone)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
                counts: Sequence[str] = ("n_lines", "n_removed", "n_runs")) -> DataFrame:
    """All rows and columns of ``docs`` with the later copies of repeated line runs of at least ``least_words`` words cut
    from the text, and n_lines, n_removed, n_runs (of lines that hold a word; ``counts`` may name them otherwise).

    Lines are compared without outer white space, and blank lines do not count. The first copy, in order of document
    id, hash of text and line, stays. Rows with the same id and text are one document and share its result; null ids
    come first; null texts stay null and have no lines; an empty table gives no rows. Columns of ``docs`` named
    like the three new ones are replaced (``staging.free_names`` finds names that are not).
    """
    base = keyed(docs, id_col, text_col)
    runs = later_copies(base, least_words)
    runs = runs.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("runs"))  # bounded by a document's lines
    names = [c for c in docs.columns if c not in counts]
    marked = docs.select(F.struct(*names).alias("row")).select(
        "row", F.coalesce(F.col(f"row.{id_col}").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(f"row.{text_col}").cast("string"), F.lit(""))).alias("th"))
    joined = marked.join(runs, ["doc", "th"], "left").select("row.*", F.col("runs").alias(free_names(docs.columns, ["runs"])[0]))
    where = names.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, where)):
            texts, found = [], []
            for text, own in zip(batch.column(where).to_pylist(), batch.column(len(names)).to_pylist()):
                cut, *n = cut_lines(text or "", [(r["start"], r["end"]) for r in own or ()])
                texts.append(None if text is None else cut)
                found.append(n)
            columns = list(batch.columns[:len(names)])
            columns[where] = pa.array(texts, batch.schema.field(where).type)
            columns += [pa.array([n[k] for n in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *counts])

    return joined.mapInArrow(work, T.StructType([*(docs.schema[c] for c in names), *(T.StructField(c, T.LongType()) for c in counts)]))
