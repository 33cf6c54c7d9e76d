"""Quality rules: length and repetition limits, and perplexity bands of each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tabwright.functions.state import cut_lineage, settle, small_rows
from tabwright.llm import shared_files
from tabwright.llm.batches import texts_of
from tabwright.llm.kneser_ney import language_of, scored, thawed

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 0.30
# Bands: from a quartile so many times its distance to the tail quantile outwards, further for short texts.
BAND, TAIL, STEPS, SHORT = 6.0, 0.10, 500, 60
LEAST_APART = 0.1  # nats


def repeated_words(codes: np.ndarray, offsets: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each row the number of its words in windows of ``width`` words that occur twice or more in it."""
    counts = np.diff(offsets)
    windows = np.maximum(0, counts - width + 1)
    rows = np.repeat(np.arange(len(counts)), windows)
    first = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(offsets[:-1], windows)
    out = np.zeros(len(counts), np.int64)
    if not len(first):
        return out
    key = rows.astype(np.uint64)
    for k in range(width):
        key = (key ^ codes[first + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    a, b = first[order[1:][same]], first[order[:-1][same]]
    ra, rb = rows[order[1:][same]], rows[order[:-1][same]]
    equal = ra == rb
    for k in range(width):
        equal &= codes[a + k] == codes[b + k]
    if not equal.all():  # two windows share a hash: count those windows by their words
        some = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
        table = np.stack([rows[some], *(codes[first[some] + k] for k in range(width))], axis=1)
        _, inverse, times = np.unique(table, axis=0, return_inverse=True, return_counts=True)
        marked = first[some[times[inverse.ravel()] > 1]]
    else:
        marked = np.unique(np.concatenate([a, b]))
    covered = np.zeros(offsets[-1] + 1, np.int64)
    np.add.at(covered, marked, 1)
    np.add.at(covered, marked + width, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered)[:-1] > 0)))
    return inside[offsets[1:]] - inside[offsets[:-1]]


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """For each row the lines that hold a word and equal an earlier line of it."""
    lists = pc.split_pattern(texts, "\n")
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    full = pc.not_equal(pc.ascii_trim_whitespace(coded.dictionary), "").to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    keep = full[codes] if len(codes) else np.zeros(0, bool)
    rows, codes = rows[keep], codes[keep].astype(np.int64)
    kinds = np.unique(rows * max(1, len(full)) + codes) // max(1, len(full))
    return np.bincount(rows, minlength=len(texts)) - np.bincount(kinds, minlength=len(texts))


def symbols(texts: pa.Array) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.diff(np.searchsorted(np.flatnonzero(table[raw]), offsets - offsets[0]))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = ", ".join(["lang string", *(f"{m} long" for m in MEASURES)])


def measures(batch: pa.RecordBatch, offsets: np.ndarray, inverse: np.ndarray, sizes: np.ndarray) -> tuple[list[pa.Array], list[str]]:
    """Of (text, lang), with words as codes and the length of each code: language and the five measures."""
    texts = texts_of(batch.column(0))
    chars = np.concatenate(([0], np.cumsum(sizes[inverse].astype(np.int64))))
    found = [np.diff(offsets), chars[offsets[1:]] - chars[offsets[:-1]], symbols(texts), repeated_lines(texts), repeated_words(inverse, offsets)]
    return [language_of(batch.column(1)).cast(pa.string()), *(pa.array(x, pa.int64()) for x in found)], ["lang", *MEASURES]


def bands(rows: DataFrame, width: float = BAND, tail: float = TAIL) -> DataFrame:
    """Per language the edges of the bands, over all texts that pass the limits: ``low`` of the mean log probability of a
    word, ``single_low`` and ``single_high`` of the same from followers alone, each with its distance from a quartile.

    An edge lies ``width`` times the distance between a quartile and the tail quantile behind it (at least LEAST_APART) beyond the
    quartile. Quantiles are taken from counts in steps of 1/500, so they do not depend on how rows are dealt.
    """
    n = F.nullif(F.col("n_words"), F.lit(0))
    passed = rows.where("NOT base_failed").select("lang", F.explode(F.array(
        *(F.struct(F.lit(k).alias("of"), F.round(F.col(c) / n * STEPS).cast("long").alias("step")) for k, c in enumerate(("log_p", "log_single"))))).alias("x"))
    counts = passed.groupBy("lang", "x.of", "x.step").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang", "of").orderBy("step")
    share = counts.select("lang", "of", "step", (F.sum("n").over(order) / F.sum("n").over(Window.partitionBy("lang", "of"))).alias("share"))

    def quantile(of: int, q: float):
        return F.min(F.when((F.col("of") == of) & (F.col("share") >= q), F.col("step"))) / STEPS

    def edge(name: str, of: int, quartile: float, behind: float):
        apart = F.greatest(F.abs(quantile(of, quartile) - quantile(of, behind)), F.lit(LEAST_APART))
        return quantile(of, quartile).alias(name), (apart * width).alias(f"{name}_wide")

    return share.groupBy("lang").agg(*edge("low", 0, 0.25, tail), *edge("single_low", 1, 0.25, tail), *edge("single_high", 1, 0.75, 1 - tail))


EDGES = ("low", "low_wide", "single_low", "single_low_wide", "single_high", "single_high_wide")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", width: float = BAND) -> DataFrame:
    """One row per document: doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    perplexity, upper, single_perplexity, single_lower, single_upper, kept.

    Limits: at least 20 words, at most 30 % of them in repeated 8-word windows. A document that passes them is kept if
    its perplexity (of a word after the word before it) is not above the upper band of its language, and its perplexity
    from followers alone (how many different words a word follows) lies between a lower and an upper one. The lower band
    does not use pair counts, since those make every copy of a clean text predictable; followers are counted once,
    however many copies there are. Bands are wider for short texts by sqrt(1 + 60 / words). The model counts all
    documents, those that fail too, and a document's own words are among them. Documents are read once and never shuffled.
    Null texts have no words and fail; a null language is a language of its own ('und'); null ids and repeated rows stay;
    an empty table gives no rows; other columns are not read. A text above 12 MB is worked on whole.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows, _ = scored(own, "text", "lang", ["doc_id"], 1, measures, f"doc_id long, {FIELDS}")
    rows = cut_lineage(rows.withColumn("base_failed", failed()))
    return with_verdict(rows, bands(rows, width)).drop(*EDGES, "slice", "at", "log_p", "log_single")


def failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 100 * MOST_REPEATED * F.col("n_words"))


def with_verdict(rows: DataFrame, band: DataFrame) -> DataFrame:
    n = F.nullif(F.col("n_words"), F.lit(0))
    pair, single, wide = F.col("log_p") / n, F.col("log_single") / n, F.sqrt(1 + F.lit(SHORT) / n)
    low, single_low, single_high = (F.col(e) + sign * F.col(f"{e}_wide") * wide for e, sign in (("low", -1), ("single_low", -1), ("single_high", 1)))
    inside = (pair >= low) & (single >= single_low) & (single <= single_high)
    return rows.join(band, "lang", "left").withColumns({
        "perplexity": F.exp(-pair), "upper": F.exp(-low), "single_perplexity": F.exp(-single), "single_lower": F.exp(-single_high),
        "single_upper": F.exp(-single_low), "kept": ~F.col("base_failed") & F.coalesce(inside, F.lit(False))})


def keep_good(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", width: float = BAND) -> DataFrame:
    """The documents that are kept, with all their columns. Rows are judged by their place, so ids need not be unique.

    Rows wait in the files of their slices; only places and verdicts are shuffled.
    """
    columns = docs.columns
    plain = docs.toDF(*[f"_{k}" for k in range(len(columns))])
    rows, folder = scored(plain, f"_{columns.index(text_col)}", f"_{columns.index(lang_col)}", plain.columns, 0, measures, FIELDS)
    rows = cut_lineage(rows.withColumn("base_failed", failed()))
    band = settle(bands(rows, width))
    small_rows(band, "languages")  # an error if there are too many to broadcast
    places = with_verdict(rows, F.broadcast(band)).where("kept").select("slice", "at")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []

        def chosen() -> Iterator[pa.RecordBatch]:
            if held:
                own = thawed(shared_files.get(folder, f"rows-{number}")).take(pa.array(np.concatenate(held)))
                yield from (own.slice(k, 5_000) for k in range(0, own.num_rows, 5_000))

        for batch in batches:
            of, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    if of[a] != number:
                        yield from chosen()
                        number, held = int(of[a]), []
                    held.append(at[a:b])
        yield from chosen()

    kept = places.repartition(parts, "slice").sortWithinPartitions("slice", "at").mapInArrow(read, plain.schema)
    return kept.toDF(*columns)
