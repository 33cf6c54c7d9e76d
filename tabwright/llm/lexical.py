"""Ranked lexical search: every document's term impacts fold into a short sketch of maxima; sketches bound scores from above.

For a batch of queries one product of sketches and query weights looks up all coordinates and gives the bounds of all documents. Documents are
scored exactly in the order of falling bounds until no bound reaches the score of the last place.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabwright.llm.batches import WORD_BYTES, give_back, mapped_bytes, ranges, slices, split_words, texts_of

COORDINATES = 1024
QUERIES_AT_ONCE = 1000  # queries searched in one pass over the documents
SLICE_BYTES = 6_000_000
SLACK = 1.0001  # above the rounding of single-precision sums
FIRST = 16  # documents of a query scored in the first round; doubled from round to round
MAX_ID = np.iinfo(np.int64).max  # stands for a null id, which is last among equal scores


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(terms with repeats of each text; text, term and count of each distinct pair, ordered; the terms)."""
    offsets, codes, words = split_words(mapped_bytes(texts, WORD_BYTES))
    sizes = np.diff(offsets)
    wide = max(len(words), 1)
    keys, counts = np.unique(np.repeat(np.arange(len(sizes)) * wide, sizes) + codes, return_counts=True)
    return sizes, keys // wide, keys % wide, counts, [w.encode() for w in words.to_pylist()]


def folded(terms: list[bytes], coordinates: int) -> np.ndarray:
    """The coordinate of each term."""
    return np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % coordinates


def impacts(counts: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's part of a score before its weight: whole numbers, rounded down."""
    norm = 100 - 75 + (75 * sizes.astype(np.int64) * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * norm)


def sketches(rows: np.ndarray, places: np.ndarray, impact: np.ndarray, n_rows: int, coordinates: int) -> np.ndarray:
    """Coordinatewise maxima of the impacts of each text's terms."""
    flat = np.zeros(n_rows * coordinates, np.float32)
    np.maximum.at(flat, rows * coordinates + places, impact.astype(np.float32))
    return flat.reshape(n_rows, coordinates)


class Queries:
    """A block of queries as sparse term rows, after the weights of their terms are known."""

    def __init__(self, texts: list[str | None]):
        self.numbers: dict[bytes, int] = {}
        starts, terms, repeats = [0], [], []
        for text in texts:
            found = Counter((text or "").encode().translate(WORD_BYTES).split())
            terms += [self.numbers.setdefault(t, len(self.numbers)) for t in found]
            repeats += found.values()
            starts.append(len(terms))
        self.starts, self.terms = np.array(starts, np.int64), np.array(terms, np.int64)
        self.repeats, self.weights = np.array(repeats, np.int64), np.zeros(len(terms), np.int64)

    def weigh(self, n_docs: int, holders: dict[int, int]) -> None:
        each = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(t, 0) + 1))) for t in range(len(self.numbers))]
        self.weights = np.array(each, np.int64)[self.terms] * self.repeats if each else self.weights

    def numbered(self, terms: list[bytes]) -> np.ndarray:
        return np.fromiter((self.numbers.get(t, -1) for t in terms), np.int64, len(terms))

    def matrix(self, coordinates: int) -> np.ndarray:
        """Weight of each coordinate in each query."""
        place = folded(list(self.numbers), coordinates)
        whole = np.zeros((coordinates, len(self.starts) - 1), np.float32)
        np.add.at(whole, (place[self.terms], np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))), self.weights)
        return whole


class Best:
    """The ``top`` best documents of each query so far: rows ordered by query, falling score, rising id."""

    def __init__(self, n_queries: int, top: int):
        self.n_queries, self.top = n_queries, top
        self.query = self.score = self.doc = np.zeros(0, np.int64)
        self.least = np.ones(n_queries, np.int64)  # a score of 0 is no match

    def add(self, query: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        found = score > 0
        query, score, doc = (np.concatenate((old, new[found])) for old, new in ((self.query, query), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, query))
        query, score, doc = query[order], score[order], doc[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.query, self.score, self.doc = (a[place < self.top] for a in (query, score, doc))
        last = place == self.top - 1
        self.least[query[last]] = score[last]


def search_slice(best: Best, queries: Queries, weights: np.ndarray, doc_ids: np.ndarray, texts: pa.Array, n_docs: int, n_terms: int) -> int:
    """Take the documents of one slice into ``best``; the number of exact scores this took."""
    sizes, rows, terms, counts, words = term_counts(texts)
    if not len(rows) or not len(queries.terms):
        return 0
    impact = impacts(counts, sizes[rows], n_docs, n_terms)
    bounds = sketches(rows, folded(words, len(weights))[terms], impact, len(sizes), len(weights)) @ weights
    bounds *= np.float32(SLACK)
    asked = queries.numbered(words)[terms]
    wide = len(queries.numbers)
    own = np.flatnonzero(asked >= 0)
    keys = rows[own] * wide + asked[own]
    order = np.argsort(keys)
    keys, values = keys[order], impact[own][order]

    def exact(query: np.ndarray, row: np.ndarray) -> np.ndarray:
        starts, lengths = queries.starts[query], queries.starts[query + 1] - queries.starts[query]
        at = ranges(starts, lengths)
        wanted = np.repeat(row * wide, lengths) + queries.terms[at]
        place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        parts = np.where(keys[place] == wanted, queries.weights[at] * values[place], 0) if len(keys) else np.zeros(len(at), np.int64)
        sums = np.concatenate(([0], np.cumsum(parts)))
        ends = np.cumsum(lengths)
        return sums[ends] - sums[ends - lengths]

    row, query = np.nonzero(bounds >= best.least)  # least is 1 at first, so bounds of 0 never count
    bound = bounds[row, query]
    order = np.lexsort((-bound, query))
    row, query, bound = row[order], query[order], bound[order]
    scored, at_once = 0, FIRST
    while len(query):
        now = np.arange(len(query)) - np.searchsorted(query, query) < at_once
        best.add(query[now], exact(query[now], row[now]), doc_ids[row[now]])
        scored += int(now.sum())
        later = ~now & (bound >= best.least[query])
        row, query, bound = row[later], query[later], bound[later]
        at_once *= 2
    return scored


def search(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    top: int = 10, coordinates: int = COORDINATES, queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring documents of each item, equal scores by rising id.

    Terms are runs of A-Z (lower-cased), a-z, digits and non-ASCII characters. Weights and impacts are whole numbers.
    Items are searched in blocks of about ``queries_at_once``, dealt by a hash; each block reads the documents twice in place
    (counts of its terms, then the search) and shuffles ``top`` rows per item and task. At the driver: the items of one
    block, and one count for each of their terms.

    Ids of documents are whole numbers; a null id comes last among equal scores, and rows that repeat are documents of their own.
    Null or empty texts have no terms and are never found; such items find nothing. Items that repeat give
    their rows again. No documents or no items: no rows. Other columns are not read. A text above a slice (6 MB) is
    held whole, at some thirty times its size.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    blocks = max(1, -(-items.count() // queries_at_once))
    out = None
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = part.toArrow().to_pylist()
        found = _search_block(docs, [r["text"] for r in rows], top, coordinates)
        names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], f"query long, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = found.join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def _search_block(docs: DataFrame, texts: list[str | None], top: int, coordinates: int) -> DataFrame:
    queries = Queries(texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        holders = np.zeros(len(queries.numbers) + 1, np.int64)
        for batch in (s for b in batches for s in slices(b, 0, SLICE_BYTES)):
            sizes, _, terms, _, words = term_counts(texts_of(batch.column(0)))
            n_docs, n_terms = n_docs + int((sizes > 0).sum()), n_terms + int(sizes.sum())
            holders += np.bincount(queries.numbered(words)[terms] + 1, minlength=len(holders))
        holders = holders[1:]
        used = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((used, [-1, -2]))), pa.array(np.concatenate((holders[used], [n_docs, n_terms])))], names=["term", "n"])

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pylist()
    counted = {r["term"]: r["n"] for r in sums}
    n_docs, n_terms = counted.get(-1, 0), counted.get(-2, 0)
    queries.weigh(n_docs, counted)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, best = queries.matrix(coordinates), Best(len(texts), top)
        for batch in (s for b in batches for s in slices(b, 1, SLICE_BYTES)):
            ids = batch.column(0).fill_null(MAX_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            search_slice(best, queries, weights, ids, texts_of(batch.column(1)), n_docs, n_terms)
        give_back()
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.query), pa.array(best.doc, mask=best.doc == MAX_ID), pa.array(best.score)], names=["query", "doc_id", "score"])

    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return docs.mapInArrow(find, "query long, doc_id long, score long").withColumn("rank", rank).where(F.col("rank") <= top)


def search_sql(top: int = 10) -> str:
    """The same in DuckDB's SQL: every term of every document."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def terms(table: str, name: str) -> str:
        return (f"SELECT {name}, unnest(regexp_extract_all(translate(text, '{capitals}', '{capitals.lower()}'), "
                rf"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {table} WHERE text IS NOT NULL")

    return f"""
WITH d AS ({terms('documents', 'doc_id')}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sizes),
q AS (SELECT item_id, term, count(*) AS qf FROM ({terms('benchmark', 'item_id')}) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN whole GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // nt)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (doc_id) CROSS JOIN whole GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {top}
"""
