"""Phrase collocations: words that stand together more often than their parts would make them.

Tasks count packed word ids in a HAT-trie (``hat_trie``) and spill whole subtrees as sorted runs; runs meet by prefix
partition, are merged in order and summed. First single words are counted, then phrases of two and three words.

A phrase can be frequent only if its parts are, and most phrases are not. So the second count takes only phrases that pass
bitmaps: one of frequent words, and one of frequent pairs, made by counting pairs as 48-bit hashes in between. The bitmaps
have a fixed size whatever the corpus; a false positive costs a count, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions.state import scratch_path
from tabwright.llm import shared_files
from tabwright.llm.batches import give_back, mapped_bytes, slices, split_words, texts_of
from tabwright.llm.hat_trie import HatTrie, packed, unpacked
from tabwright.llm.staging import staged

# Entries of a task's trie and words of its dictionary, beyond which subtrees are spilled.
TRIE_ENTRIES = 1_000_000
TRIE_WORDS = 400_000
SLICE_BYTES = 4_000_000
TEXT_BYTES = 4_000_000  # longer texts are worked on in parts, cut between pieces
SHARES = 64  # into which a language's candidates are dealt before they are ranked
MAP_BITS = 27  # 16 MB
BLOCK_BITS = 20
# ends of pieces become line feeds, tabs become spaces, A-Z become a-z
PIECES = bytes(10 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCK_WORDS = 2_000_000  # hashes of pairs that are counted at a time, about
RUN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])
RUN_DDL = "lang string, phrase string, k int, f long"
_MAPS: dict[str, np.ndarray] = {}


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def mixed(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases, from those of the language and of one or two words. The upper bits are the place in the bitmap."""
    state = lang.astype(np.uint64)
    for word in words:
        state = (state ^ word) * np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(29)
    return state * np.uint64(0xBF58476D1CE4E5B9)


def in_pieces(texts: pa.Array, langs: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Mapped texts, long ones as several rows cut between pieces. A single piece without an end stays whole."""
    mapped = mapped_bytes(texts, PIECES)
    sizes = pc.binary_length(mapped).to_numpy(zero_copy_only=False)
    if not len(sizes) or sizes.max() <= TEXT_BYTES:
        return mapped, langs
    out, rows = [], []
    for row, text in enumerate(mapped):
        left = text.as_py().encode()
        while len(left) > TEXT_BYTES:
            cut = left.rfind(b"\n", 0, TEXT_BYTES) + 1 or left.find(b"\n") + 1 or len(left)
            out.append(left[:cut].decode())
            rows.append(row)
            left = left[cut:]
        out.append(left.decode())
        rows.append(row)
    return pa.array(out, pa.large_string()), langs.take(pa.array(rows))


def adjacent(mapped: pa.Array, rows: np.ndarray, n_words: int) -> np.ndarray:
    """Whether each word and the next one lie in the same piece of the same text."""
    if n_words < 2:
        return np.zeros(max(n_words - 1, 0), bool)
    bounds = np.frombuffer(mapped.buffers()[1], np.int64)[mapped.offset:mapped.offset + len(mapped) + 1]
    raw = np.frombuffer(mapped.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    inside = (raw != 32) & (raw != 10)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = (bounds[:-1] - bounds[0])[bounds[:-1] < bounds[1:]]
    begins[firsts] = inside[firsts]
    piece = np.cumsum(raw == 10, dtype=np.int32)[begins]
    return (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])


def _loaded(folder: str) -> np.ndarray:
    if folder not in _MAPS:
        while len(_MAPS) > 1:
            del _MAPS[next(iter(_MAPS))]
        whole = np.zeros(1 << (MAP_BITS - 3), np.uint8)
        step = 1 << (BLOCK_BITS - 3)
        for block in range(1 << (MAP_BITS - BLOCK_BITS)):
            content = shared_files.get_if_there(folder, f"block-{block}")
            if content:
                whole[block * step:(block + 1) * step] = np.frombuffer(content, np.uint8)
        _MAPS[folder] = whole
    return _MAPS[folder]


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Worded:
    """The words of some texts: code, language and text row of each, and which stand next to each other."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        mapped, langs = in_pieces(texts, langs)
        offsets, self.codes, words = split_words(mapped)
        langs = langs.dictionary_encode()
        self.names = langs.dictionary.to_pylist()
        rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int32)[rows]
        self.words = [w.encode() for w in words.to_pylist()]
        self.close = adjacent(mapped, rows, len(self.codes))

    def pairs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of two neighbouring words that are in the bitmap of frequent words, and their hashes."""
        hashes = np.fromiter(map(_hash, self.words), np.uint64, len(self.words))[self.codes]
        lang = np.fromiter((_hash(n.encode()) for n in self.names), np.uint64, len(self.names))[self.lang]
        known = _holds(words, mixed(lang, [hashes]))
        places = np.flatnonzero(self.close & known[1:] & known[:-1]) if len(known) > 1 else np.zeros(0, np.int64)
        return places, mixed(lang[places], [hashes[places], hashes[places + 1]])


class PhraseCounter:
    """What one task counts: single words, or phrases of two and three words that pass the bitmaps."""

    def __init__(self, entries: int = TRIE_ENTRIES, words: int = TRIE_WORDS):
        self.entries, self.words = entries, words
        self.trie, self.ids, self.totals = HatTrie(), {}, {}

    def count_words(self, text: Worded) -> Iterator[pa.RecordBatch]:
        for name, count in zip(text.names, np.bincount(text.lang, minlength=len(text.names)).tolist()):
            self.totals[name] = self.totals.get(name, 0) + count
        yield from self._add(text, [(np.arange(len(text.codes)), 1)])

    def count_phrases(self, text: Worded, words: np.ndarray, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
        places, hashes = text.pairs(words)
        twos = places[_holds(pairs, hashes)]
        known = np.zeros(max(len(text.codes) - 1, 0), bool)
        known[twos] = True
        yield from self._add(text, [(twos, 2), (np.flatnonzero(known[1:] & known[:-1]), 3)])

    def _add(self, text: Worded, phrases: list[tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(len(text.codes), bool)
        for places, order in phrases:
            for step in range(order):
                used[places + step] = True
        n_words = max(len(text.words), 1)
        pairs, place_of = np.unique(text.lang[used].astype(np.int64) * n_words + text.codes[used], return_inverse=True)
        own = np.fromiter((self.ids.setdefault((text.names[p // n_words], text.words[p % n_words]), len(self.ids)) for p in pairs.tolist()),
                          np.int64, len(pairs))
        ids = np.zeros(len(text.codes), np.int64)
        ids[used] = own[place_of]
        for places, order in phrases:
            for start in range(0, len(places), 500_000):
                part = places[start:start + 500_000]
                self.trie.add(packed([ids[part + k] for k in range(order)]))
                if self.trie.entries > self.entries:
                    yield from self.runs(0.5)
        if len(self.ids) > self.words:
            yield from self.runs(1.0)
            self.ids = {}

    def runs(self, share: float) -> Iterator[pa.RecordBatch]:
        """Subtrees as rows in the order of their word ids."""
        if not self.trie.entries:
            return
        langs, words = zip(*self.ids)
        langs, words = pa.array(langs, pa.string()), pa.array([w.decode() for w in words], pa.string())
        for keys, counts in self.trie.spill(share):
            for start in range(0, len(keys), 50_000):
                ids, own = unpacked(keys[start:start + 50_000]), counts[start:start + 50_000]
                sizes = sum((i >= 0).astype(np.int32) for i in ids)
                for order in np.unique(sizes).tolist():
                    at = sizes == order
                    parts = [pa.array(i[at]) for i in ids[:order]]
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(parts[0]), pc.binary_join_element_wise(*(words.take(p) for p in parts), " "), pa.array(sizes[at]), pa.array(own[at])], schema=RUN)
        give_back()

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.runs(1.0)
        if self.totals:  # all words of a language: the row without a phrase
            n = len(self.totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(self.totals), pa.string()), pa.nulls(n, pa.string()), pa.array([0] * n, pa.int32()), pa.array(list(self.totals.values()), pa.int64())],
                schema=RUN)


def merged(least: int):
    """Sum neighbouring equal rows of sorted runs; phrases below ``least`` go, totals (no phrase) stay."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch.cast(RUN)])
            table = table if last is None else pa.concat_tables([last, table]).combine_chunks()
            lang, phrase = (table[c].combine_chunks() for c in ("lang", "phrase"))
            same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.or_(pc.fill_null(pc.equal(phrase[1:], phrase[:-1]), False),
                                                                pc.and_(pc.is_null(phrase[1:]), pc.is_null(phrase[:-1]))))
            firsts = np.concatenate(([0], 1 + np.flatnonzero(~same.to_numpy(zero_copy_only=False))))
            sums = np.add.reduceat(table["f"].to_numpy(), firsts)
            firsts = pa.array(firsts)
            table = pa.table([lang.take(firsts), phrase.take(firsts), table["k"].combine_chunks().take(firsts), pa.array(sums)], schema=RUN)
            last = table[-1:]
            yield from _kept(table[:-1], least)
        if last is not None:
            yield from _kept(last, least)
    return work


def _kept(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    yield from table.filter(pc.or_(pc.is_null(table["phrase"]), pc.greater_equal(table["f"], least))).to_batches()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Worded]:
    for batch in (s for b in batches for s in slices(b, 1, SLICE_BYTES)):
        yield Worded(texts_of(batch.column(1)), batch.column(0))


def counted(docs: DataFrame, least: int, maps: tuple[str, str] | None, entries: int, words: int) -> DataFrame:
    """(lang, phrase, k, f): words with ``least`` occurrences and each language's total, or with ``maps`` phrases of two and three words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(entries, words)
        bits = [_loaded(folder) for folder in maps or ()]
        for text in _read(batches):
            yield from counter.count_phrases(text, *bits) if bits else counter.count_words(text)
        yield from counter.finish()

    runs = docs.mapInArrow(work, RUN_DDL)
    # a prefix partition is a first word; its continuations are dealt into sixteen, for very common words
    runs = runs.repartition("lang", F.substring_index("phrase", " ", 1), F.pmod(F.xxhash64("phrase"), F.lit(16)))
    return staged(runs.sortWithinPartitions("lang", "phrase").mapInArrow(merged(least), RUN_DDL), "phrases")


def frequent_words(single: DataFrame) -> str:
    """The folder of the bitmap of (lang, word) rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names = np.array([_hash(n.encode()) for n in langs.dictionary.to_pylist()], np.uint64)
            words = np.array([_hash(w.encode()) for w in batch.column(1).to_pylist()], np.uint64)
            yield _places(mixed(names[langs.indices.to_numpy(zero_copy_only=False)], [words]))

    return _bitmap(single.select("lang", "phrase").mapInArrow(work, "block int, place long"))


def frequent_pairs(docs: DataFrame, words: str, least: int, n_words: int) -> str:
    """The folder of the bitmap of pairs whose hash occurs ``least`` times: counted in ranges of the hash."""
    range_bits = max(6, min(30, (n_words // BLOCK_WORDS).bit_length()))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _loaded(words)
        for text in _read(batches):
            codes, counts = np.unique(text.pairs(bits)[1] >> np.uint64(16), return_counts=True)
            # more than ``least`` in one slice are as good as ``least``: very common pairs stay few
            codes = np.repeat(codes, np.minimum(counts, least))
            part = (codes >> np.uint64(48 - range_bits)).astype(np.int32)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            low, high = codes.astype("<u4"), (codes >> np.uint64(32)).astype("<u2")
            ends = [*cuts[1:].tolist(), len(codes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts]), pa.array([low[s:e].tobytes() + high[s:e].tobytes() for s, e in zip(cuts.tolist(), ends)], pa.binary())], names=["part", "codes"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for own, codes in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != part and held:
                    yield _places(_often(held, least))
                    held = []
                part = own
                held.append(codes.as_buffer())
        if held:
            yield _places(_often(held, least))

    runs = docs.mapInArrow(collect, "part int, codes binary").repartition("part").sortWithinPartitions("part")
    return _bitmap(runs.mapInArrow(count, "block int, place long"))


def _often(held: list[pa.Buffer], least: int) -> np.ndarray:
    """Hashes (their upper 48 bits) that occur ``least`` times in buffers of 4 + 2 bytes."""
    codes = np.concatenate([
        np.frombuffer(b, "<u4", b.size // 6).astype(np.uint64) | np.frombuffer(b, "<u2", b.size // 6, b.size // 6 * 4).astype(np.uint64) << np.uint64(32) for b in held])
    codes.sort()
    last = codes[least - 1:]
    return np.unique(last[last == codes[:len(last)]]) << np.uint64(16)


def _places(hashes: np.ndarray) -> pa.RecordBatch:
    at = np.unique(hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array((at >> BLOCK_BITS).astype(np.int32)), pa.array(at)], names=["block", "place"])


def _bitmap(places: DataFrame) -> str:
    """Bits at the places, in blocks of fixed size, each written by the task that holds it."""
    folder = scratch_path(places.sparkSession, "frequent")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            block, place = (batch.column(k).to_numpy() for k in range(2))
            for b in np.unique(block).tolist():
                bits = own.setdefault(b, np.zeros(1 << (BLOCK_BITS - 3), np.uint8))
                at = place[block == b] & ((1 << BLOCK_BITS) - 1)
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for b, bits in own.items():
            shared_files.put(folder, f"block-{b}", bits.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int64())], names=["n"])

    places.dropDuplicates(["block", "place"]).repartition("block").mapInArrow(blocks, "n long").agg(F.sum("n")).collect()
    return folder


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    exact = "decimal(16,0)"
    return F.expr(f"CAST(1000000 AS decimal(7,0)) * CAST({a} AS {exact}) * CAST({a} AS {exact}) DIV (CAST({left} AS {exact}) * CAST({right} AS {exact}))")


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 10, drop_percent: int = 50, top: int | None = 2000,
    entries: int = TRIE_ENTRIES, words: int = TRIE_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut: phrases of two and three words, best first, ``top`` of each language.

    A-Z are lower-cased; pieces end at ``. , ; : ! ?`` and line ends; words are what spaces and tabs part. ``a`` is the
    number of occurrences inside pieces; the phrase is cut after ``cut`` words into parts with ``l`` and ``r`` occurrences,
    where floor(10^6 a^2 / (l r)) is least (ties: the first cut); ``n`` counts all words of the language. Two-word phrases
    inside a three-word one with ``drop_percent`` of their occurrences go. Phrases with fewer than ``least``
    occurrences are no candidates. Ties in rank: score, then a, then the phrase's bytes.

    A null text is empty; a null language is ``und``; repeated rows count again; other columns are not read; an empty
    table has no rows. A task holds at most ``entries`` phrases and about ``words`` words (one slice of text more); texts
    of any length are read in parts, but one piece without an end is held whole.
    """
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    one = counted(docs, least, None, entries, words)
    totals = one.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    single = one.where("phrase IS NOT NULL")
    frequent = frequent_words(single)
    pairs = frequent_pairs(docs, frequent, least, totals.agg(F.sum("n")).first()[0] or 0)
    longer = counted(docs, least, (frequent, pairs), entries, words)
    two, three = longer.where("k = 2"), longer.where("k = 3")

    def part(frame: DataFrame, key: str, count: str) -> DataFrame:
        return frame.select("lang", F.col("phrase").alias(key), F.col("f").alias(count))

    head, tail = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    pairs = (
        two.select("lang", "phrase", F.col("f").alias("a"), head.alias("head"), tail.alias("tail"))
        .join(part(single, "head", "l"), ["lang", "head"]).join(part(single, "tail", "r"), ["lang", "tail"])
        .select("lang", "phrase", "a", F.lit(1).alias("cut"), "l", "r", _score("a", "l", "r").alias("score"))
    )
    triples = (
        three.select("lang", "phrase", F.col("f").alias("a"), head.alias("head"), tail.alias("tail"),
                     F.substring_index("phrase", " ", 2).alias("first_two"), F.substring_index("phrase", " ", -2).alias("last_two"))
        .join(part(single, "head", "l1"), ["lang", "head"]).join(part(two, "last_two", "r1"), ["lang", "last_two"])
        .join(part(two, "first_two", "l2"), ["lang", "first_two"]).join(part(single, "tail", "r2"), ["lang", "tail"])
        .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    )
    first = F.col("s1") <= F.col("s2")
    ranked_triples = triples.select(
        "lang", "phrase", "a", F.when(first, 1).otherwise(2).alias("cut"), F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    around = (
        three.select("lang", F.explode(F.array_distinct(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)))).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    pairs = pairs.join(around, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {int(drop_percent)} * a").drop("longer")
    best = pairs.unionByName(ranked_triples)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    if top is not None:  # a language's best are among the best of its shares: no task ranks all of a language
        best = best.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top).drop("share")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        best = best.where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"), "cut")


def collocations_sql(least: int = 10, drop_percent: int = 50, top: int = 2000) -> str:
    """The same in DuckDB's SQL, for tables small enough to list every phrase."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, '{capitals}', '{capitals.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
sizes AS (SELECT unnest([1, 2, 3]) AS k),
placed AS (
  SELECT lang, k, ws, unnest(range(1, CAST(len(ws) AS BIGINT) - k + 2)) AS i FROM worded CROSS JOIN sizes WHERE len(ws) >= k),
counted AS (SELECT lang, k, ws[i:i + k - 1] AS g, count(*) AS f FROM placed GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.k, c.g, c.f AS a, x.k AS cut, x.f AS l, y.f AS r,
         CAST((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM counted c
  JOIN counted x ON x.lang = c.lang AND x.k < c.k AND x.g = c.g[1:x.k]
  JOIN counted y ON y.lang = c.lang AND y.k = c.k - x.k AND y.g = c.g[x.k + 1:]
  WHERE c.k > 1 AND c.f >= {least}),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM lowest p WHERE k = 3 OR NOT EXISTS (
    SELECT 1 FROM lowest t WHERE t.lang = p.lang AND t.k = 3 AND (t.g[1:2] = p.g OR t.g[2:3] = p.g) AND 100 * t.a >= {drop_percent} * p.a)),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score, CAST(cut AS INTEGER) AS cut,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score, cut FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""
