"""Near-duplicates by exact Jaccard similarity of word shingles, for what lies further apart than fingerprints can link.

Two texts with 0.8 of their five-word shingles in common differ in up to about 14 of 64 SimHash bits, which no covering
code reaches at a bearable replication. So candidates come from the anchors of ``simhash`` (up to 3 bits) and from
bands of minimum hashes; both are checked against the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabwright.llm.batches import LOWER, mapped_bytes, slices, split_words, texts_of
from tabwright.llm.components import components
from tabwright.llm.line_dedup import NO_ID, keyed
from tabwright.llm.simhash import SHINGLED, links, majority_bits, shingle_hashes
from tabwright.llm.staging import staged

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 25, 5  # a pair at 0.8 shares a band with probability 0.9999
HASHES = BANDS * ROWS
SLACK = 0.15  # estimates this far below ``least`` are still checked; a pair at 0.8 falls below with probability 0.00002
CHUNK = 1024
FACTORS = (np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
RESIDUES = np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def shingles_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(*split_words(mapped_bytes(texts, LOWER)), width)


def sketches(base: DataFrame, width: int) -> DataFrame:
    """(doc, th, node, fp, sig, bands): ``node`` is a hash of the set of shingles, ``sig`` a byte of each minimum hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 2, SHINGLED)):
            hashes, offsets = shingles_of(texts_of(batch.column(2)), width)
            counts = np.diff(offsets)
            full = np.flatnonzero(counts)
            least = np.zeros((len(counts), HASHES), np.uint64)
            if len(full):
                for k in range(HASHES):
                    mixed = (hashes ^ RESIDUES[k]) * FACTORS[k]
                    least[full, k] = np.minimum.reduceat(mixed ^ mixed >> np.uint64(32), offsets[:-1][full])
            bands = np.zeros((len(counts), BANDS), np.uint64)
            for r in range(ROWS):
                bands = (bands ^ least[:, r::ROWS]) * np.uint64(0x94D049BB133111EB)
                bands ^= bands >> np.uint64(29)
            nodes = [xxhash.xxh3_64_intdigest(np.unique(hashes[a:b]).tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(majority_bits(hashes, offsets).view(np.int64)),
                 pa.array([row.tobytes() for row in (least & np.uint64(255)).astype(np.uint8)], pa.binary()),
                 pa.array(list(bands.view(np.int64)), pa.list_(pa.int64()))], names=["doc", "th", "node", "fp", "sig", "bands"])

    return base.mapInArrow(work, "doc long, th long, node long, fp long, sig binary, bands array<long>")


def strongest_forest(sigs: np.ndarray, least: int) -> list[tuple[int, int]]:
    """A maximum spanning forest of rows over pairs with at least ``least`` equal bytes, strongest pairs first.

    In each round every tree takes its strongest pair to another tree.
    """
    n = len(sigs)
    equal = _equal(sigs, sigs)
    equal[equal < least] = 0
    np.fill_diagonal(equal, 0)
    tree, out = np.arange(n), []
    while True:
        equal[tree[:, None] == tree[None, :]] = 0
        best = equal.argmax(axis=1)
        strength = equal[np.arange(n), best]
        if not strength.any():
            return out
        for t in np.unique(tree[strength > 0]).tolist():
            own = np.flatnonzero(tree == t)
            if not len(own):  # joined to another tree in this round
                continue
            a = int(own[strength[own].argmax()])
            b = int(best[a])
            if strength[a] and tree[a] != tree[b]:
                out.append((a, b))
                tree[tree == tree[b]] = tree[a]


FOUND = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by their first column, cut so that no value of it is in two batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        first = batch.column(0).to_numpy()
        if not len(first):
            continue
        if held and held[-1].column(0)[0].as_py() != int(first[0]):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        cut = int(np.searchsorted(first, first[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each value of the first column, by which they are sorted, as one batch."""
    for batch in _whole(batches):
        first = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(first[1:] != first[:-1]) + 1).tolist(), len(first)]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(start, stop - start)


def _table(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint8).reshape(len(sigs), HASHES)


def _equal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.zeros((len(left), len(right)), np.int16)
    for k in range(HASHES):
        out += left[:, k][:, None] == right[:, k][None, :]
    return out


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node, n) for every band of a node that it shares; ``n`` nodes have the key."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("key"), "node")
    shared = staged(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    return staged(rows.join(shared, "key").select("key", "node", "n"), "bands")


def dealt(rows: DataFrame, chunk: int) -> DataFrame:
    """(group, key, node) for band rows: a key of up to ``chunk`` nodes is a group; larger keys are dealt by hash of the
    node into groups of about ``chunk``, twice over, so that the second deal connects the groups of the first."""
    parts = F.ceil(F.col("n") / chunk)
    own = [F.pmod(F.xxhash64("node", "key", F.lit(k)), parts) + k * parts for k in range(2)]
    part = F.explode(F.when(F.col("n") > chunk, F.array(*own)).otherwise(F.array(F.lit(0).cast("long"))))
    return rows.select("key", "node", part.alias("part")).select(F.xxhash64("key", "part").alias("group"), "key", "node")


def band_pairs(rows: DataFrame, nodes: DataFrame, wanted: int) -> DataFrame:
    """Candidate pairs (key, a, b): in each group a spanning forest of pairs with at least ``wanted`` equal bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(batches):
            groups, keys, nodes = (batch.column(k).to_numpy() for k in range(3))
            table = _table(batch.column(3))
            starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
            sizes = np.diff(np.concatenate([starts, [len(groups)]]))
            two = starts[sizes == 2]
            two = two[(table[two] == table[two + 1]).sum(axis=1) >= wanted]
            pairs = [np.stack([two, two + 1], axis=1)]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                pairs.append(start + np.array(strongest_forest(table[start:start + size], wanted), np.int64).reshape(-1, 2))
            a, b = np.concatenate(pairs).T
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[a], nodes[a], nodes[b])], schema=FOUND)

    met = dealt(rows, CHUNK).join(nodes.select("node", "sig"), "node").select("group", "key", "node", "sig")
    return met.repartition("group").sortWithinPartitions("group", "node").mapInArrow(work, "key long, a long, b long")


def shingle_sets(wanted: DataFrame, nodes: DataFrame, base: DataFrame, width: int) -> DataFrame:
    """(node, set) of the distinct nodes ``wanted``: the sorted hashes of its shingles."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1, SHINGLED)):
            hashes, offsets = shingles_of(texts_of(batch.column(1)), width)
            own = [np.unique(hashes[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["node", "set"])

    places = nodes.join(wanted, "node").select("node", "doc", "th")
    texts = base.join(places, ["doc", "th"]).select("node", "text").mapInArrow(sets, "node long, set binary").dropDuplicates(["node"])
    return staged(texts, "sets")


def similar(x: bytes, y: bytes, least: float) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def checked(pairs: DataFrame, nodes: DataFrame, base: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs of nodes whose shingle sets have at least ``least`` of their union in common."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(x, y, least) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, base, width)
    left, right = texts.toDF("a", "set_a"), texts.toDF("b", "set_b")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(work, "a long, b long")


def blocks_apart(rows: DataFrame, keys: DataFrame, joined: DataFrame, chunk: int) -> DataFrame | None:
    """(block, side, node, root): every pair of nodes of one of the ``keys`` with different roots meets in a block, one
    node on each side. None if no such pair is left.

    Side 0 has the nodes outside the largest group of a key, side 1 all nodes, each in chunks of about ``chunk``. So
    a key costs a few rows a node once nearly all of it is one group.
    """
    own = rows.join(keys, "key", "left_semi").join(joined, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    own = staged(own, "open")
    trees = own.groupBy("key", "root").agg(F.count("*").alias("m"))
    sizes = trees.groupBy("key").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("n"), F.count("*").alias("trees")).where("trees > 1")
    sizes = staged(sizes.select("key", F.col("top.root").alias("top"), F.ceil((F.col("n") - F.col("top.m")) / chunk).alias("rest"), F.ceil(F.col("n") / chunk).alias("parts")), "sizes")
    if sizes.isEmpty():
        return None
    met = own.join(sizes, "key")

    def side(number: int, rows: DataFrame, own: str, other: str) -> DataFrame:
        at = rows.withColumn(own, F.pmod(F.xxhash64("node", "key", F.lit(2 + number)), F.col("parts" if number else "rest")))
        at = at.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest" if number else "parts") - 1)))
        return at.select(F.xxhash64("key", "i", "j").alias("block"), F.lit(number).alias("side"), "node", "root")

    return side(0, met.where("root <> top"), "i", "j").union(side(1, met, "j", "i"))


def joined_in_blocks(blocks: DataFrame, nodes: DataFrame, base: DataFrame, width: int, wanted: int, least: float) -> DataFrame:
    """Links (a, b) between roots: pairs in blocks with at least ``wanted`` equal bytes that pass the exact check.

    Shingle sets go only to the rows with such a pair. A pair is left unchecked only if checked links join its roots.
    """

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            side, roots, table = group.column(1).to_numpy(), group.column(3).to_numpy(), _table(group.column(4))
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            near = (_equal(table[left], table[right]) >= wanted) & (roots[left][:, None] != roots[right][None, :])
            rows = np.concatenate([left[near.any(axis=1)], right[near.any(axis=0)]])
            if len(rows):
                yield group.take(pa.array(rows))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            side, roots, table = group.column(1).to_numpy(), group.column(3).to_numpy(), _table(group.column(4))
            sets = group.column(5)
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            equal = _equal(table[left], table[right])
            equal[roots[left][:, None] == roots[right][None, :]] = 0
            x, y = np.nonzero(equal >= wanted)
            order = np.argsort(-equal[x, y], kind="stable")
            tree, out = np.unique(roots, return_inverse=True)[1], []
            for a, b in zip(left[x[order]].tolist(), right[y[order]].tolist()):
                if tree[a] != tree[b] and similar(sets[a].as_py(), sets[b].as_py(), least):
                    out.append((a, b))
                    tree[tree == tree[b]] = tree[a]
            pairs = np.array(out, np.int64).reshape(-1, 2)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(roots[pairs[:, k]]) for k in range(2)], names=["a", "b"])

    kind = "block long, side int, node long, root long, sig binary"
    met = blocks.join(nodes.select("node", "sig"), "node").select("block", "side", "node", "root", "sig")
    met = staged(met.repartition("block").sortWithinPartitions("block", "side", "node").mapInArrow(alike, kind), "apart")
    full = met.join(shingle_sets(met.select("node").distinct(), nodes, base, width), "node").select("block", "side", "node", "root", "sig", "set")
    return full.repartition("block").sortWithinPartitions("block", "side", "node").mapInArrow(join, "a long, b long")


def groups_of(nodes: DataFrame, near: DataFrame, base: DataFrame, width: int, least: float) -> DataFrame:
    """(node, root) of the nodes that checked links join: all candidates of ``near`` and all pairs that share a band.

    First the forests of the bands are checked. Where a pair of a forest failed, or a key was dealt in groups, the pairs
    of the key that are still apart are checked one by one, so no pair is lost to one that only seemed stronger.
    """
    wanted, rows = int((least - SLACK) * HASHES), band_rows(nodes)
    found = staged(band_pairs(rows, nodes, wanted).select("key", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "forests")
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(found.select("a", "b"))
    pairs = staged(pairs.where("a <> b").distinct(), "candidates")
    good = staged(checked(pairs, nodes, base, width, least), "checked")
    joined = staged(components(good), "joined")
    failed = staged(found.join(good, ["a", "b"], "left_anti").select("key").distinct(), "failed")
    keys = rows.where("n > 2").join(failed, "key", "left_semi").select("key").union(rows.where(F.col("n") > CHUNK).select("key")).distinct()
    blocks = blocks_apart(rows, staged(keys, "keys"), joined, CHUNK)
    if blocks is None:
        return joined
    more = components(joined_in_blocks(blocks, nodes, base, width, wanted, least)).toDF("old", "new")
    every = nodes.select("node").join(joined, "node", "left").select("node", F.coalesce("root", "node").alias("old"))
    return every.join(staged(more, "more"), "old", "left").select("node", F.coalesce("new", "old").alias("root"))


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """The documents without near-duplicates: of every group linked by similarities of at least ``least`` one stays, that
    with the smallest id (then hash of text).

    Texts with the same set of shingles are one node from the start. Candidates are the pairs within 3 fingerprint bits
    that the anchors find, and pairs that share a band; only pairs that pass the exact check join groups. All columns stay. A null id comes
    first; null and empty texts are copies of each other; of rows with the same id and text one stays; an empty
    table gives no rows.
    """
    base = keyed(docs, id_col, text_col)
    rows = staged(sketches(base, width), "sketches")
    nodes = staged(rows.groupBy("node").agg(F.min(F.struct("doc", "th", "fp", "sig", "bands")).alias("r")).select("node", "r.*"), "nodes")
    by_fp = nodes.groupBy("fp").agg(F.min("node").alias("low"))
    close = links(by_fp.select("fp"))
    near = close.join(by_fp.toDF("a", "x"), "a").join(by_fp.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    same = nodes.join(by_fp, "fp").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    joined = groups_of(nodes, near.union(same), base, width, least)
    groups = nodes.select("node", "doc", "th").join(joined, "node", "left").select(F.coalesce("root", "node").alias("root"), "doc", "th")
    stay = groups.groupBy("root").agg(F.min(F.struct("doc", "th")).alias("r")).select("r.*")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("th"))
    return marked.join(stay, ["doc", "th"], "left_semi").dropDuplicates(["doc", "th"]).select("row.*")
