"""Near-equal vectors by collision counting on one-dimensional projections.

Every vector is projected on ``PROJECTIONS`` random directions. Two vectors collide on a direction when one lies in the window
around the other. Pairs with at least ``least_count`` collisions are verified by their cosine. Window and count are
calibrated: two vectors exactly at the limit reach the count with probability ``recall``, closer ones more often.

No pair is counted that cannot reach the count: at most ``PROJECTIONS - least_count`` directions may miss, and there is one
group of directions more than that, so such a pair collides on all directions of some group. For each group, vectors are
sorted into cells of its first directions and visit the neighbouring cells their windows reach; inside a cell,
sorted windows of one more direction propose pairs. How many directions make cells follows the number of
vectors of the label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tabwright.llm.batches import give_back, ranges
from tabwright.llm.components import components
from tabwright.llm.staging import staged

PROJECTIONS = 24
GROUPS = 3
CELL = 4096  # vectors wanted in a cell
CHUNK = 8192  # vectors of a crowded cell that meet in one task
PAIRS = 200_000  # pairs worked on at a time
SEED = 20_011


def collision_rate(window: float, distance: float) -> float:
    """Probability that the projections of two vectors at ``distance`` lie within ``window``."""
    return math.erf(window / (distance * math.sqrt(2)))


def reached(rate: float, tries: int, misses: int) -> float:
    """Probability of at most ``misses`` misses."""
    return sum(math.comb(tries, k) * (1 - rate) ** k * rate ** (tries - k) for k in range(misses + 1))


def calibrated(limit: float, recall: float, projections: int = PROJECTIONS, groups: int = GROUPS) -> tuple[float, int]:
    """(window, least count): the narrowest window in which unit vectors with cosine ``limit`` reach the count."""
    distance, misses = math.sqrt(max(2 - 2 * limit, 1e-12)), groups - 1
    low, high = 0.0, 20 * distance
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if reached(collision_rate(middle, distance), projections, misses) >= recall else (middle, high)
    return high, projections - misses


def directions(size: int, projections: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, projections]).standard_normal((size, projections))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaling by a power of two first keeps very large and very small rows exact."""
    scale = np.exp2(-np.frexp(np.abs(vectors).max(axis=1))[1].astype(float))
    vectors = vectors * scale[:, None]
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def matrix(column: pa.Array, rows: np.ndarray, size: int) -> np.ndarray:
    """The lists at ``rows``, all of ``size`` numbers, as doubles."""
    lists = column.take(pa.array(rows))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)


def cells(values: np.ndarray, window: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, visitor or at home, cell coordinates): the cell of each row, and the higher cells its window reaches."""
    width = 2 * window
    home = np.floor(values / width).astype(np.int32)
    reach = window * (1 + 1e-9)
    low, high = (np.floor((values + s * reach) / width).astype(np.int32) for s in (-1, 1))
    rows, at = np.arange(len(values)), np.zeros((len(values), 0), np.int32)
    for k in range(values.shape[1]):  # one direction after another: every cell between low and high
        counts = (high[rows, k] - low[rows, k] + 1).astype(np.int64)
        coordinate = ranges(low[rows, k].astype(np.int64), counts)
        rows, at = np.repeat(rows, counts), np.repeat(at, counts, axis=0)
        at = np.column_stack((at, coordinate.astype(np.int32)))
    first_apart = np.zeros(len(rows), np.int64)
    for k in reversed(range(values.shape[1])):
        first_apart = np.where(at[:, k] != home[rows, k], at[:, k] - home[rows, k], first_apart)
    kept = first_apart >= 0  # of two cells, only vectors of the lower one visit
    return rows[kept], first_apart[kept] > 0, at[kept]


def candidate_pairs(base: np.ndarray, other: np.ndarray | None, window: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the window of one sorted direction: inside ``base``, or of ``base`` and ``other``."""
    order = np.argsort(base, kind="stable")
    line = base[order]
    if other is None:
        low, asked = np.arange(len(line)) + 1, order
        high = np.searchsorted(line, line + window, side="right")
    else:
        low, high, asked = np.searchsorted(line, other - window), np.searchsorted(line, other + window, side="right"), np.arange(len(other))
    sizes = np.maximum(high - low, 0)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        yield order[ranges(low[start:stop], sizes[start:stop])], np.repeat(asked[start:stop], sizes[start:stop])
        start = stop


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links that connect what all links (between small numbers) connect, without most of the others."""
    root = np.arange(int(max(a.max(), b.max())) + 1) if len(a) else np.zeros(0, np.int64)
    chosen, place = [], np.arange(len(a))
    while len(place):
        x, y = root[a[place]], root[b[place]]
        apart = x != y
        place, x, y = place[apart], x[apart], y[apart]
        high, first = np.unique(np.maximum(x, y), return_index=True)
        chosen.append(place[first])
        root[high] = np.minimum(x, y)[first]
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return np.concatenate([np.zeros(0, np.int64), *chosen])


class Tile:
    """Vectors that meet in one task: their links as sums per vector, and links that span their components."""

    def __init__(self, vectors: np.ndarray, projections: np.ndarray, copies: np.ndarray, group: int, groups: int, window: float, least: int, limit: float):
        self.units, self.projections, self.copies = unit(vectors), projections, copies
        self.group, self.each, self.window, self.least, self.limit = group, projections.shape[1] // groups, window, least, limit
        self.sums = np.zeros(len(copies), np.int64)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def meet(self, base: np.ndarray, other: np.ndarray | None) -> None:
        line = self.projections[:, (self.group + 1) * self.each - 1]
        for a, b in candidate_pairs(line[base], None if other is None else line[other], self.window):
            a, b = base[a], (base if other is None else other)[b]
            for k in range(self.group * self.each, (self.group + 1) * self.each - 1):
                near = np.abs(self.projections[a, k] - self.projections[b, k]) <= self.window
                a, b = a[near], b[near]
            hit = np.abs(self.projections[a] - self.projections[b]) <= self.window
            kept = hit.sum(axis=1) >= self.least
            for g in range(self.group):  # counted where it collides on a whole group first
                kept &= ~hit[:, g * self.each:(g + 1) * self.each].all(axis=1)
            a, b = a[kept], b[kept]
            near = np.einsum("ij,ij->i", self.units[a], self.units[b]) >= self.limit
            a, b = a[near], b[near]
            np.add.at(self.sums, a, self.copies[b])
            np.add.at(self.sums, b, self.copies[a])
            if len(a):
                part = spanning(a, b)
                self.links.append((a[part], b[part]))

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.links:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = (np.concatenate(side) for side in zip(*self.links))
        part = spanning(a, b)
        return a[part], b[part]


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys, of batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            codes = batch.column(key).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            changed[1:] |= codes[1:] != codes[:-1]
        if held:
            changed[0] = any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if held and changed[start]:
                yield pa.Table.from_batches(held)
                held = []
            if stop > start:
                held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def near_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", limit: float = 0.98, recall: float = 0.999,
    projections: int = PROJECTIONS, groups: int = GROUPS, cell: int = CELL, chunk: int = CHUNK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors of equal label with a cosine of ``limit`` and more, and their components.

    Equal vectors of a label are one class, so copies are never paired; a class's links count with their copies. Cells of more
    than ``chunk`` vectors are dealt as pairs of chunks by a hash of the id. Tasks hand on sums of links per class and a
    spanning part of the links, never all pairs. ``recall`` is the probability that a pair exactly at ``limit``
    reaches the count; pairs that do are verified in double precision, so none below ``limit`` is linked.

    Null vectors, empty or zero vectors, vectors with null or non-finite components and rows with a null label or id link with
    nothing and are their own component (null for a null id, kept). Vectors are compared with vectors of the same length
    only. Ids should be unique: different vectors with one id count as one node. Other columns are not read.
    """
    if projections % groups:
        raise ValueError("projections must be a multiple of groups")
    window, least = calibrated(limit, recall, projections, groups)
    each = projections // groups
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        F.forall("vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))) & F.exists("vector", lambda v: v != 0), F.lit(False))
    classes = rows.where(usable).groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    classes = classes.select("label", F.size("vector").alias("size"), "node", "copies", F.col("vector").cast("array<double>").alias("wide"), "vector")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            shown = np.zeros((len(sizes), projections), np.float32)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                if size not in known:
                    known[size] = directions(size, projections)
                shown[own] = unit(matrix(batch.column("wide"), own, size)) @ known[size]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(shown.ravel()), projections).cast(pa.list_(pa.float32()))
            names = ["label", "size", "node", "copies", "vector"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [lists], names=names + ["shown"])

    schema = classes.drop("wide").schema.add("shown", T.ArrayType(T.FloatType()))
    classes = staged(classes.mapInArrow(project, schema), "classes")
    # directions that make cells: each parts a label's vectors to about a third
    sizes = staged(classes.groupBy("label", "size").agg(F.count("*").alias("n")), "sizes")
    depth = F.greatest(F.lit(0), F.least(F.lit(each - 1), F.ceil(F.log(F.col("n") / F.lit(float(cell))) / F.lit(math.log(3.0))))).cast("int")
    placed = classes.join(sizes.select("label", "size", depth.alias("depth")), ["label", "size"])

    def to_cells(carried: list[str]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in (whole.slice(k, 2000) for k in range(0, whole.num_rows, 2000)):
                    shown = matrix(batch.column("shown"), np.arange(batch.num_rows), projections)
                    depths = batch.column("depth").to_numpy(zero_copy_only=False)
                    for deep in np.unique(depths).tolist():
                        own = np.flatnonzero(depths == deep)
                        for group in range(groups):
                            at, away, place = cells(shown[own, group * each:group * each + deep], window)
                            keys = pa.array([p.tobytes() for p in place], pa.binary())
                            source = pa.array(own[at])
                            yield pa.RecordBatch.from_arrays(
                                [*(batch.column(n).take(source) for n in carried), pa.array(np.full(len(at), group, np.int32)), keys, pa.array(away)],
                                names=[*carried, "part", "cell", "away"])
        return work

    key, load = ["label", "size", "part", "cell"], ["label", "size", "node", "copies", "vector", "shown"]
    extra = "part int, cell binary, away boolean"
    label_type = rows.schema["label"].dataType.simpleString()
    counted = (
        placed.select("label", "size", "shown", "depth").mapInArrow(to_cells(["label", "size"]), f"label {label_type}, size int, {extra}")
        .groupBy(key).agg(F.sum(F.when(F.col("away"), 0).otherwise(1)).alias("homes"), F.sum(F.when(F.col("away"), 1).otherwise(0)).alias("visits"))
    )
    crowded = staged(counted.where((F.col("homes") > chunk) | (F.col("visits") > chunk)).select(
        *key, F.ceil(F.col("homes") / chunk).cast("int").alias("home_chunks"), F.ceil(F.col("visits") / chunk).cast("int").alias("visit_chunks")), "crowded")
    vector_type = rows.schema["vector"].dataType.simpleString()
    everyone = placed.select(*load, "depth").mapInArrow(
        to_cells(load), f"label {label_type}, size int, node long, copies long, vector {vector_type}, shown array<float>, {extra}")
    dealt = everyone.join(crowded, key, "left").withColumn("home_chunks", F.coalesce("home_chunks", F.lit(1))).withColumn("visit_chunks", F.coalesce("visit_chunks", F.lit(1)))
    # tile (i, i): home chunk i with itself and with visitors 0; tile (i, j): home chunk i with home chunk j, or with visitors j - home_chunks + 1
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("away"), F.greatest("visit_chunks", F.lit(1))).otherwise(F.greatest("home_chunks", F.lit(1)))).cast("int"))
    tiles = F.expr("""
        CASE WHEN away THEN transform(sequence(0, home_chunks - 1),
                 i -> named_struct('i', i, 'j', IF(own = 0, i, home_chunks + own - 1), 'side', 1))
             ELSE concat(transform(sequence(0, greatest(home_chunks, 1) - 1),
                     x -> named_struct('i', least(x, own), 'j', greatest(x, own), 'side', IF(x < own, 1, 0))),
                 IF(visit_chunks > 1, transform(sequence(1, visit_chunks - 1),
                     v -> named_struct('i', own, 'j', home_chunks + v - 1, 'side', 0)), array())) END""")
    dealt = dealt.where("NOT away OR home_chunks > 0").select(*load, "part", "cell", F.explode(tiles).alias("tile")).select(
        *load, "part", "cell", F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), F.col("tile.side").alias("side"))
    group_key = [*key, "i", "j"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])
        ready: list[pa.RecordBatch] = []
        for table in runs_of(batches, group_key):
            n = table.num_rows
            side = table["side"].to_numpy()
            inside = table["i"][0] == table["j"][0]
            base, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(base) or n < 2:
                continue
            table = table.combine_chunks()
            every = np.arange(n)
            tile = Tile(matrix(table["vector"].combine_chunks(), every, table["size"][0].as_py()), matrix(table["shown"].combine_chunks(), every, projections),
                        table["copies"].to_numpy(), table["part"][0].as_py(), groups, window, least, limit)
            if inside and len(base) > 1:
                tile.meet(base, None)
            if len(other):
                tile.meet(base, other)
            node = table["node"].to_numpy()
            some = np.flatnonzero(tile.sums)
            a, b = tile.spanning()
            if len(some):
                ready.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((node[some], node[a]))), pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[b])]),
                     pa.array(np.concatenate((tile.sums[some], np.zeros(len(a), np.int64))))], schema=schema))
            if len(ready) >= 500:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready = []
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
        give_back()

    met = dealt.repartition(*group_key).sortWithinPartitions(*group_key).mapInArrow(work, "node long, other long, n long")
    met = staged(met, "links")
    sums = met.groupBy("node").agg(F.sum("n").alias("linked"))
    roots = components(met.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    judged = staged(
        classes.select("label", "vector", "node", "copies").join(sums, "node", "left").join(roots, "node", "left")
        .select("label", "vector", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")), "judged")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = rows.where(usable).join(judged, ["label", "vector"]).select("vec_id", "n_links", "component_id").unionByName(alone)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def near_vectors_sql(limit: float = 0.98) -> str:
    """The same in DuckDB's SQL: every pair of a label."""
    return f"""
WITH RECURSIVE u AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {limit}),
reach AS (SELECT a AS x, b AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
own AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(y, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN low ON x = vec_id LEFT JOIN own ON a = vec_id
"""
