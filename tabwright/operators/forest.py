"""Random forests grown level by level from counted cells; the result is Spark's own model.

Trees see a value only as one of at most 32 intervals, as in Spark's trainer. Rows with the same intervals and class are one cell
with a count, and a tree draws Poisson(count) of them, which is what drawing each row with Poisson(1) gives. Cells are dealt
over tasks and stored in blocks. For each level there is one job: tasks draw the cells of every tree again, by the number of the block,
send them down to the nodes that are still open, and count classes by interval for the features of each node; the counts of a tree meet in
one place, which picks the splits. The driver has the trees and nothing else.

Splits, impurities, stopping and pruning are those of ``RandomForestClassifier`` with Gini impurity.
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.functions.state import ROWS_WORTH_A_TASK, cut_lineage, local_frame, scratch_path

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Deepest trees grown here, and most classes and features (a class or the number of an interval is a byte).
MAX_DEPTH = 12
MAX_CLASSES = 100
MAX_FEATURES = 1_000
MAX_BINS = 32
# Rows that tell where intervals end, as many as Spark's trainer takes; with fewer rows than that, all of them.
BIN_ROWS = 10_000
# Cells of a block and of a piece of it that is worked on at once.
BLOCK_CELLS = 262_144
PIECE_CELLS = 32_768
CELLS_PER_TASK = 2_000_000
# Counts of a part of the open nodes of a tree, which meet in one place, parts a task counts at once, and bytes that meet.
PART_COUNTS = 2_000_000
PARTS_AT_ONCE = 4
MEETING_BYTES = 64_000_000
# Largest count of a cell whose draws come from a table.
TABLE_COUNT = 50
UNSURE = 255


def grows_here(forest: RandomForestClassifier, n_features: int) -> bool:
    """Whether the settings of a forest are among those this module knows."""
    return (
        forest.getMaxDepth() <= MAX_DEPTH and n_features <= MAX_FEATURES and forest.getMaxBins() == MAX_BINS
        and forest.getImpurity() == "gini" and forest.getFeatureSubsetStrategy() == "auto" and forest.getSubsamplingRate() == 1.0
        and forest.getMinInstancesPerNode() == 1 and forest.getMinInfoGain() == 0.0
        and forest.getMinWeightFractionPerNode() == 0.0 and not forest.isDefined("weightCol")
    )


def grow(table: DataFrame, features: Sequence[str], label_col: str, forest: RandomForestClassifier, n_rows: int) -> RandomForestClassificationModel:
    """The forest on a stored table of numeric features and a double as label."""
    spark, names = table.sparkSession, list(features)
    limits, n_classes = _intervals(table, names, label_col, n_rows, forest.getSeed())
    cells, n_tasks = _cells(table, names, label_col, limits, n_classes, n_rows)
    n_trees, depth = forest.getNumTrees(), forest.getMaxDepth()
    wanted = len(names) if n_trees == 1 else max(1, math.ceil(math.sqrt(len(names))))
    trees = [_Tree(depth, n_classes) for _ in range(n_trees)]
    draw = np.random.default_rng([forest.getSeed() & 0xFFFFFFFF, 1])
    seed = forest.getSeed() & 0xFFFFFFFF
    for level in range(max(1, depth)):  # a tree of one node has counts as well
        work = []  # tree, first open node of the part, heap places of its nodes, features of each
        for number, tree in enumerate(trees):
            places = np.array(sorted(tree.open), dtype=np.int64)  # results come in any order
            size = max(1, PART_COUNTS // (wanted * MAX_BINS * n_classes))
            for start in range(0, len(places), size):
                part = places[start:start + size]
                chosen = np.sort(np.argsort(draw.random((len(part), len(names))), axis=1)[:, :wanted], axis=1)
                work.append((number, part, chosen.astype(np.int64)))
            tree.open = []
        if not work:
            break
        down = {n: (trees[n].feature, trees[n].bin) for n in {w[0] for w in work}}
        parts = cells.mapInArrow(_counts(work, down, len(names), n_classes, level, forest.getBootstrap(), seed),
                                 "part int, place binary, n binary")
        n_bytes = 12 * n_tasks * sum(len(w[1]) for w in work) * wanted * MAX_BINS * n_classes
        meet = min(len(work), max(2 * spark.sparkContext.defaultParallelism, n_bytes // MEETING_BYTES))
        sizes = np.array([len(limits[f]) for f in names])
        best = parts.repartition(meet, "part").mapInArrow(
            _best_splits([w[2] for w in work], sizes, n_classes), "part int, node int, feature int, bin int, gain double, total binary, left binary")
        for row in best.toArrow().to_pylist():
            number, places, _ = work[row["part"]]
            trees[number].split(int(places[row["node"]]), row, level)
    return _spark_model(spark, trees, [limits[f] for f in names], n_classes, forest)


class _Tree:
    """A heap of nodes: the children of place p are 2 p + 1 and 2 p + 2. ``feature`` is -1 where no split is known."""

    def __init__(self, depth: int, n_classes: int):
        self.depth, self.open = depth, [0]
        self.feature = np.full(2 ** max(1, depth) - 1, -1, dtype=np.int64)
        self.bin = np.full(len(self.feature), UNSURE, dtype=np.uint8)
        self.stats, self.gain = {}, {}

    def split(self, place: int, found: dict, level: int) -> None:
        total, left = (np.frombuffer(found[k], dtype=np.float64) for k in ("total", "left"))
        self.stats[place] = total
        if found["gain"] <= 0 or self.depth == 0:
            return
        self.feature[place], self.bin[place], self.gain[place] = found["feature"], found["bin"], found["gain"]
        for child, stats in ((2 * place + 1, left), (2 * place + 2, total - left)):
            self.stats[child] = stats
            if level + 1 < self.depth and _gini(stats[None])[0] > 2.3e-16:
                self.open.append(child)

    def nodes(self, limits: Sequence[Sequence[float]]) -> list[tuple]:
        """Nodes in the order of a walk, as Spark stores them; two leaves with the same prediction are one."""
        out = []

        def walk(place: int) -> tuple:
            stats = self.stats[place]
            at, told, impurity = len(out), float(stats.argmax()), float(_gini(stats[None])[0])
            out.append(None)
            if place in self.gain:
                one, left = walk(2 * place + 1)
                two, right = walk(2 * place + 2)
                if one is not None and one == two:
                    del out[at + 1:]
                else:
                    feature = int(self.feature[place])
                    out[at] = (at, told, impurity, stats, self.gain[place], left, right, feature, [limits[feature][self.bin[place]]])
                    return None, at
                told = one
            out[at] = (at, told, impurity, stats, -1.0, -1, -1, -1, [])
            return told, at

        walk(0)
        return out


def _gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1)
    share = stats / np.where(total > 0, total, 1.0)[..., None]
    return np.where(total > 0, 1.0 - (share * share).sum(axis=-1), 0.0)


def _values(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    columns = [batch.column(name) for name in names]
    if any(c.null_count for c in columns):
        raise ValueError("missing values among the features or labels")
    out = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), dtype=np.float64) for c in columns]) if columns else np.zeros((0, batch.num_rows))
    if np.isnan(out).any():
        raise ValueError("missing values among the features or labels")
    return out


def _intervals(table: DataFrame, names: list[str], label_col: str, n_rows: int, seed: int) -> tuple[dict[str, list[float]], int]:
    """Thresholds of each feature and the number of classes."""
    top = table.agg(F.max(label_col).alias("top"), F.min(label_col).alias("low"),
                    F.count_if(F.col(label_col).isNull() | F.isnan(label_col) | (F.col(label_col) != F.floor(label_col))).alias("bad")).first()
    if not n_rows or top["bad"] or top["low"] < 0 or top["top"] >= MAX_CLASSES:
        raise ValueError(f"labels must be whole numbers from 0 to {MAX_CLASSES - 1}, none missing: {top.asDict()}")
    picked = table.select(*[F.col(c).cast("double").alias(c) for c in names])
    if n_rows > BIN_ROWS:
        picked = picked.sample(False, BIN_ROWS / n_rows, seed)
    told = picked.toArrow()
    bins = min(MAX_BINS, n_rows)
    limits = {}
    for c in names:
        column = told[c].to_numpy()
        if told[c].null_count or np.isnan(column).any():
            raise ValueError(f"missing values in feature '{c}'")
        limits[c] = thresholds(column, bins)
    return limits, int(top["top"]) + 1


def thresholds(values: np.ndarray, bins: int) -> list[float]:
    """At most ``bins`` - 1 thresholds halfway between neighbouring values: all of them, or those nearest to equal shares."""
    kinds, counts = np.unique(values, return_counts=True)
    between = (kinds[:-1] + kinds[1:]) / 2.0
    if len(between) <= bins - 1:
        return between.tolist()
    stride, out = len(values) / bins, []
    target, before = stride, counts[0]
    for i in range(1, len(kinds)):
        now = before + counts[i]
        if abs(before - target) < abs(now - target):
            out.append(float(between[i - 1]))
            target += stride
        before = now
    return out


def _cells(table: DataFrame, names: list[str], label_col: str, limits: dict, n_classes: int, n_rows: int) -> tuple[DataFrame, int]:
    """Cells in stored blocks (block, n_cells, codes, counts): a row of ``codes`` is a byte for each feature and one for the class."""
    edges = [np.array(limits[c]) for c in names]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, BLOCK_CELLS):
            x = _values(batch, [*names, label_col])
            codes = np.empty((x.shape[1], len(x)), dtype=np.uint8)
            for i, edge in enumerate(edges):
                codes[:, i] = np.searchsorted(edge, x[i], side="left")
            codes[:, -1] = x[-1]
            kinds, counts = _counted(codes, np.ones(len(codes), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([_as_binary(kinds), pa.array(counts)], names=["cell", "n"])

    cores = table.sparkSession.sparkContext.defaultParallelism
    n_tasks = min(cores, max(1, n_rows // ROWS_WORTH_A_TASK)) * max(1, -(-n_rows // (cores * CELLS_PER_TASK)))
    found = table.select(*[F.col(c).cast("double").alias(c) for c in (*names, label_col)]).mapInArrow(coded, "cell binary, n long")
    width = len(names) + 1

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 20
        kinds, counts = np.zeros((0, width), dtype=np.uint8), np.zeros(0, dtype=np.int64)
        for batch in _gathered(batches, 4 * BLOCK_CELLS):
            codes = np.frombuffer(b"".join(batch.column("cell").to_pylist()), dtype=np.uint8).reshape(-1, width)
            kinds, counts = _counted(np.concatenate([kinds, codes]), np.concatenate([counts, batch.column("n").to_numpy()]))
        for k, start in enumerate(range(0, len(kinds), BLOCK_CELLS)):
            part = slice(start, start + BLOCK_CELLS)
            yield pa.RecordBatch.from_arrays([
                pa.array([number + k], pa.int64()), pa.array([len(kinds[part])], pa.int64()), pa.array([kinds[part].tobytes()], pa.binary()),
                pa.array([counts[part].tobytes()], pa.binary())], names=["block", "n_cells", "codes", "counts"])

    blocks = cut_lineage(found.repartition(n_tasks, "cell").mapInArrow(packed, "block long, n_cells long, codes binary, counts binary"))
    n_cells = blocks.agg(F.sum("n_cells")).first()[0]
    fewer = min(cores, max(1, n_cells // ROWS_WORTH_A_TASK)) * max(1, -(-n_cells // (cores * CELLS_PER_TASK)))
    return (blocks.coalesce(fewer) if fewer < n_tasks else blocks), min(fewer, n_tasks)


def _gathered(batches: Iterator[pa.RecordBatch], n_rows: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together to about ``n_rows``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= n_rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _as_binary(codes: np.ndarray) -> pa.Array:
    n, width = codes.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(codes).tobytes())])


def _counted(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, with the sums of their counts."""
    if not len(codes):
        return codes, counts
    # eight bytes at a time, so that rows compare as numbers
    wide = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, :codes.shape[1]] = codes
    words = wide.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable") if words.shape[1] == 1 else np.lexsort(words.T[::-1])
    words = words[order]
    first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]).any(axis=1)])
    return codes[order[first]], np.add.reduceat(counts[order], first)


class _Draws:
    """How often each cell of a block is drawn for a tree: Poisson, by the numbers of seed, tree and block."""

    def __init__(self, counts: np.ndarray, seed: int, bootstrap: bool):
        self.counts, self.seed, self.bootstrap = counts, seed, bootstrap
        self.many = np.flatnonzero(counts > TABLE_COUNT)
        kinds = np.unique(counts[counts <= TABLE_COUNT])
        self.ends, tables = {}, np.full((max(1, len(kinds)), 65_536), UNSURE, dtype=np.uint8)
        self.kinds = kinds
        for i, c in enumerate(kinds):
            p, ends = math.exp(-c), []
            total, k = p, 0
            while k < 250 and total < 1.0 and (p > 1e-18 or k < c):
                ends.append(total)
                k += 1
                p *= c / k
                total += p
            self.ends[int(c)] = np.array(ends)
            start = 0.0
            for k, end in enumerate(ends):  # pieces of the unit interval that lie wholly within the share of one number
                tables[i, math.ceil(start * 65_536):math.floor(end * 65_536)] = k
                start = end
        self.tables = tables.ravel()
        slot = np.zeros(TABLE_COUNT + 2, dtype=np.int32)
        slot[kinds] = np.arange(len(kinds)) << 16
        self.row = slot[np.minimum(counts, TABLE_COUNT + 1)]

    def of(self, tree: int, block: int) -> np.ndarray:
        if not self.bootstrap:
            return self.counts
        draw = np.random.Generator(np.random.SFC64([self.seed, tree, block]))
        piece = draw.integers(0, 65_536, size=len(self.row), dtype=np.uint16)
        out = self.tables.take(self.row + piece)
        unsure = np.flatnonzero(out == UNSURE)
        if len(self.many):
            out = out.astype(np.int64)
            out[self.many] = draw.poisson(self.counts[self.many])
            unsure = unsure[self.counts[unsure] <= TABLE_COUNT]
        if len(unsure):
            exact = (piece[unsure] + draw.random(len(unsure))) / 65_536
            own = self.counts[unsure]
            told = np.zeros(len(unsure), dtype=np.int64)
            for c in np.unique(own):
                which = own == c
                told[which] = np.searchsorted(self.ends[int(c)], exact[which], side="right")
            out[unsure] = told
        return out


def _counts(work: Sequence[tuple], down: dict, n_features: int, n_classes: int, level: int, bootstrap: bool, seed: int) -> Callable:
    """Counts of classes by interval for each part of the open nodes, as places and numbers of those that are not zero."""
    rounds: list[tuple[int, list[int]]] = []
    for part, (tree, _, _) in enumerate(work):
        if rounds and rounds[-1][0] == tree and len(rounds[-1][1]) < PARTS_AT_ONCE:
            rounds[-1][1].append(part)
        else:
            rounds.append((tree, [part]))
    n_wanted = work[0][2].shape[1]
    per_node = n_wanted * MAX_BINS * n_classes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for block, codes, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "codes", "counts"))):
                codes = np.frombuffer(codes, dtype=np.uint8)
                labels = np.ascontiguousarray(codes.reshape(-1, n_features + 1)[:, -1])
                blocks.append((block, codes, labels, _Draws(np.frombuffer(counts, dtype=np.int64), seed, bootstrap)))
        if not blocks:
            return
        for tree, parts in rounds:
            feature, cut = down[tree]
            step = np.maximum(feature, 0)
            first_place = 2 ** level - 1
            # places of this level to the row of the node among the open ones of this tree
            node = np.full(2 ** level, -1, dtype=np.int64)
            chosen, bounds, n = [], [], 0
            for part in parts:
                _, places, own = work[part]
                node[places - first_place] = n + np.arange(len(places))
                chosen.append(own)
                bounds.append((part, n, n + len(places)))
                n += len(places)
            chosen = np.concatenate(chosen).ravel()
            sums = np.zeros(n * per_node)
            for block, codes, labels, draws in blocks:
                weight = draws.of(tree, block)
                for begin in range(0, len(labels), PIECE_CELLS):
                    drawn = np.flatnonzero(weight[begin:begin + PIECE_CELLS])
                    drawn += begin
                    base = drawn * (n_features + 1)
                    place = np.zeros(len(drawn), dtype=np.int64)
                    for _ in range(level):
                        at = step.take(place)
                        at += base
                        right = codes.take(at) > cut.take(place)
                        place *= 2
                        place += 1
                        place += right
                    place -= first_place
                    place = node.take(place)
                    live = place >= 0
                    if not live.all():
                        drawn, base, place = drawn[live], base[live], place[live]
                    if not len(drawn):
                        continue
                    own, label = weight.take(drawn).astype(np.float64), labels.take(drawn)
                    place *= n_wanted
                    for j in range(n_wanted):
                        at = chosen.take(place)
                        at += base
                        key = place * MAX_BINS
                        key += codes.take(at)
                        key *= n_classes
                        key += label
                        found = np.bincount(key, weights=own)
                        sums[:len(found)] += found
                        place += 1
            for part, start, end in bounds:
                own = sums[start * per_node:end * per_node]
                filled = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([filled.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([own[filled].tobytes()], pa.binary())], names=["part", "place", "n"])

    return count


def _best_splits(chosen: Sequence[np.ndarray], sizes: np.ndarray, n_classes: int) -> Callable:
    """The best split of each open node from all its counts; ``gain`` is -1 where there is none."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, place, n in zip(*(batch.column(c).to_pylist() for c in ("part", "place", "n"))):
                if part not in sums:
                    sums[part] = np.zeros(chosen[part].size * MAX_BINS * n_classes)
                sums[part][np.frombuffer(place, dtype=np.int32)] += np.frombuffer(n, dtype=np.float64)
        for part, flat in sums.items():
            own = chosen[part]
            n_nodes, n_wanted = own.shape
            counts = flat.reshape(n_nodes, n_wanted, MAX_BINS, n_classes)
            total = counts[:, 0].sum(axis=1)
            left = counts.cumsum(axis=2)[:, :, :-1]
            whole = total[:, None, None, :]
            right = whole - left
            n_left, n_right, n_all = left.sum(axis=-1), right.sum(axis=-1), np.maximum(total.sum(axis=-1), 1.0)[:, None, None]
            gain = _gini(total)[:, None, None] - n_left / n_all * _gini(left) - n_right / n_all * _gini(right)
            known = np.arange(MAX_BINS - 1) < sizes[own][:, :, None]
            gain = np.where(known & (n_left >= 1) & (n_right >= 1) & (gain >= 0), gain, -1.0).reshape(n_nodes, -1)
            pick = gain.argmax(axis=1)
            which, at = pick // (MAX_BINS - 1), pick % (MAX_BINS - 1)
            line = np.arange(n_nodes)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n_nodes, part, dtype=np.int32)), pa.array(line.astype(np.int32)), pa.array(own[line, which].astype(np.int32)),
                pa.array(at.astype(np.int32)), pa.array(gain[line, pick]), pa.array([t.tobytes() for t in total], pa.binary()),
                pa.array([np.ascontiguousarray(x).tobytes() for x in left[line, which, at]], pa.binary()),
            ], names=["part", "node", "feature", "bin", "gain", "total", "left"])

    return best


def _spark_model(spark: SparkSession, trees: Sequence[_Tree], limits: Sequence[Sequence[float]], n_classes: int,
                 forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """The trees as a model of Spark, by way of the files it would store."""
    folder = scratch_path(spark, "forest")
    params = {p.name: forest.getOrDefault(p) for p in forest.params if forest.isSet(p)}
    usual = {p.name: forest._defaultParamMap[p] for p in forest.params if forest.hasDefault(p)}
    now = int(time.time() * 1000)

    def usual_of(kind: str) -> dict:
        alone = ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")
        return {k: v for k, v in usual.items() if kind.startswith("RandomForest") or k not in alone}

    def metadata(kind: str, uid: str, own: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": now, "sparkVersion": spark.version,
                           "uid": uid, "paramMap": own, "defaultParamMap": usual_of(kind), **more})

    of_tree = {k: v for k, v in params.items() if k in ("featuresCol", "labelCol", "maxDepth", "seed")}
    head = metadata("RandomForestClassificationModel", forest.uid, params, numFeatures=len(limits), numClasses=n_classes, numTrees=len(trees))
    spark.createDataFrame(pa.table({"value": [head]})).coalesce(1).write.text(f"{folder}/metadata")
    local_frame(spark, pa.table({
        "_1": pa.array(range(len(trees)), pa.int32()),
        "_2": [metadata("DecisionTreeClassificationModel", f"{forest.uid}_{i}", of_tree) for i in range(len(trees))],
        "_3": pa.array([1.0] * len(trees), pa.float64()),
    })).write.parquet(f"{folder}/treesMetadata")
    rows = [(number, *node) for number, tree in enumerate(trees) for node in tree.nodes(limits)]
    number, at, told, impurity, stats, gain, left, right, feature, limit = (list(c) for c in zip(*rows))
    node = pa.StructArray.from_arrays([
        pa.array(at, pa.int32()), pa.array(told, pa.float64()), pa.array(impurity, pa.float64()),
        pa.array([s.tolist() for s in stats], pa.list_(pa.float64())), pa.array([int(s.sum()) for s in stats], pa.int64()),
        pa.array(gain, pa.float64()), pa.array(left, pa.int32()), pa.array(right, pa.int32()),
        pa.StructArray.from_arrays([
            pa.array(feature, pa.int32()), pa.array(limit, pa.list_(pa.float64())), pa.array([-1] * len(rows), pa.int32()),
        ], names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"]),
    ], names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    local_frame(spark, pa.table({"treeID": pa.array(number, pa.int32()), "nodeData": node})).write.parquet(f"{folder}/data")
    return RandomForestClassificationModel.load(folder)
