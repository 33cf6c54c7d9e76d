"""Exact k-nearest-neighbour join on numeric vectors.

Comparing every receiver with every donor is quadratic, and collecting one side does not scale.
Donors are therefore kept in a tree of pivots. A node with too many donors is split around pivots
drawn from them, each donor going to the nearest one; the parts are nodes themselves, split again
until every leaf holds a bounded number. For each part the number of its donors and the smallest and largest
distance to its pivot are known. A receiver first goes down to the leaf around its nearest pivots and
searches that. The distance to the k-th donor found there tells, at every node, which parts can hold a closer one (by the
triangle inequality, and by the plane between two pivots), and the receiver goes down to those only. Inside a leaf donors
lie in small boxes, and a receiver meets the boxes within its reach. The result is exact.

The tree is never gathered: nodes are rows, one DataFrame for each level, and rows meet the node they have reached by a join
on its path. Two kinds of skew are handled: copies of a vector are collapsed to the few that can
matter, and rows that reach the same node are dealt over blocks of bounded size. Sizes of nodes and numbers of blocks are
settled: near the root they are few rows that stand for many, and no row is shuffled by its node alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabwright.functions.state import cut_lineage, settle

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_PIVOTS = 256
DONORS_PER_PIVOT = 8_000
# Most donors of a leaf, and most rows that meet a node or leaf in one call.
CHUNK_ROWS = 32_000
BLOCK_ROWS = 20_000
TILE_CELLS = 131_072
# Donors of a box in a leaf, and of a leaf that is searched without boxes.
BOX_ROWS = 64
PLAIN_ROWS = 256
# Receivers times boxes at a time, and finds kept before the best of them are picked.
BOX_CELLS = 1_000_000
MAX_FINDS = 2_000_000
DISTANCE_DIGITS = 9
NO_GROUP = "\0"


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed one coordinate at a time (no cancellation, little memory)."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = a[:, j, None] - b[None, :, j]
        step *= step
        total += step
    return np.sqrt(total, out=total)


def _tiles(n: int, width: int) -> Iterator[slice]:
    size = max(1, TILE_CELLS // max(1, width))
    for start in range(0, n, size):
        yield slice(start, min(n, start + size))


def _count(tally, distances: int) -> None:
    if tally is not None:
        tally.add(distances)


def _pivots(node: pa.Table) -> np.ndarray:
    return _matrix(node.column("pivots").combine_chunks().flatten())


def _assigned(shape: pa.Schema, tally):
    """The nearest pivot (``child``) of each row that has reached a node, and the distance to it (``gap``)."""

    def assign(rows: pa.Table, node: pa.Table) -> pa.Table:
        if not len(rows) or not len(node):
            return shape.empty_table()
        points, pivots = _matrix(rows.column("vec")), _pivots(node)
        numbers = np.arange(len(pivots), dtype=np.int32)
        if "leaf" in shape.names:  # a receiver goes to a part that has donors
            kids = sorted(node.column("kids").to_pylist()[0], key=lambda k: k["child"])
            numbers = np.array([k["child"] for k in kids], dtype=np.int32)
            pivots, small = pivots[numbers], np.array([k["leaf"] for k in kids])
        nearest, gap = np.empty(len(points), dtype=np.int32), np.empty(len(points))
        _count(tally, len(points) * len(pivots))
        for part in _tiles(len(points), len(pivots)):
            d = _distances(points[part], pivots)
            nearest[part] = d.argmin(axis=1)
            gap[part] = d[np.arange(len(d)), nearest[part]]
        found = rows.append_column("child", pa.array(numbers[nearest])).append_column("gap", pa.array(gap))
        if "leaf" in shape.names:
            found = found.drop_columns("leaf").append_column("leaf", pa.array(small[nearest]))
        return found.select(shape.names).cast(shape)

    return assign


def _behind(to_pivot: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """At least how far each receiver is from the donors of each pivot: they lie beyond the plane halfway to the nearest pivot."""
    home = to_pivot.argmin(axis=1)
    square = to_pivot * to_pivot
    near = square[np.arange(len(square)), home][:, None]
    between = apart[home]
    with np.errstate(divide="ignore", invalid="ignore"):
        # the difference of two squares is known up to their own rounding
        beyond = (square - near - 1e-13 * (square + near)) / (2 * between * (1 + 1e-12))
    return np.where(between > 0, beyond, 0.0)


def _opened(need: int, shape: pa.Schema, tally):
    """The parts of a node that may hold one of the nearest donors of each receiver that has reached it."""

    def route(rows: pa.Table, node: pa.Table) -> pa.Table:
        if not len(rows) or not len(node):
            return shape.empty_table()
        kids = sorted(node.column("kids").to_pylist()[0], key=lambda k: k["child"])
        child, n, outer, inner, leaf = (np.array([k[name] for k in kids]) for name in ("child", "n", "outer", "inner", "leaf"))
        pivots, points = _pivots(node)[child], _matrix(rows.column("vec"))
        apart = _distances(pivots, pivots)
        known = rows.column("tau").to_numpy().astype(float)
        _count(tally, len(points) * len(pivots))
        lines, picks = [], []
        for part in _tiles(len(points), len(pivots)):
            to_pivot = _distances(points[part], pivots)
            open_ = np.flatnonzero(np.isnan(known[part]))
            if len(open_):
                # too few donors at home: every donor of a part is within pivot distance + outer radius
                reach = to_pivot[open_] + outer
                order = np.argsort(reach, axis=1)
                enough = np.cumsum(n[order], axis=1) >= need
                at = enough.argmax(axis=1)
                line = np.arange(len(reach))
                known[part.start + open_] = np.where(enough.any(axis=1), reach[line, order[line, at]], np.inf)
            limit = known[part] * (1 + 1e-9) + 2 * 10.0 ** -DISTANCE_DIGITS
            closest = np.maximum(to_pivot - outer, inner - to_pivot)
            np.maximum(closest, _behind(to_pivot, apart), out=closest)
            row, col = np.nonzero(closest <= limit[:, None])
            lines.append(row + part.start)
            picks.append(col)
        line, pick = np.concatenate(lines), np.concatenate(picks)
        found = rows.drop_columns(["tau", "leaf"]).take(pa.array(line))
        for name, values in (("tau", known[line]), ("child", child[pick]), ("leaf", leaf[pick])):
            found = found.append_column(name, pa.array(values))
        return found.select(shape.names).cast(shape)

    return route


def _boxes(base: np.ndarray, size: int) -> tuple[np.ndarray, list[int]]:
    """An order of the rows and the starts of boxes of at most ``size`` of them, each cut at the median of its widest side."""
    order, starts, todo = np.arange(len(base)), [], [(0, len(base))]
    while todo:
        start, end = todo.pop()
        inside = base[order[start:end]]
        widths = inside.max(axis=0) - inside.min(axis=0)
        widest = int(widths.argmax())
        if end - start <= size or not widths[widest] > 0:
            starts.append(start)
            continue
        half = (end - start) // 2
        order[start:end] = order[start:end][np.argpartition(inside[:, widest], half)]
        todo += [(start + half, end), (start, start + half)]
    return order, starts


def _first(row: np.ndarray, value: np.ndarray, col: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``need`` finds of each row with the smallest value, ties by column."""
    order = np.lexsort((col, value, row))
    row, value, col = row[order], value[order], col[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < need
    return row[keep], value[keep], col[keep]


def _nearest(points: np.ndarray, base: np.ndarray, need: int, tally) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``need`` rows of ``base`` nearest to each point, ties by position: point, distance, row."""
    if len(base) <= max(PLAIN_ROWS, 4 * need):
        _count(tally, len(base) * len(points))
        finds = []
        for part in _tiles(len(points), len(base)):
            d = np.round(_distances(points[part], base), DISTANCE_DIGITS)
            if len(base) > need:
                kth = np.partition(d, need - 1, axis=1)[:, need - 1]
                row, col = np.nonzero(d <= kth[:, None])
            else:
                row, col = np.nonzero(np.ones_like(d, dtype=bool))
            row, value, col = _first(row, d[row, col], col, need)
            finds.append((row + part.start, value, col))
        return tuple(np.concatenate(x) for x in zip(*finds))
    order, starts = _boxes(base, max(BOX_ROWS, 4 * need))
    sorted_, ends = base[order], [*starts[1:], len(base)]
    # a coordinate that is not a number is near nothing
    low, high = np.fmin.reduceat(sorted_, starts), np.fmax.reduceat(sorted_, starts)
    done = []
    height = max(1, BOX_CELLS // len(starts))
    for begin in range(0, len(points), height):
        some = points[begin:begin + height]
        away = np.zeros((len(some), len(starts)))
        for j in range(base.shape[1]):
            x = some[:, j, None]
            step = np.maximum(low[:, j] - x, x - high[:, j])
            np.maximum(step, 0.0, out=step)
            step *= step
            away += step
        away = np.sqrt(away, out=away)
        _count(tally, away.size)

        def meetings(row: np.ndarray, box: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
            """Points, first donor and distances for each box that points meet."""
            by = np.argsort(box, kind="stable")
            row, box = row[by], box[by]
            cuts = np.flatnonzero(np.r_[True, box[1:] != box[:-1]]) if len(box) else []
            for at, stop in zip(cuts, [*cuts[1:], len(box)]):
                b = box[at]
                donors = sorted_[starts[b]:ends[b]]
                _count(tally, (stop - at) * len(donors))
                for part in _tiles(stop - at, len(donors)):
                    who = row[at:stop][part]
                    yield who, starts[b], _distances(some[who], donors)

        # the box around a point, or the closest one, bounds the distance to the last of its neighbours
        reach = np.full(len(some), np.nan)
        for who, _, d in meetings(np.arange(len(some)), away.argmin(axis=1)):
            reach[who] = np.partition(d, need - 1, axis=1)[:, need - 1]
        limit = reach * (1 + 1e-9) + 2 * 10.0 ** -DISTANCE_DIGITS
        held, n_held = [], 0
        for who, first, d in meetings(*np.nonzero(away <= limit[:, None])):
            line, place = np.nonzero(d <= limit[who][:, None])
            held.append((who[line], np.round(d[line, place], DISTANCE_DIGITS), order[first + place]))
            n_held += len(line)
            if n_held > MAX_FINDS:
                held = [_first(*(np.concatenate(x) for x in zip(*held)), need)]
                n_held = len(held[0][0])
        if held:
            row, value, col = _first(*(np.concatenate(x) for x in zip(*held)), need)
            done.append((row + begin, value, col))
    if not done:
        return np.zeros(0, dtype=int), np.zeros(0), np.zeros(0, dtype=int)
    return tuple(np.concatenate(x) for x in zip(*done))


def _local_top_k(need: int, payload: bool, shape: pa.Schema, tally):
    """The best ``need`` donors of a leaf for each receiver that visits it."""

    def search(receivers: pa.Table, donors: pa.Table) -> pa.Table:
        if not len(receivers) or not len(donors):
            return shape.empty_table()
        donors = donors.take(pc.sort_indices(donors.column("did")))  # so the position decides between equal distances
        row, dist, pick = _nearest(_matrix(receivers.column("vec")), _matrix(donors.column("dvec")), need, tally)
        row, pick = pa.array(row), pa.array(pick)
        found = [receivers.column("rep").take(row), pa.array(dist), donors.column("did").take(pick)]
        if payload:
            found.append(donors.column("payload").take(pick))
        return pa.table(found, names=shape.names).cast(shape)

    return search


def _plain(frame: DataFrame, *names: str) -> T.StructType:
    """Field types of a frame, all nullable, as task output schema."""
    return T.StructType([T.StructField(n, frame.schema[n].dataType) for n in names])


def _meet(left: DataFrame, right: DataFrame, by: list[str], spread: str, block_rows: int, shape: T.StructType, work) -> DataFrame:
    """``work(left rows, right rows)`` for equal ``by``, with at most about ``block_rows`` left rows at a time."""
    # few nodes have many rows each, which a shuffle by node would put into one task; settled, they go to the rows
    blocks = settle(left.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks")))
    dealt = left.join(blocks, by).withColumn("_block", F.pmod(F.xxhash64(spread), F.col("_blocks")).cast("int")).drop("_blocks")
    copied = right.join(blocks, by).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    unit = [*by, "_block"]
    names = [f.name for f in shape.fields]

    def each(a: pa.Table, b: pa.Table) -> pa.Table:
        return work(a, b).select(names)

    # both sides may come from one frame: new names for the columns of one keep them apart
    copied = copied.select([F.col(c).alias(c) for c in copied.columns])
    return dealt.groupBy(*unit).cogroup(copied.groupBy(*unit)).applyInArrow(each, shape)


class _Tree:
    """Donors in leaves (``placed``: grp, path, did, dvec[, payload]) and the nodes above them, a frame for each level.

    A node is a row (grp, path, pivots, kids); a kid is (child, n, outer, inner, leaf) for each pivot that has
    donors. The path of a part is its node's path and the number of its pivot. ``roots`` tells for each group whether it is one leaf.
    """

    def __init__(self, slim: DataFrame, need: int, max_pivots: int, donors_per_pivot: int, chunk_rows: int, block_rows: int, tally):
        chunk_rows = max(chunk_rows, 2 * need)  # a leaf has room for all copies of a vector that can matter
        self.block_rows, self.tally, self.levels = block_rows, tally, []
        by = ["grp", "path"]
        open_ = slim.withColumn("path", F.lit("")).withColumnRenamed("dvec", "vec")
        leaves, columns = None, open_.columns
        size = settle(open_.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_copy") == 1).alias("vectors"))
                      .withColumn("leaf", F.col("n") <= chunk_rows))
        self.roots = size.select("grp", "leaf")
        while True:
            flagged = open_.join(size.select(*by, "leaf", "n", "vectors"), by)
            ready = flagged.where("leaf").select(columns)
            leaves = ready if leaves is None else leaves.unionByName(ready)
            if not size.where("NOT leaf").limit(1).count():
                break
            open_ = flagged.where("NOT leaf")
            # a seeded draw of different vectors of each node; no more rows of a node than that leave a task
            hashed = F.xxhash64("did", F.lit("pivot"))
            draw = F.row_number().over(Window.partitionBy(*by).orderBy(hashed, "did"))
            # hashes that about eight times as many vectors have as are drawn at most: others need not be sorted
            low = F.col("vectors") <= 8 * max_pivots
            likely = low | (hashed / F.lit(2.0 ** 64) + F.lit(0.5) < F.lit(8.0 * max_pivots) / F.col("vectors"))
            wanted = F.greatest(F.lit(2), F.least(F.lit(max_pivots), F.ceil(F.col("n") / donors_per_pivot)))
            drawn = open_.where((F.col("_copy") == 1) & likely).select(*by, "did", "vec", wanted.alias("_wanted")).withColumn("_draw", draw)
            drawn = drawn.where((F.col("_draw") <= max_pivots) & (F.col("_draw") <= F.col("_wanted")))
            pivots = cut_lineage(drawn.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_draw", "vec"))).alias("_p"))
                                 .select(*by, F.col("_p.vec").alias("pivots")))
            shape = T.StructType(_plain(open_, *columns).fields + [T.StructField("child", T.IntegerType()), T.StructField("gap", T.DoubleType())])
            parts = cut_lineage(_meet(open_.select(columns), pivots, by, "did", block_rows, shape, _assigned(to_arrow_schema(shape), None)))
            kids = parts.groupBy(*by, "child").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_copy") == 1).alias("vectors"),
                                                   F.max("gap").alias("outer"), F.min("gap").alias("inner"))
            # parts that no distance can tell apart stay as they are
            kids = kids.withColumn("leaf", (F.col("n") <= chunk_rows) | (F.col("outer") == 0) | F.isnan("outer"))
            nodes = kids.groupBy(*by).agg(F.collect_list(F.struct("child", "n", "outer", "inner", "leaf")).alias("kids")).join(pivots, by)
            self.levels.append(cut_lineage(nodes))
            below = F.concat_ws(".", "path", F.col("child").cast("string"))
            size = settle(kids.select("grp", below.alias("path"), "n", "vectors", "leaf"))
            open_ = parts.withColumn("path", below).select(columns)
        self.placed = cut_lineage(leaves.drop("_copy").withColumnRenamed("vec", "dvec"))

    def _down(self, rows: DataFrame, carried: list[str], work) -> Iterator[DataFrame]:
        """The rows at the leaves they reach, level by level; ``work`` tells which parts of a node a row goes on to."""
        shape = T.StructType(_plain(rows, "grp", "path", *carried).fields + [T.StructField("leaf", T.BooleanType()), T.StructField("child", T.IntegerType())])
        yield rows.where("leaf")
        for nodes in self.levels:
            met = _meet(rows.where("NOT leaf"), nodes, ["grp", "path"], "rep", self.block_rows, shape, work(to_arrow_schema(shape)))
            rows = cut_lineage(met.withColumn("path", F.concat_ws(".", "path", F.col("child").cast("string"))).drop("child"))
            yield rows.where("leaf")

    def homes(self, reps: DataFrame) -> DataFrame:
        """The leaf around the nearest pivots of each receiver; receivers of groups without donors go."""
        rows = cut_lineage(reps.join(self.roots, "grp").withColumn("path", F.lit("")))
        found = None
        for part in self._down(rows, ["rep", "vec"], lambda shape: _assigned(shape, self.tally)):
            part = part.select("grp", "path", "rep", "vec")
            found = part if found is None else found.unionByName(part)
        return found

    def visits(self, known: DataFrame, need: int) -> DataFrame:
        """All leaves that may hold one of the nearest donors of a receiver, but its home."""
        rows = known.join(self.roots, "grp").withColumn("path", F.lit("")).where("NOT leaf")
        found = None
        for part in self._down(rows, ["rep", "vec", "tau", "home"], lambda shape: _opened(need, shape, self.tally)):
            part = part.where("path <> home").select("grp", "path", "rep", "vec")
            found = part if found is None else found.unionByName(part)
        return found

    def search(self, visits: DataFrame, need: int, payload: bool) -> DataFrame:
        """Best ``need`` donors per receiver and leaf: rep, dist, did[, payload]."""
        fields = T.StructType([
            T.StructField("rep", visits.schema["rep"].dataType), T.StructField("dist", T.DoubleType()),
            *_plain(self.placed, "did", *(["payload"] if payload else [])).fields,
        ])
        return _meet(visits, self.placed, ["grp", "path"], "rep", self.block_rows, fields,
                     _local_top_k(need, payload, to_arrow_schema(fields), self.tally))


def _best(found: DataFrame, need: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("rep").orderBy("dist", "did"))
    return found.withColumn("_place", place).where(F.col("_place") <= need).drop("_place")


def k_nearest(
    receivers: DataFrame,
    donors: DataFrame,
    k: int,
    *,
    id_col: str,
    vector_col: str,
    within: str | None = None,
    exclude_self: bool = False,
    payload: str | None = None,
    max_pivots: int = NODE_PIVOTS,
    donors_per_pivot: int = DONORS_PER_PIVOT,
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
    tally=None,
) -> DataFrame:
    """The k nearest donors of every receiver, as ``id_col, neighbours``.

    ``neighbours`` is an array of (dist, did[, payload]) sorted by distance, then donor id. With
    ``within`` only donors of the same group count; with ``exclude_self`` a row is not its own neighbour.
    Vectors must not hold NULL. A node of the tree has at most ``max_pivots`` parts, of about ``donors_per_pivot`` donors
    or more; a leaf has at most ``chunk_rows``. ``tally``, an accumulator, counts the distances computed for receivers.
    """
    need = k + 1 if exclude_self else k
    # rows without a group form a group of their own
    group = F.coalesce(F.col(within).cast("string"), F.lit(NO_GROUP)) if within else F.lit("")
    extra = [F.col(payload).alias("payload")] if payload else []
    source = donors.select(group.alias("grp"), F.col(id_col).alias("did"), F.col(vector_col).alias("dvec"), *extra)
    asking = receivers.select(group.alias("grp"), F.col(id_col), F.col(vector_col).alias("vec"))

    if not source.limit(1).count():
        raise ValueError("no donors: nothing to take neighbours from")
    # of identical donors only the first few by id can be among the nearest
    copy_rank = F.row_number().over(Window.partitionBy("grp", "dvec").orderBy("did"))
    slim = cut_lineage(source.withColumn("_copy", copy_rank).where(F.col("_copy") <= need))
    tree = _Tree(slim, need, max_pivots, donors_per_pivot, chunk_rows, block_rows, tally)

    # identical receivers share one answer, kept under the smallest of their ids
    reps = cut_lineage(asking.groupBy("grp", "vec").agg(F.min(id_col).alias("rep")))
    homes = tree.homes(reps)
    found = tree.search(homes, need, bool(payload))
    if tree.levels:
        found = cut_lineage(found)
        reached = found.groupBy("rep").agg(F.when(F.count(F.lit(1)) == need, F.max("dist")).alias("_tau"))
        known = homes.withColumnRenamed("path", "home").join(reached, "rep", "left")
        known = cut_lineage(known.select("grp", "rep", "vec", "home", F.coalesce("_tau", F.lit(float("nan"))).alias("tau")))
        found = found.unionByName(tree.search(tree.visits(known, need), need, bool(payload)))
    fields = ["dist", "did"] + (["payload"] if payload else [])
    shape = T.ArrayType(T.StructType([T.StructField("dist", T.DoubleType()), *_plain(tree.placed, *fields[1:]).fields]))
    nothing = F.array().cast(shape)
    lists = _best(found, need).groupBy("rep").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("neighbours"))
    answers = reps.select("grp", "vec", "rep").join(lists, "rep")
    # a receiver whose group has no donor keeps its row, with an empty list
    answered = asking.join(answers.drop("rep"), ["grp", "vec"], "left")
    neighbours = F.coalesce("neighbours", nothing)
    if exclude_self:
        neighbours = F.filter(neighbours, lambda n: n["did"] != F.col(id_col))
    return answered.select(id_col, F.slice(neighbours, 1, k).alias("neighbours"))
