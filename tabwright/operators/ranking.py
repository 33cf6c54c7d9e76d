"""Exact ranks, quotas and quantiles without sorting a group in one task.

A plain ``row_number()`` over a whole table, or over a class that holds a third of it, sends
that many rows to one task. The helpers here first count rows per bucket of the sort key, then
work only inside buckets (ranks), or only inside the buckets that hold an answer (quotas,
quantiles). The answers are the exact ones.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions.hashing import order_hash
from tabwright.functions.state import cut_lineage, local_frame, settle

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Most rows that are ranked in one place.
RANKED_ROWS = 20_000
# Cut points that one scan works with.
CUTS_AT_ONCE = 1_000_000


def bucket_digits(n_rows: int) -> int:
    """Hex digits of the hash that name a bucket: about as many buckets as rows per bucket."""
    return min(8, max(2, round(math.log(max(n_rows, 1), 16) / 2)))


def quota_cuts(
    df: DataFrame,
    id_cols: Sequence[str],
    seed: int | str,
    quotas: DataFrame,
    class_col: str | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Where each quota ends in the seeded hash order of each class.

    ``quotas`` has one row per (class, name) with ``class_value``, ``name`` and ``quota``: how many
    rows, counted from the start of the hash order, the name covers. The result has
    ``class_value, name, cut`` where ``cut`` is the (hash, id...) struct of the last covered row;
    a quota of zero gives no row. Two scans, and of n rows only about the square root of n per quota
    are ever sorted.
    """
    digits = bucket_digits(df.count() if n_rows is None else n_rows)
    klass = F.col(class_col) if class_col else F.lit(0)
    keyed = df.select(klass.alias("class_value"), order_hash(id_cols, seed).alias("_h"), *id_cols)
    keyed = keyed.withColumn("_bucket", F.substring("_h", 1, digits))
    per_bucket = keyed.groupBy("class_value", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket and class reaches this window
    running = per_bucket.withColumn(
        "_upto", F.sum("_n").over(Window.partitionBy("class_value").orderBy("_bucket"))
    )
    hit = running.alias("r").join(
        quotas.alias("q"), F.col("r.class_value").eqNullSafe(F.col("q.class_value"))
    ).where(
        (F.col("quota") > F.col("_upto") - F.col("_n")) & (F.col("quota") <= F.col("_upto"))
    ).select(
        F.col("r.class_value").alias("class_value"), "name", "_bucket",
        (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_rest"),
    )
    hit = settle(hit)
    inside = keyed.alias("k").join(
        hit.alias("h"),
        (F.col("k._bucket") == F.col("h._bucket"))
        & F.col("k.class_value").eqNullSafe(F.col("h.class_value")),
    ).select(
        F.col("h.class_value").alias("class_value"), "name", "_rest",
        F.struct(F.col("k._h").alias("h"), *[F.col(f"k.{c}") for c in id_cols]).alias("cut"),
    )
    ranked = inside.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("class_value", "name").orderBy("cut"))
    )
    return settle(ranked.where(F.col("_rn") == F.col("_rest")).select("class_value", "name", "cut"))


def cut_key(id_cols: Sequence[str], seed: int | str) -> Column:
    """The struct a row is compared with a cut by."""
    return F.struct(order_hash(id_cols, seed).alias("h"), *[F.col(c) for c in id_cols])


def with_position(df: DataFrame, order_col: str | Column, tie_cols: Sequence[str] = (), name: str = "rn",
                  rows_per_bucket: int = 500_000) -> DataFrame:
    """Exact 0-based rank of every row by ``order_col`` (any type that can be ordered; NULL comes first).

    Rows are dealt by range of (``order_col``, ``tie_cols``, hash of the row), so a value of any frequency, or any
    number of NULLs, spreads over as many buckets as it needs; there are as many buckets as ``rows_per_bucket``
    asks for. Each bucket is sorted by itself and stored; a rank is the place in the bucket plus the rows before
    it. Equal rows without tie columns come in the order of their hash.
    """
    key = F.col(order_col) if isinstance(order_col, str) else order_col
    buckets = max(1, -(-df.count() // rows_per_bucket))
    order = [F.col("_key").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie_cols], F.col("_tie").asc()]
    keyed = df.withColumns({"_key": key, "_tie": F.xxhash64(*df.columns)})
    dealt = keyed.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    # this number is the partition in its upper bits and the place in it below; stored, so that both stay as they are
    placed = cut_lineage(dealt.withColumn("_sorted", F.monotonically_increasing_id()).drop("_key", "_tie"))
    placed = placed.withColumn("_range", F.shiftright("_sorted", 33))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per bucket reaches this window
    before = settle(sizes.select("_range", (F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")).alias("_before")))
    rank = F.col("_before") + F.col("_sorted").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(before, "_range").withColumn("_rank", rank).drop("_range", "_sorted", "_before").withColumnRenamed("_rank", name)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    direct_rows: int = RANKED_ROWS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact linearly interpolated quantiles, as rows ``by..., feature, q`` (array aligned to probs).

    Groups of at most ``direct_rows`` rows use the built-in ``percentile``, whose state is bounded by that
    number. In larger ones every column has a sorted array of cut points on both sides of the wanted
    ranks. One scan counts the values of all columns between and at the cuts (binary search); a stretch that holds a wanted rank and more
    than ``direct_rows`` rows gets cuts of its own from a sample of about ``accuracy`` of its values, and the next scan counts
    again. In the end only the short stretches that hold wanted ranks are tallied. Samples decide where cuts lie, never a result.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    base = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    sizes = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), F.array(*[F.count(c) for c in columns]).alias("_n"))
    large = settle(sizes.where(F.col("_rows") > direct_rows))
    n_large = large.count()
    if n_large:
        # scanned several times: what it is derived from (joins, broadcasts) is computed once
        base = cut_lineage(base)
    parts = []
    if not n_large or by:
        small = base
        if n_large:
            names = {b: f"_g_{i}" for i, b in enumerate(by)}
            same = F.lit(True)
            for b, g in names.items():
                same = same & F.col(b).eqNullSafe(F.col(g))
            small = base.join(large.select(*by).withColumnsRenamed(names), same, "left_anti")
        wide = small.groupBy(*by).agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in columns])
        records = F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("array<double>").alias("q")) for c in columns
        ])
        parts.append(wide.select(*by, F.inline(records)))
    blocks = -(-n_large * len(columns) * (4 * len(probs) + 1) // CUTS_AT_ONCE)
    for block in range(blocks):
        chosen = large.where(F.pmod(F.xxhash64(*by), F.lit(blocks)) == block) if blocks > 1 and by else large
        parts.append(_Cuts(base, columns, probs, by, chosen.toArrow(), max(direct_rows, accuracy), accuracy).found())
        if not by:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class _Line:
    """One column of one group: sorted cuts, and the number of values in every stretch.

    Stretch 2k lies below cut k (above cut k - 1); stretch 2k + 1 is the cut itself.
    """

    def __init__(self, n: int, probs: Sequence[float]):
        self.n, self.cuts, self.counts = n, np.zeros(0), np.array([n], np.int64)
        places = [(n - 1) * p for p in probs] if n else []
        self.ranks = sorted({r for x in places for r in (math.floor(x), math.ceil(x))})

    def wanted(self) -> dict[int, list[int]]:
        """Stretches between cuts that hold wanted ranks, with those ranks counted from the stretch's start."""
        ends = np.cumsum(self.counts)
        held: dict[int, list[int]] = {}
        for rank in self.ranks:
            stretch = int(np.searchsorted(ends, rank, side="right"))
            if stretch % 2 == 0:
                held.setdefault(stretch, []).append(rank - int(ends[stretch] - self.counts[stretch]))
        return held

    def at_cuts(self) -> dict[int, float]:
        ends = np.cumsum(self.counts)
        stretches = {rank: int(np.searchsorted(ends, rank, side="right")) for rank in self.ranks}
        return {rank: float(self.cuts[s // 2]) for rank, s in stretches.items() if s % 2}

    def start(self, stretch: int) -> int:
        return int(self.counts[:stretch].sum())


def _stretches(cuts: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, side="left") + np.searchsorted(cuts, values, side="right")


def _by_line(batch: pa.RecordBatch, lines) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """The values of each (group, column) among ``lines`` in a batch of (group, columns...)."""
    group = batch.column(0).to_numpy()
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
        rows = pa.array(order[start:stop])
        for c in range(batch.num_columns - 1):
            key = int(group[order[start]]), c
            if key in lines:
                column = batch.column(c + 1) if len(rows) == len(group) else batch.column(c + 1).take(rows)
                yield key, column.drop_null().to_numpy(zero_copy_only=False)


class _Cuts:
    """Quantiles of the large groups of one block: a few scans of the whole table, all groups and columns at once."""

    def __init__(self, base: DataFrame, columns: list[str], probs: list[float], by: list[str], groups: pa.Table, few: int, accuracy: int):
        self.spark, self.columns, self.probs, self.by, self.groups, self.few, self.accuracy = base.sparkSession, columns, probs, by, groups, few, accuracy
        self.lines = {(g, c): _Line(n[c], probs) for g, n in enumerate(groups["_n"].to_pylist()) for c in range(len(columns))}
        if by:
            names = [f"_g_{i}" for i in range(len(by))]
            known = groups.select(by).rename_columns(names).append_column("_group", pa.array(np.arange(len(groups), dtype=np.int32)))
            same = F.lit(True)
            for b, g in zip(by, names):
                same = same & F.col(b).eqNullSafe(F.col(g))
            base = base.join(local_frame(self.spark, known), same)
        else:
            base = base.withColumn("_group", F.lit(0))
        self.data = base.select("_group", *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])

    def found(self) -> DataFrame:
        turn = 0
        while True:
            crowded = {
                key: {s: ranks for s, ranks in line.wanted().items() if line.counts[s] > self.few} for key, line in self.lines.items()
            }
            crowded = {key: held for key, held in crowded.items() if held}
            if not crowded:
                break
            turn += 1
            for row in self._sampled(crowded, turn):
                line = self.lines[row["line"], row["col"]]
                line.cuts = np.union1d(line.cuts, row["cuts"])
            self._count(list(crowded))
        known = {key: line.at_cuts() for key, line in self.lines.items()}
        short = {key: line.wanted() for key, line in self.lines.items()}
        short = {key: held for key, held in short.items() if held}
        if short:
            for row in self._ranked(short):
                line = self.lines[row["line"], row["col"]]
                known[row["line"], row["col"]][line.start(row["stretch"]) + row["rank"]] = row["value"]
        rows = {"feature": [], "q": [], "_at": []}
        for (g, c), line in self.lines.items():
            values, q = known[g, c], []
            for p in self.probs if line.n else []:
                x = (line.n - 1) * p
                low, high = values[math.floor(x)], values[math.ceil(x)]
                q.append(low if low == high else low + (high - low) * (x - math.floor(x)))
            rows["feature"].append(self.columns[c])
            rows["q"].append(q if line.n else None)
            rows["_at"].append(g)
        columns = [self.groups[b].take(pa.array(rows["_at"])) for b in self.by]
        return local_frame(self.spark, pa.table(
            [*columns, pa.array(rows["feature"], pa.string()), pa.array(rows["q"], pa.list_(pa.float64()))], names=[*self.by, "feature", "q"]))

    def _sampled(self, crowded: dict, turn: int) -> list[dict]:
        """New cuts around the wanted ranks of crowded stretches, from a sample of their values."""
        plan, size = {}, self.accuracy
        for key, held in crowded.items():
            line = self.lines[key]
            steps, points = {}, {}
            for stretch, ranks in held.items():
                n = int(line.counts[stretch])
                # a batch adds an error of about one value to the sample
                slack = (2 * math.sqrt(min(n / 1000, size)) + 2) / min(n, size)
                steps[stretch] = max(1, n // size)
                points[stretch] = sorted({min(1.0, max(0.0, r / max(n - 1, 1) + side)) for r in ranks for side in (-slack, slack)})
            plan[key] = (line.cuts, steps, points)

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, batch in enumerate(batches):
                chance = np.random.default_rng([turn, number, batch.num_rows])
                for (g, c), values in _by_line(batch, plan):
                    cuts, steps, _ = plan[g, c]
                    where = _stretches(cuts, values)
                    for stretch, step in steps.items():
                        held = np.sort(values[where == stretch] if len(cuts) else values)
                        taken = held[int(chance.integers(step))::step]
                        if len(taken):
                            yield _rows(line=g, col=c, stretch=stretch, value=taken)

        def cut(table: pa.Table) -> pa.Table:
            key = table["line"][0].as_py(), table["col"][0].as_py()
            points = plan[key][2][table["stretch"][0].as_py()]
            chosen = np.unique(np.quantile(table["value"].to_numpy(), points, method="nearest"))
            return pa.table({"line": pa.array([key[0]], pa.int32()), "col": pa.array([key[1]], pa.int32()), "cuts": pa.array([chosen], pa.list_(pa.float64()))})

        sample = self.data.mapInArrow(draw, "line int, col int, stretch int, value double")
        return sample.groupBy("line", "col", "stretch").applyInArrow(cut, "line int, col int, cuts array<double>").toArrow().to_pylist()

    def _count(self, keys: list) -> None:
        plan = {key: self.lines[key].cuts for key in keys}

        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for batch in batches:
                for key, values in _by_line(batch, plan):
                    counts = np.bincount(_stretches(plan[key], values), minlength=2 * len(plan[key]) + 1)
                    sums[key] = sums[key] + counts if key in sums else counts
            for (g, c), counts in sums.items():
                held = np.flatnonzero(counts)
                yield _rows(line=g, col=c, stretch=held.astype(np.int32), n=counts[held])

        for key in keys:
            self.lines[key].counts = np.zeros(2 * len(plan[key]) + 1, np.int64)
        counted = self.data.mapInArrow(tally, "line int, col int, stretch int, n long").groupBy("line", "col", "stretch").agg(F.sum("n").alias("n"))
        for row in counted.toArrow().to_pylist():
            self.lines[row["line"], row["col"]].counts[row["stretch"]] = row["n"]

    def _ranked(self, short: dict) -> list[dict]:
        """The values at the wanted ranks of short stretches, from tallies of their values."""
        plan = {key: (self.lines[key].cuts, held) for key, held in short.items()}

        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for (g, c), values in _by_line(batch, plan):
                    cuts, held = plan[g, c]
                    where = _stretches(cuts, values)
                    for stretch in held:
                        value, n = np.unique(values[where == stretch], return_counts=True)
                        if len(value):
                            yield _rows(line=g, col=c, stretch=stretch, value=value, n=n.astype(np.int64))

        def rank(table: pa.Table) -> pa.Table:
            g, c, stretch = (table[name][0].as_py() for name in ("line", "col", "stretch"))
            ranks = plan[g, c][1][stretch]
            value, n = table["value"].to_numpy(), table["n"].to_numpy()
            order = np.argsort(value)
            at = np.searchsorted(np.cumsum(n[order]), ranks, side="right")
            return pa.Table.from_batches([_rows(line=g, col=c, stretch=np.full(len(ranks), stretch, np.int32), rank=np.array(ranks, np.int64), value=value[order][at])])

        tallied = self.data.mapInArrow(tally, "line int, col int, stretch int, value double, n long")
        return tallied.groupBy("line", "col", "stretch").applyInArrow(rank, "line int, col int, stretch int, rank long, value double").toArrow().to_pylist()


def _rows(**columns) -> pa.RecordBatch:
    """A batch of arrays; whole numbers among the arguments are repeated as 32-bit columns."""
    length = max(len(v) for v in columns.values() if not isinstance(v, int))
    arrays = [pa.array(np.full(length, v, np.int32)) if isinstance(v, int) else pa.array(v) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
