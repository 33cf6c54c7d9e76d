"""Oversampling of small classes with interpolated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabwright.functions.hashing import uniform
from tabwright.functions.state import cut_lineage, local_frame
from tabwright.operators.knn import k_nearest
from tabwright.operators.ranking import cut_key, quota_cuts
from tabwright.operators.split import class_counts

Strategy = str | float | Mapping


def missing_counts(counts: Sequence[tuple], strategy: Strategy = "auto") -> dict:
    """How many rows each class is short of what the strategy asks for; negative for one that has more than a mapping or ratio wants.

    ``auto`` and ``not majority`` raise every class to the largest one, ``minority`` only the smallest
    class, ``not minority`` all but the smallest, ``all`` every class; a number is the wanted ratio of
    the two classes of a binary label; a mapping gives wanted class sizes.
    """
    sizes = dict(counts)
    largest = max(sizes.values())
    top = next(c for c, n in counts if n == largest)
    low = next(c for c, n in counts if n == min(sizes.values()))
    if isinstance(strategy, Mapping):
        unknown = [c for c in strategy if c not in sizes]
        if unknown:
            raise ValueError(f"classes not in the data: {unknown}")
        return {c: int(strategy[c]) - sizes[c] if c in strategy else 0 for c in sizes}
    if isinstance(strategy, (int, float)) and not isinstance(strategy, bool):
        if len(sizes) != 2:
            raise ValueError("a ratio needs a label with two classes")
        return {c: int(largest * strategy) - sizes[low] if c == low else 0 for c in sizes}
    wanted = {
        "auto": lambda c: c != top, "not majority": lambda c: c != top, "minority": lambda c: c == low,
        "not minority": lambda c: c != low, "all": lambda c: True,
    }
    if strategy not in wanted:
        raise ValueError(f"unknown sampling strategy '{strategy}'")
    return {c: largest - n if wanted[strategy](c) else 0 for c, n in counts}


def synthetic_counts(counts: Sequence[tuple], strategy: Strategy = "auto") -> dict:
    """How many rows to add per class (see ``missing_counts``); an error where there are more rows than wanted."""
    add = missing_counts(counts, strategy)
    smaller = [c for c, n in add.items() if n < 0]
    if smaller:
        raise ValueError(f"fewer rows wanted than there are for classes {smaller}")
    return add


def resolve_sampling_strategy(df: DataFrame, label_col: str, strategy: Strategy = "auto") -> DataFrame:
    """class_value, n_rows, n_synthetic per class.

    This only reports: a class with more rows than wanted has a negative ``n_synthetic``, and ``fit_resample`` refuses such a strategy.
    """
    counts = class_counts(df, label_col)
    add = missing_counts(counts, strategy)
    kinds = df.select(F.col(label_col).alias("class_value")).schema
    return df.sparkSession.createDataFrame(pa.table({
        "class_value": pa.array([c for c, _ in counts]),
        "n_rows": pa.array([n for _, n in counts], pa.int64()),
        "n_synthetic": pa.array([add[c] for c, _ in counts], pa.int64()),
    })).withColumn("class_value", F.col("class_value").cast(kinds["class_value"].dataType))


class SMOTEBalancer:
    """Adds rows ``base + u * (neighbour - base)`` between near rows of the same class.

    Base rows are used evenly: each gets the whole share, and the remainder goes to the first rows
    in hash order. The neighbour and ``u`` come from the hash of (seed, row key, copy number).
    Resampling belongs to fitting only; there is no transform.
    """

    def __init__(self, sampling_strategy: Strategy = "auto", k_neighbors: int = 5, random_state: int = 42):
        self.sampling_strategy, self.k_neighbors, self.random_state = sampling_strategy, k_neighbors, random_state

    @staticmethod
    def neighbours(df: DataFrame, feature_cols: Sequence[str], label_col: str, id_col: str, k: int, **options) -> DataFrame:
        """The ``k`` nearest rows of the same class for every row outside the largest class, for several calls of ``fit_resample``."""
        rows = cut_lineage(df.select(
            F.col(id_col), F.col(label_col), F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("_vec")
        ).where(F.col(label_col) != class_counts(df, label_col)[0][0]))
        return k_nearest(rows, rows, k, id_col=id_col, vector_col="_vec", within=label_col, exclude_self=True, payload="_vec", **options)

    def fit_resample(self, df: DataFrame, feature_cols: Sequence[str], label_col: str, id_col: str, near: DataFrame | None = None,
                     **options) -> DataFrame:
        """Original rows (``copy_no`` 0) and synthetic ones, as features, label, source id and copy number.

        ``near`` holds neighbours found before, of all rows of the classes that grow; the first ``k_neighbors`` are used.
        """
        counts = class_counts(df, label_col)
        add = synthetic_counts(counts, self.sampling_strategy)
        short = [c for c, n in counts if add[c] > 0 and n <= self.k_neighbors]
        if short:
            raise ValueError(f"classes with fewer than {self.k_neighbors + 1} rows cannot be oversampled: {short}")
        label = df.schema[label_col].dataType
        # read several times below: counted, cut, searched and joined
        table = cut_lineage(df.select(
            F.col(id_col), F.col(label_col), F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("_vec")
        ))
        values = [F.col("_vec")[i].alias(c) for i, c in enumerate(feature_cols)]
        original = table.select(F.col(id_col).alias("source_id"), F.lit(0).alias("copy_no"), *values, F.col(label_col))
        growing = [(c, n) for c, n in counts if add[c] > 0]
        if not growing:
            return original
        spark = df.sparkSession
        wanted = pa.table({
            "class_value": pa.array([c for c, _ in growing]),
            "each": pa.array([add[c] // n for c, n in growing], pa.int64()),
            "quota": pa.array([add[c] % n for c, n in growing], pa.int64()),
        })
        quotas = local_frame(spark, wanted).withColumn("class_value", F.col("class_value").cast(label))
        rows = table.join(quotas.select(F.col("class_value").alias(label_col)), label_col, "left_semi")
        ends = quota_cuts(rows, [id_col], self.random_state, quotas.withColumn("name", F.lit("extra")), label_col,
                          sum(n for _, n in growing))
        share = quotas.join(ends.select("class_value", "cut"), "class_value", "left").select(
            F.col("class_value").alias(label_col), "each", "cut"
        )
        extra = F.coalesce(cut_key([id_col], self.random_state) <= F.col("cut"), F.lit(False)).cast("bigint")
        bases = rows.join(share, label_col).withColumn("_copies", F.col("each") + extra).where(F.col("_copies") > 0)
        bases = bases.select(id_col, label_col, "_vec", "_copies")
        if near is None:
            near = k_nearest(
                bases, rows.select(id_col, label_col, "_vec"), self.k_neighbors, id_col=id_col, vector_col="_vec",
                within=label_col, exclude_self=True, payload="_vec", **options,
            )
        else:
            near = near.withColumn("neighbours", F.slice("neighbours", 1, self.k_neighbors))
        copies = bases.join(near, id_col).withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        draw = F.md5(F.concat(
            F.lit(f"{self.random_state}:"), F.col(id_col).cast("string"), F.lit(":"), F.col("copy_no").cast("string")
        ))
        picked = F.element_at(
            "neighbours", (F.floor(uniform(draw) * F.size("neighbours")) + 1).cast("int")
        )["payload"]
        moved = F.zip_with("_vec", picked, lambda a, b: a + F.col("_u") * (b - a))
        made = copies.withColumn("_u", uniform(draw, 1)).withColumn("_new", moved)
        synthetic = made.select(
            F.col(id_col).alias("source_id"), "copy_no",
            *[F.col("_new")[i].alias(c) for i, c in enumerate(feature_cols)], F.col(label_col),
        )
        return original.unionByName(synthetic)
