"""Feature importance, selection and projection."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabwright.functions.state import dealt, local_frame, settle
from tabwright.operators.encode import FeatureEncoder
from tabwright.operators.forest import grow, grows_here
from tabwright.operators.outliers import OutlierHandler
from tabwright.operators.ranking import exact_quantiles

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_TOP = 15
# Rows times trees up to which tasks remember the node every row has reached in every tree (four bytes each).
NODE_IDS = 1_000_000_000
# Most combinations of intervals of all features for which predictions are kept in one array.
MAX_CELLS = 4_000_000


def assembled(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error").transform(df)


def default_preparation(df: DataFrame, label_col: str, encoding_map: dict, *, id_col: str, order_col: str | None = None,
                        z_thresh: float = 3.0) -> DataFrame:
    """Clip numeric features, then encode the categorical ones. The label and the key stay as they are."""
    clipped = OutlierHandler("clip", z_thresh, exclude=(label_col, id_col)).fit(df).transform(df)
    return FeatureEncoder(encoding_map, order_col=order_col or id_col).fit(clipped).transform(clipped)


def importance_frame(df: DataFrame, features: Sequence[str], values: Sequence[float]) -> DataFrame:
    return local_frame(df.sparkSession, pa.table({
        "feature": pa.array(list(features), pa.string()), "importance": pa.array([float(v) for v in values], pa.float64()),
    })).orderBy(F.desc("importance"), "feature")


def fit_forest(df: DataFrame, features: Sequence[str], label_col: str, n_estimators: int = 100, max_depth: int = 10,
               seed: int = 42):
    """Random forest on a label of 0..k-1. Returns the model; its input column is ``features``."""
    train = dealt(df.select(*features, F.col(label_col).cast("double").alias(label_col)))
    return _grown(train, features, label_col, n_estimators, max_depth, seed)


def _grown(table: DataFrame, features: Sequence[str], label_col: str, n_estimators: int, max_depth: int, seed: int):
    """The forest on a stored table with a double as label."""
    return trained(RandomForestClassifier(
        featuresCol="features", labelCol=label_col, numTrees=n_estimators, maxDepth=max_depth, seed=seed), table, features)


def trained(forest: RandomForestClassifier, table: DataFrame, features: Sequence[str]):
    """The forest on a stored table, whose label is a double: grown from counted cells, or by Spark's trainer where that has other settings."""
    n_rows, label_col = table.count(), forest.getLabelCol()
    if grows_here(forest, len(features)):
        return grow(table, features, label_col, forest, n_rows)
    forest.setCacheNodeIds(remember_nodes(n_rows, forest.getNumTrees()))
    return forest.fit(assembled(table, features).select("features", label_col))


def remember_nodes(n_rows: int, n_estimators: int) -> bool:
    """Whether rows of Spark's trainer keep the node they have reached: it spares the way down from the root, but takes memory. The forest is the same."""
    return n_rows * n_estimators <= NODE_IDS


def split_points(model, features: Sequence[str]) -> dict[str, list[float]] | None:
    """The thresholds of each feature in all trees of a model, or None if it has splits of another kind.

    Values between two neighbouring thresholds are the same to the trees.
    """
    text = model.toDebugString
    if re.search(r"If \(feature \d+ (?:not )?in ", text):
        return None
    found = {f: set() for f in features}
    for number, limit in re.findall(r"If \(feature (\d+) <= ([^)]+)\)", text):
        found[features[int(number)]].add(float(limit))
    return {f: sorted(limits) for f, limits in found.items()}


def forest_importance(df: DataFrame, features: Sequence[str], label_col: str, n_estimators: int = 100,
                      max_depth: int = 10, seed: int = 42) -> DataFrame:
    model = fit_forest(df, features, label_col, n_estimators, max_depth, seed)
    return importance_frame(df, features, model.featureImportances.toArray())


def importance_curve(importance: DataFrame) -> DataFrame:
    """rank (from 1), feature, importance and the relative drop to the next one. One row per feature."""
    order = Window.orderBy(F.desc("importance"), "feature")  # as many rows as there are features
    fall = (F.lead("importance").over(order) - F.col("importance")) / F.nullif(F.col("importance"), F.lit(0.0))
    return settle(importance).select(F.row_number().over(order).alias("rank"), "feature", "importance", fall.alias("drop"))


def importance_cliff(importance: DataFrame) -> DataFrame:
    """The first steep fall within the upper half of the ranking, or no row.

    Steep means among the lowest tenth of the relative drops.
    """
    curve = importance_curve(importance)
    limit = curve.agg(F.percentile("drop", F.lit(0.1))).scalar()
    half = curve.agg(F.floor(F.count(F.lit(1)) / F.lit(2))).scalar()
    # place in the ranking counts from 0 and must lie below half the number of features
    hit = curve.where((F.col("drop") <= limit) & (F.col("rank") - 1 < half))
    return hit.orderBy("rank").limit(1).select("rank", "feature", "importance", "drop")


def importance_elbow(importance: DataFrame) -> DataFrame:
    """The point of a falling curve that lies furthest below its chord, or no row."""
    curve = importance_curve(importance)
    span = curve.agg(F.min("importance").alias("lo"), F.max("importance").alias("hi"), F.count(F.lit(1)).alias("p"))
    lo, hi, p = (span.select(c).scalar() for c in ("lo", "hi", "p"))
    x = (F.col("rank") - 1) / F.nullif(p - F.lit(1), F.lit(0)).cast("double")
    y = (F.col("importance") - lo) / F.nullif(hi - lo, F.lit(0.0))
    below = curve.withColumn("depth", F.lit(1.0) - x - y).where(F.col("depth") > 1e-12)
    return below.orderBy(F.desc("depth"), "rank").limit(1).select("rank", "feature", "importance", "depth")


def top_features(importance: DataFrame, fallback: int = DEFAULT_TOP) -> DataFrame:
    """Features down to the cliff, else down to the elbow, else the first ``fallback``."""
    importance = settle(importance)
    rows = importance_cliff(importance).select("rank").collect() or importance_elbow(importance).select("rank").collect()
    last = rows[0]["rank"] if rows else fallback
    return importance_curve(importance).where(F.col("rank") <= last).select("rank", "feature", "importance")


def permutation_importance(df: DataFrame, predict: Callable[[DataFrame], DataFrame], features: Sequence[str], label_col: str,
                           *, id_col: str, n_repeats: int = 10, seed: int = 42, prediction_col: str = "prediction",
                           rows_per_bucket: int = 1000, thresholds: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Mean loss of accuracy when one column is shuffled.

    Rows are dealt into random buckets of about ``rows_per_bucket`` by a hash of the id and lie there in hash order; a repeat
    pairs each row with the one a random distance further on in its bucket, which is a random pairing of a random part of
    the table. So rows are shuffled once, whatever the number of repeats and columns, and ``predict`` sees
    all variants in one pass.

    ``thresholds`` (see ``split_points``) tells for every column the values that predictions change behind. If they make at most
    ``MAX_CELLS`` combinations of intervals, ``predict`` sees one row for each of these, and variants look their predictions up.
    """
    names = list(features)
    base = df.select(id_col, label_col, *names)
    key = F.xxhash64(F.col(id_col), F.lit(seed))
    values = [F.col(c).cast("double") for c in names]
    numeric = isinstance(df.schema[label_col].dataType, T.NumericType)
    sizes = [len(thresholds[c]) + 1 for c in names] if thresholds and numeric else []
    in_cells = bool(sizes) and math.prod(sizes) <= MAX_CELLS
    hits = F.avg((F.col(prediction_col) == F.col(label_col)).cast("double"))
    if in_cells:
        n_rows = base.count()
    else:
        first = predict(base).agg(hits.alias("a"), F.count(F.lit(1)).alias("n")).first()
        start, n_rows = first["a"], first["n"]
    buckets = max(1, (n_rows or 0) // rows_per_bucket)
    row = F.struct(key.alias("h"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.array(*values).alias("x"))
    held = base.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    # at least one row on, at most one row back
    size = F.size("_rows")

    def far(repeat):
        step = F.pmod(F.xxhash64("_bucket", repeat, F.lit(seed)), (size - 1).cast("long")) + 1
        return F.when(size > 1, step).otherwise(F.lit(0)).cast("int")

    labels = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("_column") + 1)
    if in_cells:
        given = _cell_predictions(base, predict, names, thresholds, sizes, prediction_col)
        held = held.select(
            F.transform("_rows", lambda r: r["label"].cast("double")).alias("label"), F.flatten(F.col("_rows.x")).alias("x"),
            F.array(*[far(F.lit(r)) for r in range(n_repeats)]).alias("far"))
        counted = held.mapInArrow(_shifted_hits([thresholds[c] for c in names], sizes, given), "_column int, repeat int, hits long, n long")
        counted = counted.groupBy("_column", "repeat").agg((F.sum("hits") / F.nullif(F.sum("n"), F.lit(0))).alias("a"))
        scored = settle(counted, max_rows=max(1, len(names) * n_repeats + 1))
        start = scored.where("_column < 0").select("a").scalar()
        scored = scored.where("_column >= 0")
    else:
        held = held.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))
        turned = F.concat(F.slice("_rows", F.col("_far") + 1, F.size("_rows")), F.slice("_rows", F.lit(1), F.col("_far")))
        pairs = F.arrays_zip(F.col("_rows").alias("row"), F.transform(turned, lambda r: r["x"]).alias("given"))
        held = held.withColumn("_far", far(F.col("repeat"))).select("repeat", pairs.alias("_pairs"))
        paired = held.select("repeat", F.inline("_pairs").alias("_row", "_given"))
        variants = paired.withColumn("_column", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1)))).select(
            F.col("_row.label").alias(label_col), "repeat", "_column",
            *[F.when(F.col("_column") == i, F.col("_given")[i]).otherwise(F.col("_row.x")[i]).alias(c) for i, c in enumerate(names)],
        )
        scored, start = predict(variants).groupBy("_column", "repeat").agg(hits.alias("a")), F.lit(start)
    lost = scored.groupBy("_column").agg(
        F.avg(start - F.col("a")).alias("importance"), F.stddev_pop(start - F.col("a")).alias("deviation")
    )
    return lost.select(labels.alias("feature"), "importance", "deviation").orderBy(F.desc("importance"), "feature")


def _cell_predictions(df: DataFrame, predict: Callable, names: Sequence[str], thresholds: Mapping, sizes: Sequence[int],
                      prediction_col: str) -> np.ndarray:
    """The prediction for every combination of intervals, the last feature running fastest. At most ``MAX_CELLS`` of them."""
    grid, step = [], 1
    for c, n in reversed(list(zip(names, sizes))):
        # an interval ends at its threshold and holds it; the last one begins right behind the highest
        ends = [*thresholds[c], math.nextafter(thresholds[c][-1], math.inf) if thresholds[c] else 0.0]
        at = F.pmod(F.floor(F.col("_cell") / F.lit(step)), F.lit(n)).cast("int") + 1
        grid.append(F.element_at(F.array(*[F.lit(float(e)) for e in ends]), at).alias(c))
        step *= n
    cells = df.sparkSession.range(step).withColumnRenamed("id", "_cell").select("_cell", *grid)
    told = predict(cells).select("_cell", F.col(prediction_col).cast("double").alias("p")).toArrow()
    out = np.full(step, np.nan)
    out[told["_cell"].to_numpy()] = told["p"].to_numpy()
    return out


def _shifted_hits(thresholds: Sequence[Sequence[float]], sizes: Sequence[int], given: np.ndarray) -> Callable:
    """Counts of right predictions, for the rows as they are (column -1) and with each column taken from a row further on."""
    limits = [np.asarray(t, dtype=float) for t in thresholds]
    steps = [math.prod(sizes[i + 1:]) for i in range(len(sizes))]
    kinds, told = np.unique(given, return_inverse=True)
    told = told.astype(np.min_scalar_type(len(kinds)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            label, x, far = (batch.column(name) for name in ("label", "x", "far"))
            for k in range(batch.num_rows):
                y = label[k].values.to_numpy(zero_copy_only=False)
                points = x[k].values.to_numpy(zero_copy_only=False).reshape(len(y), len(limits))
                if np.isnan(points).any():
                    raise ValueError("missing values among the features")
                # a place among thresholds: values up to and with the first one are 0
                places = [np.searchsorted(t, points[:, i], side="left") * steps[i] for i, t in enumerate(limits)]
                cell, known = sum(places), ~np.isnan(y)

                def add(column: int, repeat: int, cells: np.ndarray) -> None:
                    tally = sums.setdefault((column, repeat), [0, 0])
                    tally[0] += int((kinds[told[cells]] == y)[known].sum())
                    tally[1] += int(known.sum())

                add(-1, 0, cell)
                for repeat, distance in enumerate(far[k].as_py()):
                    for i, own in enumerate(places):
                        add(i, repeat, cell - own + np.roll(own, -distance))
        if sums:
            yield pa.RecordBatch.from_arrays([
                pa.array([c for c, _ in sums], pa.int32()), pa.array([r for _, r in sums], pa.int32()),
                pa.array([v[0] for v in sums.values()], pa.int64()), pa.array([v[1] for v in sums.values()], pa.int64()),
            ], names=["_column", "repeat", "hits", "n"])

    return count


def importance_vs_correlation(forest: DataFrame, permuted: DataFrame, correlation: DataFrame) -> DataFrame:
    """Both importances and the target correlation, side by side on a scale whose largest value is 1."""
    joined = (
        forest.select("feature", F.col("importance").alias("rf_importance"))
        .join(permuted.select("feature", F.col("importance").alias("perm_importance")), "feature", "full_outer")
        .join(correlation.select("feature", F.col("r").alias("correlation")), "feature", "full_outer")
        .fillna(0.0)
    )
    joined = joined.withColumn("correlation_abs", F.abs("correlation"))
    everything = Window.partitionBy(F.lit(0))  # as many rows as there are features
    scaled = lambda c: F.coalesce(F.col(c) / F.nullif(F.max(c).over(everything), F.lit(0.0)), F.lit(0.0))
    return joined.withColumns({
        "rf_importance_norm": scaled("rf_importance"), "perm_importance_norm": scaled("perm_importance"),
        "correlation_norm": scaled("correlation_abs"),
    }).withColumn("importance_corr_diff", F.col("rf_importance_norm") - F.col("correlation_norm")).orderBy(
        F.abs("importance_corr_diff").desc(), "feature"
    )


def classify_features(comparison: DataFrame, gap: float = 0.3, floor: float = 0.3, high: float = 0.5) -> DataFrame:
    """Flags: non-linear (important, little correlated), spurious (the reverse), consistent (both)."""
    imp, corr = F.col("rf_importance_norm"), F.col("correlation_norm")
    return comparison.withColumns({
        "non_linear": (imp > corr + F.lit(gap)) & (imp > F.lit(floor)),
        "spurious": (corr > imp + F.lit(gap)) & (corr > F.lit(floor)),
        "consistent": (imp > F.lit(high)) & (corr > F.lit(high)),
    })


def recommended_features(top: DataFrame, classified: DataFrame | None = None) -> DataFrame:
    """Consistent, top and non-linear features together, in name order."""
    out = top.select("feature")
    if classified is not None:
        out = out.union(classified.where(F.col("consistent") | F.col("non_linear")).select("feature"))
    return out.distinct().orderBy("feature")


def mutual_information(df: DataFrame, columns: Sequence[str], label_col: str, bins: int = 10) -> DataFrame:
    """Information (in nats) each numeric column, cut at its quantiles, gives about the class.

    The cut points are exact quantiles found once; binning is then a comparison per row and the rest works
    on at most bins x classes counts per column.
    """
    probs = [i / bins for i in range(1, bins)]
    edges = {r["feature"]: r["q"] for r in exact_quantiles(df, columns, probs).collect()}
    cells = []
    for c in columns:
        value = F.col(c).cast("double")
        place = sum(((value > F.lit(e)).cast("int") for e in edges[c] or []), F.lit(0))
        cells.append(F.struct(F.lit(c).alias("feature"), F.when(value.isNotNull(), place).alias("bin")))
    counts = df.where(F.col(label_col).isNotNull()).select(
        F.col(label_col).alias("class"), F.inline(F.array(*cells))
    ).where(F.col("bin").isNotNull()).groupBy("feature", "bin", "class").agg(F.count(F.lit(1)).cast("double").alias("n"))
    whole, per_bin, per_class = (Window.partitionBy("feature", *k) for k in ([], ["bin"], ["class"]))
    parts = counts.withColumns({
        "_all": F.sum("n").over(whole), "_b": F.sum("n").over(per_bin), "_c": F.sum("n").over(per_class)
    })
    term = F.col("n") / F.col("_all") * F.ln(F.col("n") * F.col("_all") / (F.col("_b") * F.col("_c")))
    return parts.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


def select_k_best(information: DataFrame, k: int = 20) -> DataFrame:
    return information.orderBy(F.desc("mutual_information"), "feature").limit(k)


def recursive_elimination(df: DataFrame, features: Sequence[str], label_col: str, keep: int = 20, n_estimators: int = 100,
                          max_depth: int = 10, seed: int = 42) -> DataFrame:
    """Refit and drop the least important feature until ``keep`` are left. ``ranking`` is 1 for the kept."""
    names, dropped = list(features), []
    table = dealt(df.select(*names, F.col(label_col).cast("double").alias(label_col))) if len(names) > keep else df
    while len(names) > keep:
        values = _grown(table, names, label_col, n_estimators, max_depth, seed).featureImportances.toArray()
        weakest = min(range(len(names)), key=lambda i: (values[i], -i))
        dropped.append(names.pop(weakest))
    ranking = {f: 1 for f in names} | {f: 1 + len(dropped) - i for i, f in enumerate(dropped)}
    return df.sparkSession.createDataFrame([(f, ranking[f], ranking[f] == 1) for f in features],
                                           "feature string, ranking int, selected boolean")


def vote(selections: Sequence[DataFrame], votes: int = 2) -> DataFrame:
    """Features chosen by at least ``votes`` of the selections."""
    chosen = selections[0].select("feature").distinct()
    for s in selections[1:]:
        chosen = chosen.unionByName(s.select("feature").distinct())
    return chosen.groupBy("feature").agg(F.count(F.lit(1)).alias("votes")).where(F.col("votes") >= votes).orderBy("feature")


def principal_components(df: DataFrame, features: Sequence[str], k: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """Coordinates on the first k components of the centred features; each axis has its largest loading positive."""
    means = df.agg(*[F.avg(c).alias(c) for c in features]).first()
    centred = df.select(*keep, *[(F.col(c).cast("double") - F.lit(means[c])).alias(f"_x_{c}") for c in features])
    ready = assembled(centred, [f"_x_{c}" for c in features], "_x")
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(ready)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    coordinates = vector_to_array("_pc")
    return model.transform(ready).select(
        *keep, *[(coordinates[i] * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(k)]
    )


