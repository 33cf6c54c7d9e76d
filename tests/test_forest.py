"""Forests grown from counted cells against Spark's trainer and against trees grown by hand."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tabwright.functions.state import dealt
from tabwright.operators import forest, importance
from tabwright.plans import bias
from tabwright.plans.classifier import TabularClassifier

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(21)
    n = 6_000
    table = pd.DataFrame({"a": draw.normal(0, 1, n), "b": np.round(draw.normal(0, 3, n)), "c": draw.integers(0, 2, n).astype(float), "d": 1.0})
    table["y"] = ((table.a + 0.2 * table.b + 0.5 * draw.normal(0, 1, n) > 0.5) + (table.c > 0) * (draw.random(n) < 0.3)).astype(float)
    return table, dealt(spark.createDataFrame(table))


def test_one_tree_is_sparks(rows):
    """Where nothing is drawn it is the same tree, node by node."""
    _, df = rows
    settings = dict(featuresCol="features", labelCol="y", numTrees=1, maxDepth=6, seed=3, bootstrap=False)
    few = df.limit(4_000).localCheckpoint()  # Spark takes all of up to 10,000 rows for its intervals
    mine = importance.trained(RandomForestClassifier(**settings), few, NAMES)
    theirs = RandomForestClassifier(**settings).fit(importance.assembled(few, NAMES).select("features", "y"))
    assert mine.toDebugString.split("\n", 1)[1] == theirs.toDebugString.split("\n", 1)[1]
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-12)
    assert (mine.numClasses, mine.numFeatures, mine.getNumTrees) == (theirs.numClasses, theirs.numFeatures, theirs.getNumTrees)
    probability = [[r[0].toArray() for r in m.transform(importance.assembled(few, NAMES)).select("probability").collect()] for m in (mine, theirs)]
    assert np.allclose(*probability, atol=1e-12)


def test_a_forest_is_like_sparks(rows):
    _, df = rows
    ready = importance.assembled(df, NAMES)
    mine = importance.fit_forest(df, NAMES, "y", 40, 5)
    theirs = RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=40, maxDepth=5, seed=42).fit(ready.select("features", "y"))
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.03)
    right = [m.transform(ready).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0] for m in (mine, theirs)]
    assert right[0] == pytest.approx(right[1], abs=0.01)
    assert 0.9 < mine.totalNumNodes / theirs.totalNumNodes < 1.1


def test_trees_do_not_depend_on_pieces_and_repeat(rows, monkeypatch):
    """Small parts of nodes, and pieces of a block, change where counts meet, not the trees; a second fit is the same."""
    _, df = rows
    whole = importance.fit_forest(df, NAMES, "y", 5, 6).toDebugString.split("\n", 1)[1]
    monkeypatch.setattr(forest, "PART_COUNTS", 1_000)
    monkeypatch.setattr(forest, "PARTS_AT_ONCE", 2)
    monkeypatch.setattr(forest, "PIECE_CELLS", 100)
    assert importance.fit_forest(df, NAMES, "y", 5, 6).toDebugString.split("\n", 1)[1] == whole


def test_training_input_is_counted_cells(spark, monkeypatch):
    """However many rows, trees read a row for each combination of intervals and class, with its count."""
    df = dealt(spark.range(40_000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                          (F.col("id") % 35 % 3).cast("double").alias("y")))
    limits, n_classes = forest._intervals(df, ["a", "b"], "y", 40_000, 1)
    assert limits == {"a": [0.5, 1.5, 2.5, 3.5, 4.5, 5.5], "b": [0.5, 1.5, 2.5, 3.5]} and n_classes == 3
    cells, n_tasks = forest._cells(df, ["a", "b"], "y", limits, n_classes, 40_000)
    got = cells.collect()
    codes = np.concatenate([np.frombuffer(r["codes"], dtype=np.uint8).reshape(-1, 3) for r in got])
    counts = np.concatenate([np.frombuffer(r["counts"], dtype=np.int64) for r in got])
    told = {(int(a), int(b)): (int(y), int(n)) for (a, b, y), n in zip(codes, counts)}
    assert n_tasks == 1 and len(codes) == 35 and told == {(i % 7, i % 5): (i % 3, len(range(i, 40_000, 35))) for i in range(35)}
    model = importance.fit_forest(df, ["a", "b"], "y", 20, 10)
    assert model.transform(importance.assembled(df, ["a", "b"])).where("prediction <> y").count() == 0


@pytest.mark.parametrize("count", [1, 2, 17, 50, 400])
def test_draws_are_poisson(count):
    n = 200_000
    draws = forest._Draws(np.full(n, count), 5, True)
    got = draws.of(3, 8).astype(float)
    assert got.mean() == pytest.approx(count, rel=0.02) and got.var() == pytest.approx(count, rel=0.03)
    share = (got == count).mean()
    assert share == pytest.approx(np.exp(count * np.log(count) - count - sum(np.log(np.arange(1, count + 1)))), abs=0.005)
    assert (draws.of(3, 8) == got).all() and (draws.of(4, 8) != got).any() and (draws.of(3, 9) != got).any()


def test_draws_know_the_ends_of_each_share(monkeypatch):
    """A piece of the unit interval in which the number changes is decided exactly."""
    draws = forest._Draws(np.ones(100_000, dtype=np.int64), 1, True)
    unsure = np.flatnonzero(draws.tables == forest.UNSURE)
    assert 0 < len(unsure) < 20
    draws.tables[:] = forest.UNSURE  # everything is decided exactly
    told = draws.of(0, 0)
    assert np.bincount(told)[:4] / 100_000 == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=0.006)


def test_odd_tables(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 0.0), (1.0, 1.0)], "a double, y double")
    model = importance.fit_forest(df, ["a"], "y", 3, 4)
    assert model.totalNumNodes == 3 and model.numClasses == 2
    assert importance.fit_forest(df, ["a"], "y", 2, 0).totalNumNodes == 2
    one = importance.fit_forest(df.where("y = 0"), ["a"], "y", 2, 3)
    assert one.numClasses == 1 and one.totalNumNodes == 2
    for bad in ([(None, 0.0)], [(float("nan"), 0.0)], [(1.0, None)], [(1.0, -1.0)], [(1.0, 0.5)], [(1.0, 100.0)], []):
        with pytest.raises(Exception, match="missing values|labels must"):
            importance.fit_forest(spark.createDataFrame(bad, "a double, y double"), ["a"], "y", 2, 3)
    deep = importance.fit_forest(df, ["a"], "y", 2, 20)  # deeper than trees grown here: Spark's trainer
    assert deep.getNumTrees == 2


def test_thresholds():
    assert forest.thresholds(np.array([1.0, 1.0, 2.0, 4.0]), 32) == [1.5, 3.0]
    assert forest.thresholds(np.array([5.0, 5.0]), 32) == []
    cuts = forest.thresholds(np.arange(1000.0), 10)
    assert len(cuts) == 9 and all(abs(c - (100 * (i + 1) - 0.5)) <= 1 for i, c in enumerate(cuts))
    assert len(forest.thresholds(np.random.default_rng(1).normal(0, 1, 50_000), 32)) == 31


def elimination(df):
    return importance.recursive_elimination(df, NAMES, "y", 3, 5, 4)


def ranking(df):
    return importance.forest_importance(df, NAMES, "y", 5, 4)


def permutation(df):
    model = importance.fit_forest(df, NAMES, "y", 5, 4)
    return importance.permutation_importance(df, lambda r: model.transform(importance.assembled(r, NAMES)), NAMES, "y", id_col="id",
                                             n_repeats=2, thresholds=importance.split_points(model, NAMES))


def mitigation(df):
    return bias.mitigate_bias(df.withColumn("y", F.col("y").cast("int")), ["d"], "y", "id", n_estimators=5, max_depth=4)["comparison"]


def oversampling(df):
    return TabularClassifier("y", "id", model="random_forest", params={"classifier__n_estimators": 5, "smote__k_neighbors": 3}).fit(df).transform(df)


@pytest.mark.parametrize("use", [elimination, ranking, permutation, mitigation, oversampling])
def test_every_use_of_a_forest_is_grown_from_cells(rows, monkeypatch, use):
    """None of them goes to Spark's trainer, whose work grows with rows times trees times levels."""
    def refuse(*_):
        raise AssertionError("Spark's trainer")

    monkeypatch.setattr(RandomForestClassifier, "_fit", refuse)
    df = rows[1].withColumn("id", F.monotonically_increasing_id()).localCheckpoint()
    assert use(df).count() > 0
