"""Correlation, shape, metrics, selection and the composed plans."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.catalog.modelling import SETTINGS
from tabwright.functions.state import dealt
from tabwright.operators import correlate, distribution, evaluate, importance, profile
from tabwright.operators.split import stratified_folds
from tabwright.plans import analysis, bias, search
from tabwright.plans.classifier import TabularClassifier
from tabwright.plans.curation import CurationSpec, curate
from tabwright.sources import files


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(2)
    n = 300
    y = draw.integers(0, 3, n)
    a = y * 4 + draw.normal(0, 1, n)
    frame = pd.DataFrame({
        "id": np.arange(n), "a": a, "b": a * 2 + draw.normal(0, 0.1, n), "c": draw.normal(0, 1, n),
        "d": np.exp(draw.normal(0, 2, n)), "kind": np.where(draw.random(n) < 0.3, "p", "q"), "y": y,
    })
    return frame, spark.createDataFrame(frame).repartition(4)


def test_pairs_ignore_rows_with_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 6.5)], "a double, b double")
    want = np.corrcoef([1, 3, 4], [2, 5, 6.5])[0, 1]
    assert correlate.correlation_pairs(df).first()["r"] == pytest.approx(want)


def test_ward_merge():
    # 0,1 close; 2,3,4 close; 5 alone. Two points at distance d merge at d, in Ward's measure.
    d = np.full((6, 6), 1.0)
    for i, j, v in [(0, 1, 0.1), (2, 3, 0.2), (2, 4, 0.2), (3, 4, 0.2)]:
        d[i, j] = d[j, i] = v
    np.fill_diagonal(d, 0)
    assert correlate.merge_by_ward(d, 0.5) == [1, 1, 2, 2, 2, 3]
    assert correlate.merge_by_ward(d, 0.15) == [1, 1, 2, 3, 4, 5]
    assert len(set(correlate.merge_by_ward(d, 5.0))) == 1


def test_ward_heights_follow_the_definition():
    # on a line, joining {0, 1} with {4} costs sqrt(2 * 2 * 1 / 3) * |0.5 - 4|
    x = np.array([0.0, 1.0, 4.0])
    d = np.abs(x[:, None] - x[None, :])
    height = np.sqrt(2 * 2 * 1 / 3) * 3.5
    assert correlate.merge_by_ward(d, height - 1e-6) == [1, 1, 2]
    assert correlate.merge_by_ward(d, height + 1e-6) == [1, 1, 1]


def test_correlation_analysis(table):
    _, df = table
    out = analysis.correlation_analysis(df, "y", ["a", "b", "c", "d"])
    pair = out["multicollinear"].collect()
    assert [(r["a"], r["b"]) for r in pair] == [("a", "b")]
    clusters = {r["feature"]: r["cluster"] for r in out["clusters"].collect()}
    assert clusters["a"] == clusters["b"] and len(set(clusters.values())) == 3
    assert {r["feature"] for r in out["isolated"].collect()} == {"c", "d"}
    assert out["cluster_summary"].count() == 1


def test_shape_statistics_equal_pandas(table):
    frame, df = table
    rows = {r["feature"]: r for r in distribution.basic_stats(df, ["a", "d"]).collect()}
    for c in ("a", "d"):
        assert rows[c]["skew"] == pytest.approx(frame[c].skew()) and rows[c]["kurtosis"] == pytest.approx(frame[c].kurt())
        assert rows[c]["median"] == pytest.approx(frame[c].median())


def test_constant_column_has_no_skew(spark):
    df = spark.createDataFrame([(5.0,)] * 6, "k double")
    row = distribution.basic_stats(df, ["k"]).first()
    assert (row["skew"], row["kurtosis"]) == (0.0, 0.0)


def test_candidates_share_their_preparation(spark):
    """Every step of a fold is computed once per setting it rests on, and gives what a fit of its own gives."""
    draw = np.random.default_rng(4)
    n = 240
    table = pd.DataFrame({"id": np.arange(n), "a": draw.normal(0, 1, n), "b": draw.normal(0, 1, n), "c": draw.choice(["u", "v", "w"], n)})
    table["y"] = (table.a + 0.3 * draw.normal(0, 1, n) > 0.8).astype(int)
    df = spark.createDataFrame(table)
    estimator = TabularClassifier("y", "id", {"c": "frequency"}, model="random_forest")
    space = {"outlier_handler__strategy": ["none", "clip"], "smote__k_neighbors": [2, 4], "classifier__n_estimators": [3, 5], "classifier__max_depth": [3]}
    found = search.tune_hyperparameters(df, estimator, space, n_iter=8, cv=2, scoring="f1_weighted")
    assert found.steps == {"clip": 4, "encode": 4, "neighbours": 4, "balance": 8, "outside": 4, "inside": 4}
    rows = found.table.collect()
    assert len(rows) == 8 and [r["mean_test_score"] for r in rows] == sorted((r["mean_test_score"] for r in rows), reverse=True)
    alone = estimator.with_params(found.best_params).fit(df).transform(df).orderBy("id").select("prediction").collect()
    assert alone == found.model.transform(df).orderBy("id").select("prediction").collect()
    folds = stratified_folds(df, "y", "id", 2, 42, output="_fold")
    for row in rows[:2]:
        params = {k: type(space[k][0])(v) for k, v in row["params"].items()}
        scores = []
        for fold in range(2):
            model = estimator.with_params(params).fit(folds.where(F.col("_fold") != fold).drop("_fold"))
            scores.append(evaluate.averaged_score(model.transform(folds.where(F.col("_fold") == fold)), "y", "prediction", "f1", True).first()[0])
        # trees drawn from rows in another order may differ a little
        assert np.mean(scores) == pytest.approx(row["mean_test_score"], abs=0.05)


def test_scores_equal_their_definitions(spark):
    draw = np.random.default_rng(6)
    y, p = draw.integers(0, 3, 300), draw.integers(0, 4, 300)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    classes = range(4)
    hit = np.array([((y == c) & (p == c)).sum() for c in classes])
    real, said = np.array([(y == c).sum() for c in classes]), np.array([(p == c).sum() for c in classes])
    recall, precision = hit / np.maximum(real, 1), hit / np.maximum(said, 1)
    f1 = np.where(recall + precision > 0, 2 * recall * precision / np.maximum(recall + precision, 1e-12), 0)
    want = {"accuracy": hit.sum() / 300, "balanced_accuracy": recall[:3].mean(), "f1_macro": f1.mean(), "f1_weighted": (f1 * real).sum() / 300,
            "precision_macro": precision.mean(), "precision_weighted": (precision * real).sum() / 300, "recall_macro": recall.mean(),
            "recall_weighted": (recall * real).sum() / 300}
    assert set(want) == set(search.SCORES)
    for name, value in want.items():
        assert search.SCORES[name](df, "y", "p").first()[0] == pytest.approx(value)


def test_permuted_columns_keep_their_values(spark):
    """In a repeat every value of the column is given away once, and hardly any row keeps its own."""
    n = 900
    df = spark.createDataFrame([(k, float(k), float(-k), k % 2) for k in range(n)], "id long, a double, b double, y int")
    seen = {}

    def predict(rows):
        if "_column" in rows.columns:
            seen["rows"] = rows
        return rows.withColumn("prediction", F.col("y"))

    importance.permutation_importance(df, predict, ["a", "b"], "y", id_col="id", n_repeats=3, rows_per_bucket=100).collect()
    table = seen["rows"].toPandas()
    assert len(table) == n * 2 * 3
    for (repeat, column), own in table.groupby(["repeat", "_column"]):
        assert sorted(own["a"]) == list(range(n)) and sorted(own["b"]) == sorted(-k for k in range(n))
        assert (own["a"] == -own["b"]).mean() < 0.05


def test_two_modes_are_found(spark):
    draw = np.random.default_rng(0)
    values = np.concatenate([draw.normal(0, 1, 500), draw.normal(12, 1, 500)])
    df = spark.createDataFrame(pd.DataFrame({"v": values, "u": draw.normal(0, 1, 1000)}))
    modes = {r["feature"]: r for r in distribution.multimodality(df, ["v", "u"]).collect()}
    assert modes["v"]["num_peaks"] == 2 and modes["v"]["is_multimodal"]
    centres = [r["x"] for r in distribution.density_peaks(distribution.kernel_density(df, ["v"])).orderBy("peak_no").collect()]
    assert abs(centres[0]) < 0.7 and abs(centres[1] - 12) < 0.7


@pytest.mark.parametrize("n", [40, 3000, 60_000])
def test_density_equals_the_sum_over_all_rows(spark, n):
    """The stated error holds at every size, also with far outliers and repeated values."""
    draw = np.random.default_rng(n)
    columns = {"v": draw.normal(5, 2, n), "t": draw.standard_t(3, n), "k": draw.integers(0, 9, n).astype(float)}
    columns["t"][0] = 500.0
    df = spark.createDataFrame(pd.DataFrame(columns)).repartition(5)
    got = distribution.kernel_density(df, list(columns), 200).toPandas()
    for c, x in columns.items():
        width = x.std(ddof=1) * n ** -0.2
        places = x.min() + np.arange(200) * (x.max() - x.min()) / 199
        want = np.array([np.exp(-0.5 * ((p - x) / width) ** 2).sum() for p in places]) / (n * width * np.sqrt(2 * np.pi))
        own = got[got.feature == c].sort_values("point")
        assert np.allclose(own["x"], places) and np.abs(own["density"].to_numpy() - want).max() * width * np.sqrt(2 * np.pi) < 2e-12


def test_correlations_of_many_columns_from_one_scan(spark):
    """Gaps, a constant column and a copy among 60 columns; every row is read once."""
    draw = np.random.default_rng(2)
    table = pd.DataFrame(draw.normal(1e6, 3, (4000, 60)), columns=[f"c{k}" for k in range(60)])
    table["c1"], table["c2"] = 0.1, table["c0"] * -2
    table = table.mask(draw.random(table.shape) < 0.1)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(table).select([F.nanvl(c, F.lit(None)).alias(c) for c in table.columns]).repartition(7)
    df = df.mapInArrow(counted, df.schema)
    pairs = correlate.correlation_pairs(df).toPandas()
    assert read.value == 4000 and len(pairs) == 60 * 59 // 2
    want = table.corr()
    for row in pairs.itertuples():
        if "c1" in (row.a, row.b):
            assert np.isnan(row.r) or row.r is None
        else:
            assert row.r == pytest.approx(want.loc[row.a, row.b], abs=1e-9)
    blocked = correlate.correlation_pairs(df, columns_at_once=25).toPandas()
    assert np.allclose(blocked["r"].astype(float), pairs["r"].astype(float), equal_nan=True) and (blocked["b"] == pairs["b"]).all()


def test_correlations_with_values_that_are_not_finite(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, float("nan"), 2.0), (3.0, 5.0, 4.0), (float("inf"), None, 8.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["r"] for r in correlate.correlation_pairs(df).collect()}
    assert all(v != v for v in got.values())
    one = correlate.correlation_pairs(df.where("a = 1"), ["a", "c"]).first()["r"]
    assert one is None and correlate.correlation_pairs(df.limit(0), ["a", "c"]).first()["r"] is None


def test_flat_top_is_one_peak(spark):
    heights = [0.0, 1.0, 2.0, 2.0, 2.0, 1.0, 3.0, 0.5]
    density = spark.createDataFrame([("f", i, float(i), h) for i, h in enumerate(heights)],
                                    "feature string, point int, x double, density double")
    assert [r["point"] for r in distribution.density_peaks(density).orderBy("peak_no").collect()] == [3, 6]


def test_metrics_by_hand(spark):
    rows = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, 0)] * 2 + [(2, 0)]
    df = spark.createDataFrame(rows, "y int, p int")
    out = {r["class"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert out["0"]["precision"] == 3 / 6 and out["0"]["recall"] == 3 / 4
    assert (out["2"]["precision"], out["2"]["recall"], out["2"]["f1"], out["2"]["support"]) == (0, 0, 0, 1)
    assert out["accuracy"]["f1"] == pytest.approx(5 / 9)
    f0, f1 = 2 * 0.5 * 0.75 / 1.25, 2 * (2 / 3) * 0.5 / (2 / 3 + 0.5)
    assert out["macro avg"]["f1"] == pytest.approx((f0 + f1) / 3)
    matrix = evaluate.confusion_matrix(df, "y", "p").orderBy("actual").collect()
    assert [(r["n_0"], r["n_1"], r["n_2"]) for r in matrix] == [(3, 1, 0), (2, 2, 0), (1, 0, 0)]


def curve(spark, *values):
    return spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(values)], "feature string, importance double")


def test_cliff_elbow_and_fallback(spark):
    steep = curve(spark, 0.5, 0.45, 0.05, 0.04, 0.03, 0.02)
    assert importance.importance_cliff(steep).first()["feature"] == "f1"
    assert [r["feature"] for r in importance.top_features(steep).collect()] == ["f0", "f1"]
    late = curve(spark, 0.5, 0.2, 0.15, 0.14, 0.13, 0.01)  # the steepest fall is at the very end
    assert importance.importance_cliff(late).count() == 0
    assert importance.top_features(late).count() == 2
    assert importance.top_features(curve(spark, *[0.1] * 20)).count() == 1
    assert importance.importance_cliff(curve(spark, 0.0, 0.0, 0.0)).count() == 0


def test_vote(spark):
    sets = [spark.createDataFrame([(f,) for f in s], "feature string") for s in ("ab", "bc", "bd")]
    assert [(r["feature"], r["votes"]) for r in importance.vote(sets).collect()] == [("b", 3)]


def test_permutation_finds_the_informative_column(table):
    _, df = table
    model = importance.fit_forest(df, ["a", "c"], "y", 10, 4)
    predict = lambda rows: model.transform(importance.assembled(rows, ["a", "c"]))
    one = importance.permutation_importance(df.repartition(1), predict, ["a", "c"], "y", id_col="id", n_repeats=3).collect()
    two = importance.permutation_importance(df.repartition(9), predict, ["a", "c"], "y", id_col="id", n_repeats=3).collect()
    assert one[0]["feature"] == "a" and one[0]["importance"] > 0.3 > abs(one[1]["importance"])
    assert [r["importance"] for r in one] == pytest.approx([r["importance"] for r in two])


def test_permutation_by_cells_predicts_each_cell_once(table):
    """With the thresholds of the forest, results are the same, and the model sees a row per cell instead of one per variant."""
    _, df = table
    model, seen = importance.fit_forest(df, ["a", "c"], "y", 10, 4), []

    def predict(rows):
        seen.append(rows)
        return model.transform(importance.assembled(rows, ["a", "c"]))

    plain = importance.permutation_importance(df, predict, ["a", "c"], "y", id_col="id", n_repeats=3, rows_per_bucket=50).collect()
    seen.clear()
    limits = importance.split_points(model, ["a", "c"])
    cells = importance.permutation_importance(df, predict, ["a", "c"], "y", id_col="id", n_repeats=3, rows_per_bucket=50, thresholds=limits).collect()
    assert [r["feature"] for r in cells] == [r["feature"] for r in plain]
    assert [(r["importance"], r["deviation"]) for r in cells] == [pytest.approx((r["importance"], r["deviation"]), abs=1e-12) for r in plain]
    assert len(seen) == 1 and seen[0].count() == (len(limits["a"]) + 1) * (len(limits["c"]) + 1)


def test_forests_use_every_core_and_remember_nodes(spark, monkeypatch):
    """One file partition must not become one training task; whether nodes are remembered makes no difference to the trees."""
    df = spark.range(0, 10_000, 1, 1).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                          (F.col("id") % 2).cast("double").alias("y"))
    assert dealt(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    kept = importance.fit_forest(df, ["a", "b"], "y", 5, 4).toDebugString.split("\n", 1)[1]
    monkeypatch.setattr(importance, "NODE_IDS", 0)
    assert importance.fit_forest(df, ["a", "b"], "y", 5, 4).toDebugString.split("\n", 1)[1] == kept


def test_information_of_a_copy_of_the_class(spark):
    df = spark.range(400).select((F.col("id") % 4).cast("double").alias("same"), F.lit(1.0).alias("none"), (F.col("id") % 4).alias("y"))
    got = {r["feature"]: r["mutual_information"] for r in importance.mutual_information(df, ["same", "none"], "y").collect()}
    assert got["same"] == pytest.approx(np.log(4)) and got["none"] == pytest.approx(0)


def test_components_are_centred_and_uncorrelated(table):
    _, df = table
    out = importance.principal_components(df, ["a", "b", "c"], 2, keep=["id"])
    row = out.agg(F.avg("pc1"), F.avg("pc2"), F.corr("pc1", "pc2")).first()
    assert all(abs(v) < 1e-9 for v in row)


def test_elimination_keeps_the_informative_columns(table):
    _, df = table
    rows = {r["feature"]: r for r in importance.recursive_elimination(df, ["a", "b", "c", "d"], "y", 2, 10, 4).collect()}
    assert {f for f, r in rows.items() if r["selected"]} == {"a", "b"}
    assert sorted(r["ranking"] for r in rows.values()) == [1, 1, 2, 3]


def test_target_profile_bins_and_classes(table, spark):
    _, df = table
    assert profile.target_profile(df, "y").first()["is_classification"]
    bins = profile.target_profile(df, "a")
    assert not bins.first()["is_classification"] and bins.agg(F.sum("count")).first()[0] == 300


def test_statistical_analysis(table):
    _, df = table
    out = analysis.statistical_analysis(df, "y", ["a", "b", "c", "d"])
    advice = {r["feature"]: r["advice"] for r in out["advice"].collect()}
    assert "log1p" in advice["d"] and "keep" in advice["a"]
    lists = {(r["list_name"], r["feature"]) for r in out["lists"].collect()}
    assert ("skewed_features", "d") in lists and ("good_separators", "a") in lists


def test_selection_by_vote(table):
    _, df = table
    chosen = {r["feature"] for r in analysis.select_features(df, ["a", "b", "c", "d"], "y", k=2, n_estimators=5, max_depth=3).collect()}
    assert chosen >= {"a", "b"}


def test_search_space_and_sampling():
    space = search.parameter_space(SETTINGS, {"lang": ("one-hot", ["frequency"]), "source": "frequency"})
    assert space["encoder__hyperparams__lang"] == ["one-hot", "frequency"] and "encoder__hyperparams__source" not in space
    picks = search.sample_candidates(space, 40)
    assert len({str(p) for p in picks}) == 40 and picks == search.sample_candidates(space, 40)
    assert len(search.sample_candidates({"a": [1, 2], "b": [3]}, 10)) == 2


def test_classifier_resamples_only_when_fitting(table):
    _, df = table
    few = df.where("y <> 0 or id % 4 = 0")
    model = TabularClassifier("y", "id", {"kind": "one-hot"}, model="random_forest",
                              params={"classifier__n_estimators": 5, "smote__k_neighbors": 3}).fit(few)
    scored = model.transform(few)
    assert scored.count() == few.count()
    assert evaluate.accuracy(scored, "y", "prediction").first()[0] > 0.9
    assert {r["feature"] for r in model.importances().collect()} == {"a", "b", "c", "d", "kind_p", "kind_q"}
    with pytest.raises(ValueError, match="unknown parameter"):
        TabularClassifier("y", "id", params={"tree__depth": 1})


def test_labels_need_not_be_numbers(table):
    _, df = table
    named = df.withColumn("y", F.concat(F.lit("class "), F.col("y")))
    model = TabularClassifier("y", "id", {"kind": "frequency"}, oversample=False,
                              params={"classifier__n_estimators": 2, "classifier__max_depth": 2}).fit(named)
    assert {r[0] for r in model.transform(named).select("prediction").distinct().collect()} <= {"class 0", "class 1", "class 2"}


def test_full_run(table):
    _, df = table
    settings = {**SETTINGS, "preprocessing": {**SETTINGS["preprocessing"], "encoding": {"features": {
        "kind": {"strategy": "one-hot", "alternatives": ["frequency"]}}}}}
    out = search.run_full_pipeline(df, settings, label_col="y", id_col="id", n_iter=2, cv=2, model="random_forest")
    assert out["search"].table.count() == 2 and 0.5 < out["search"].best_score <= 1
    roles = {r["split"]: r["accuracy"] for r in out["accuracy"].collect()}
    assert set(roles) == {"validation", "test"} and min(roles.values()) > 0.5
    with pytest.raises(ValueError, match="not fitted"):
        search.evaluate_model(None, df, "y")


def test_mitigation_compares_both_models(table):
    _, df = table
    out = bias.mitigate_bias(df.drop("b"), ["kind"], "y", "id", n_estimators=5, max_depth=4)
    rows = {r["metric"]: r for r in out["comparison"].collect()}
    assert set(rows) == {"accuracy", "macro_f1"} and rows["accuracy"]["mitigated"] > 0.6


def test_curation(spark):
    rows = [
        (0, "x", "OakStreet", "2 Years and 6 Months", "Car Loan, and Home Loan", "12_", "a"),
        (1, "x", "ElmStreet", None, None, "-5", None), (2, "x", None, "NA", "Car Loan", "$300", "b"),
        (3, "x", "Elm Street", "1 Year and 0 Months", "Home Loan", "_____", "b"), (4, "x", "A", "bad", "Car Loan", "90000", "a"),
    ]
    raw = spark.createDataFrame(rows, "id int, name string, street string, hist string, loans string, debt string, mix string")
    spec = CurationSpec(
        id_col="id", drop=["name"], spaced_words={"street": "Street"}, durations=["hist"], list_column="loans",
        dirty_numbers=["debt"], constraints={"debt": {"min": 0, "max": 1000, "integer": True}}, category_fills={"mix": "Unknown"},
    )
    out, report = curate(raw, spec)
    got = {r["id"]: r.asDict() for r in out.collect()}
    assert report is None and "name" not in out.columns and "loans" not in out.columns
    assert got[0]["street"] == "Oak Street" and got[0]["hist"] == 2.5 and got[0]["debt"] == 12 and got[0]["Loan_Count"] == 2
    assert [got[i]["debt"] for i in range(5)] == [12, None, 300, None, None]
    assert got[1]["mix"] == "Unknown" and got[1]["Has_Missing_Loan"] == 1 and got[2]["Has_Car_Loan"] == 1


def test_files_round_trip_and_missing_paths(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "i int, s string, x double")
    path = files.save_processed_data(df, str(tmp_path / "new" / "t.csv"))
    assert files.load_data(spark, path, df.schema).orderBy("i").collect() == df.orderBy("i").collect()
    parquet = files.save_processed_data(df, str(tmp_path / "t"))
    assert files.load_processed_data(spark, parquet).count() == 2
    for call in (files.load_data, files.load_processed_data):
        with pytest.raises(FileNotFoundError):
            call(spark, str(tmp_path / "nothing"))


def test_missing_tokens_and_nan_become_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("i,s,x\n1,NA,1.5\n2,null,NaN\n3,ok,\n")
    out = files.load_data(spark, str(tmp_path / "t.csv")).orderBy("i").collect()
    assert [r["s"] for r in out] == [None, None, "ok"] and [r["x"] for r in out] == [1.5, None, None]
